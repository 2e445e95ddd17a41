"""The exact-ratio helper against Python's exact fractions."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from questlog.functions.numeric import exact_mean, ratio


def half_up(fr: Fraction, digits: int) -> float:
    q = Decimal(fr.numerator) / Decimal(fr.denominator)
    return float(q.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_ratio_matches_exact_rounding(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(600):
        cents = rnd.randint(0, 10**7)
        den = rnd.choice([1, 2, 3, 4, 8, 16, 32, 7, 1000, rnd.randint(1, 10**5)])
        rows.append((cents, den))
    rows += [(5, 1000), (25, 10000), (1005, 100000), (0, 0), (7, 0)]  # exact ties and zero divisors
    df = spark.createDataFrame(rows, "cents long, den long").select(
        "cents",
        "den",
        ratio(F.col("cents").cast("decimal(20,2)") / 100, "den", 2, num_scale=2).alias("r2"),
        ratio("cents", "den", 4).alias("r4"),
    )
    for r in df.collect():
        if r["den"] == 0:
            assert r["r2"] is None and r["r4"] is None  # SAFE_DIVIDE
            continue
        assert r["r2"] == half_up(Fraction(r["cents"], 100 * r["den"]), 2)
        assert r["r4"] == half_up(Fraction(r["cents"], r["den"]), 4)


def test_exact_mean_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "x long")
    assert df.agg(exact_mean("x", 2).alias("m")).first()["m"] == 1.67
    empty = spark.createDataFrame([(None,)], "x long")
    assert empty.agg(exact_mean("x", 2).alias("m")).first()["m"] is None


def test_oracle_ratio_sql_matches_exact_rounding():
    import duckdb

    from questlog.plans.oracle import ratio as sql_ratio

    rnd = random.Random(5)
    rows = [(rnd.randint(0, 10**7), rnd.choice([1, 3, 8, 32, 7, rnd.randint(1, 10**5)])) for _ in range(400)]
    rows += [(5, 1000), (25, 10000), (0, 0)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (cents BIGINT, den BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    got = con.execute(
        f"SELECT cents, den, {sql_ratio('CAST(cents AS DECIMAL(20,2)) / 100', 'den', 2, ns=2)}, {sql_ratio('cents', 'den', 4)} FROM t"
    ).fetchall()
    for cents, den, r2, r4 in got:
        if den == 0:
            assert r2 is None and r4 is None
            continue
        assert r2 == half_up(Fraction(cents, 100 * den), 2)
        assert r4 == half_up(Fraction(cents, den), 4)
