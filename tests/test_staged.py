"""Staged tables: complete and fresh."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from questlog.sources import staged


@pytest.fixture()
def here(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(staged, "scratch_path", lambda s, *parts: "/".join([tmp_dir, "scratch", *parts]))
    src = os.path.join(tmp_dir, "src", "day=1")
    spark.range(10).withColumn("d", F.lit("2024-01-01").cast("date")).write.parquet(src)
    return os.path.join(tmp_dir, "src")


class Table:
    def __init__(self, spark, src, factor=1):
        self.spark, self.src, self.factor = spark, src, factor

    def build(self):
        df = self.spark.read.schema("id long, d date").parquet(f"{self.src}/*")
        return df.select((F.col("id") * self.factor).alias("id"), "d")

    def read(self):
        return staged.staged_table(self.spark, "t", [self.src], self.build, "id long, d date", partition_by=("d",), sort_within=("id",))


def parts(here):
    return sorted(x for x in glob.glob(os.path.join(os.path.dirname(here), "scratch", "staged", "t-*")) if os.path.isdir(x))


def test_read_twice_is_built_once(spark, here):
    t = Table(spark, here)
    assert t.read().count() == 10 and t.read().count() == 10 and len(parts(here)) == 1


def test_a_missing_or_cut_file_is_built_again(spark, here):
    t = Table(spark, here)
    t.read()
    file = glob.glob(f"{parts(here)[0]}/*/*.parquet")[0]
    os.remove(file)
    assert t.read().count() == 10 and len(parts(here)) == 2


def test_a_folder_without_its_manifest_is_no_table(spark, here):
    t = Table(spark, here)
    t.read()
    for m in glob.glob(os.path.join(os.path.dirname(here), "scratch", "staged", "*.json")):
        os.remove(m)
    staged._notes.clear()  # as another process would find it
    assert t.read().count() == 10 and len(parts(here)) == 2


def test_a_nested_file_of_the_same_size_is_noticed(spark, here):
    t = Table(spark, here)
    t.read()
    file = glob.glob(f"{here}/*/*.parquet")[0]
    os.utime(file, (1, 1))
    t.read()
    assert len(parts(here)) == 2


def test_another_definition_is_another_table(spark, here):
    Table(spark, here).read()
    assert Table(spark, here, factor=2).read().agg(F.max("id")).first()[0] == 18


def test_added_files_are_read(spark, here):
    t = Table(spark, here)
    t.read()
    spark.range(10, 15).withColumn("d", F.lit("2024-01-02").cast("date")).write.parquet(f"{here}/day=2")
    got = t.read()
    assert got.count() == 15 and got.agg(F.sum("id")).first()[0] == sum(range(15)) and len(parts(here)) == 2


def test_a_folder_that_is_gone_is_written_again(spark, here):
    folder, result = staged.staged_folder(spark, "f", [here], lambda p: spark.range(3).write.parquet(p) or 7, spark.range(3))
    assert staged.staged_folder(spark, "f", [here], lambda p: 1 / 0, spark.range(3)) == (folder, 7)
    for f in glob.glob(f"{folder}/*") + glob.glob(f"{folder}/.*"):
        os.remove(f)
    os.rmdir(folder)
    again, _ = staged.staged_folder(spark, "f", [here], lambda p: spark.range(3).write.parquet(p) or 8, spark.range(3))
    assert again != folder and spark.read.parquet(again).count() == 3


def test_a_definition_is_the_same_in_every_call(spark, here):
    df = lambda k: spark.read.parquet(here).select(F.transform(F.array("id", "id"), lambda x: x + k).alias("a"), F.current_date().alias("day"))
    assert staged.definition(df(1)) == staged.definition(df(1)) != staged.definition(df(2))
    live = lambda: spark.readStream.schema("id long, t timestamp").parquet(here).withWatermark("t", "1 day").groupBy("t").count()
    assert staged.definition(live()) == staged.definition(live())
