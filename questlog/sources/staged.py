"""Staged tables: what many queries read, computed once per version of its
sources and of its definition.

A table is a plain Parquet folder of its own under the shared
``spark.checkpoint.dir``, published by a small note written last (its number of files and
bytes): nothing is renamed, and a reader takes a whole table or builds it again. The key covers
path, size and time of every source file, and the definition (the analysed plan and
the schema). Logs that grow by files are taken in by ``streaming.ingest``, and marts that grow
by days are kept by ``operators.rollups``; a staged table is written as a whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

MANY_FILES = 500
# What this process has found: definitions of tables whose build is fixed by the code, and notes by their place.
_defined: dict[tuple, str] = {}
_notes: dict[str, dict] = {}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def summary(spark: SparkSession, path: str) -> list[int]:
    """Number of files and bytes under ``path``, in one call."""
    p, fs = _fs(spark, path)
    got = fs.getContentSummary(p)
    return [got.getFileCount(), got.getLength()]


def files_of(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[int]]:
    """Size and modification time of every file under ``paths`` (metadata
    only; folders of many files are listed by Spark, in parallel)."""
    found = {}
    for path in paths:
        if summary(spark, path)[0] > MANY_FILES:
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            for r in listed.selectExpr("path", "length", "unix_millis(modificationTime) AS t").collect():
                found[r["path"]] = [r["length"], r["t"]]
            continue
        p, fs = _fs(spark, path)
        listing = fs.listFiles(p, True)
        while listing.hasNext():
            f = listing.next()
            if not f.getPath().getName().startswith(("_", ".")):
                found[f.getPath().toString()] = [f.getLen(), f.getModificationTime()]
    return found


# What differs between two plans of one computation: expression numbers, file places, session addresses, the numbers
# of lambda variables, and the watermarks' own names.
VARYING = re.compile(r"#\d+L?|plan_id=\d+|\[id=\d+\]|\w+:/\S+|@[0-9a-f]+|(?<=lambda )\w+|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def definition(df: DataFrame, *more: str) -> str:
    """A hash of how ``df`` is computed: its analysed plan without :data:`VARYING`, and its schema."""
    plan = df._jdf.queryExecution().analyzed().toString()  # noqa: SLF001
    return _hash(VARYING.sub("", plan), df.schema.json(), *more)


def _hash(*parts: str) -> str:
    return hashlib.sha1("\n".join(parts).encode()).hexdigest()[:16]


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def _read_json(spark: SparkSession, path: str) -> dict | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return json.loads(lines.readLine() or "null")
    except ValueError:
        return None
    finally:
        lines.close()


def _write_json(spark: SparkSession, path: str, what: dict) -> None:
    """One object, put in place by closing it."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(json.dumps(what).encode())
    out.close()


def _published(spark: SparkSession, place: str) -> dict | None:
    """The note at ``place`` if its folder has the files and bytes that it tells. A note is read once a process; the
    folder is looked at every time, in one call."""
    note = _notes.get(place) or _read_json(spark, place)
    if not note:
        return None
    try:
        whole = summary(spark, note["folder"]) == note["holds"]
    except Exception:  # the folder is gone
        whole = False
    if not whole:
        _notes.pop(place, None)
        return None
    _notes[place] = note
    return note


def _publish(spark: SparkSession, place: str, folder: str, result: object = None) -> dict:
    note = {"folder": folder, "holds": summary(spark, folder), "result": result}
    _write_json(spark, place, note)
    _notes[place] = note
    return note


def staged_table(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[], DataFrame], schema: str | None = None, **how) -> DataFrame:
    """Read the staged ``name`` (see :func:`staged_place`)."""
    place = staged_place(spark, name, sources, build, schema=schema, **how)
    return spark.read.schema(schema or build().schema).parquet(place)


def staged_place(
    spark: SparkSession,
    name: str,
    sources: Sequence[str],
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    schema: str | None = None,
    fixed: bool = False,
) -> str:
    """The folder of the staged ``name`` for these sources, built first if needed.

    ``build()`` returns the (lazy) DataFrame to store; ``schema`` (DDL, optional) fixes column
    order and types on read, partition columns included. ``fixed``: the definition follows
    from the code and the sources alone, so it is found once a process and version.
    """
    now = files_of(spark, sources)
    known = (name, schema, tuple(partition_by), tuple(sort_within), json.dumps(sorted(now.items())))
    defined = _defined.get(known) if fixed else None
    if defined is None:
        defined = definition(build(), schema or "", ",".join(partition_by), ",".join(sort_within))
        if fixed:
            _defined[known] = defined
    place = f"{scratch_path(spark, 'staged')}/{name}-{_hash(defined, json.dumps(sorted(now.items())))}.json"
    note = _published(spark, place)
    if note is None:
        folder = f"{place.removesuffix('.json')}-{uuid.uuid4().hex}"
        write_staged(build(), folder, partition_by, sort_within)
        note = _publish(spark, place, folder)
    return note["folder"]


def staged_folder(
    spark: SparkSession, name: str, sources: Sequence[str], write: Callable[[str], object], of: DataFrame
) -> tuple[str, object | None]:
    """A folder produced by ``write(path)`` once per version of the sources and
    of ``of``, the DataFrame it writes (published as :func:`staged_table` is).
    Returns the folder and what ``write`` returned, which the note keeps (it must be JSON)."""
    now = files_of(spark, sources)
    place = f"{scratch_path(spark, 'staged')}/{name}-{_hash(definition(of), json.dumps(sorted(now.items())))}.json"
    note = _published(spark, place)
    if note is None:
        folder = f"{place.removesuffix('.json')}-{uuid.uuid4().hex}"
        note = _publish(spark, place, folder, write(folder))
    return note["folder"], note["result"]


def write_staged(df: DataFrame, path: str, partition_by: Sequence[str], sort_within: Sequence[str]) -> None:
    """Write with a ``rebalance`` on the partition columns (AQE sizes the
    files and splits a hot day over several tasks) and a local sort, so
    Parquet row-group statistics let filters skip row groups."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
