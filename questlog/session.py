"""Spark session settings shared by jobs, tests and the bench.

Everything here is a plain Spark configuration: UTC session zone (event
dates must not move with the machine's zone), ANSI on (Spark 4 default, so
bad casts fail loudly), AQE with partition coalescing and skew-join
splitting, and a runtime broadcast threshold so that small aggregated sides
are broadcast only after their real size is measured.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job needs, whatever the cluster size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition is skewed when it is 5x the median and above 256 MB;
    # AQE then splits it and replicates the matching side's partition.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast decided by AQE on measured shuffle sizes (a checked bound),
    # sort-merge join beyond it.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # A semi or inner join that shuffles (its small side above the broadcast bound) sends a Bloom filter of that side's
    # keys to the scan of the other one first, from 10 GB of scan on (Spark's default); user tables are allowed in full.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "questlog",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF`.

    ``shuffle_partitions`` is the upper bound AQE coalesces down from; on a
    large cluster give a high number (thousands) and let AQE shrink it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Session-level settings also apply when the session already existed.
    for key, value in conf.items():
        if not key.startswith(("spark.ui.", "spark.driver.", "spark.executor.")):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf of an existing session
                pass
    ensure_checkpoint_dir(spark)
    return spark


# Runtime (session-level) settings the operators rely on: the UTC zone keeps
# day boundaries stable, the rest keeps joins and shuffles adaptive.
RUNTIME_KEYS = (
    "spark.sql.session.timeZone",
    "spark.sql.ansi.enabled",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.adaptive.autoBroadcastJoinThreshold",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.optimizer.runtime.bloomFilter.enabled",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold",
)


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session built elsewhere (the
    caller's own session), and make sure a checkpoint folder is known."""
    for key in RUNTIME_KEYS:
        if spark.conf.get(key, None) != BASE_CONF[key]:
            spark.conf.set(key, BASE_CONF[key])
    ensure_checkpoint_dir(spark)
    return spark


def scan_filter_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose joins never broadcast and send their Bloom filter to scans of any size: what
    tables beyond the broadcast bound get by themselves, on tables below it."""
    session = apply_engine_conf(spark.newSession())
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session


_fallback_root: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The value of ``spark.checkpoint.dir`` is used as given (SparkContext
    picks it up at start). Only when it is unset in a local session (one
    machine, as in tests) is a private folder created and registered with
    ``setCheckpointDir``; on a cluster each executor would write to a disk of
    its own and readers would miss files, so an unset key is an error there.
    """
    global _fallback_root
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _fallback_root is None:
        _fallback_root = tempfile.mkdtemp(prefix="questlog-ckpt-")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_fallback_root)
    return _fallback_root


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input files (one metadata call per path)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return int(total)


def configure_for_input(
    spark: SparkSession, paths, bytes_per_partition: int = 256 * 1024 * 1024
) -> int:
    """Size ``spark.sql.shuffle.partitions`` from the input: about one
    partition per ``bytes_per_partition`` of input, at least one per core.
    Shuffles after partial aggregation carry far less than the input, and
    AQE coalesces those down to the advisory size; a raw-row shuffle (the
    staging write, the wallet window) gets partitions that fit in memory.
    Returns the number set."""
    cores = spark.sparkContext.defaultParallelism
    n = -(-input_bytes(spark, paths) // bytes_per_partition)
    n = max(cores, n)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def partitions_for_input(spark: SparkSession, paths, bytes_per_partition: int = 256 * 1024 * 1024) -> None:
    """Raise ``spark.sql.shuffle.partitions`` to what the input needs; a higher setting stays."""
    n = -(-input_bytes(spark, paths) // bytes_per_partition)
    if n > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for stream state and
    intermediate tables that must survive executor loss)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "questlog", *parts])
