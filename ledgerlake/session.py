"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: dict[str, str] = {}


def partitions_for(input_bytes: int, per_partition: int = 200 * 1024 * 1024, at_least: int = 200) -> int:
    """Shuffle partitions for an input of this size; AQE merges the ones that turn out small."""
    return max(at_least, -(-input_bytes // per_partition))


def build_session(
    app: str = "ledgerlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Session with the settings the operators rely on: UTC, ANSI, AQE with skew-join splitting.

    Give ``input_bytes``, the size of the largest history read, and the shuffles are sized to it.
    """
    if shuffle_partitions is None and input_bytes is not None:
        shuffle_partitions = partitions_for(input_bytes)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may run without it; a scratch folder is then made once per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_base:
        base = tempfile.mkdtemp(prefix="ledgerlake-", dir="/tmp")
        context.setCheckpointDir(base)
        _local_base[context.applicationId] = base
    return _local_base[context.applicationId]


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on the session sends rows to Python in Arrow batches of about this size, unless it has a size already.

    Spark's own 64 MB stand several times in every running task: while the batch grows, in Python, and on the way back.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a reduced frame to the shared folder once and read it back.

    For a result that several branches of a report use: they would otherwise each scan the history again.
    The table lives under the shared folder, so it outlives any executor; remove it with the folder.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
