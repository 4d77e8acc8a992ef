"""Incremental file landing with Structured Streaming, run to completion on each call."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.incremental import upsert
from ledgerlake.operators.latest import latest_per_key
from ledgerlake.operators.ordering import Names, names
from ledgerlake.sources.files import delete, names_in, publish_text, read_text
from ledgerlake.sources.sinks import ROWS_PER_FILE


def stream_files(
    spark: SparkSession, src: str, schema, fmt: str = "parquet", glob: str | None = None, max_files: int = 1000
) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(src)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_land(df: DataFrame, dst: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Append everything not landed yet to a Parquet table, then stop."""
    writer = df.writeStream.format("parquet").option("maxRecordsPerFile", ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(dst))


def stream_dedupe(df: DataFrame, keys: Names, ts: str, delay: str = "1 day") -> DataFrame:
    """Drop repeated change rows that arrive within ``delay`` of each other; state is bounded by it."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def _manifests(spark: SparkSession, target: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{target}/manifest") if n.endswith(".json"))


def _manifest(spark: SparkSession, target: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{target}/manifest/{number:012d}.json"))


def _newest(spark: SparkSession, target: str) -> tuple[int, dict]:
    """Number and content of the manifest that counts; number -1 for a target without state."""
    numbers = _manifests(spark, target)
    if not numbers:
        return -1, {"buckets": None, "folders": {}, "applied": {}}
    return numbers[-1], _manifest(spark, target, numbers[-1])


def _state_paths(target: str, folders: dict[str, str]) -> list[str]:
    return [f"{target}/data/{folder}/bucket={bucket}" for bucket, folder in sorted(folders.items())]


def read_state(spark: SparkSession, target: str, schema) -> DataFrame:
    """The current state kept by :func:`stream_upsert`: what the newest manifest names, and nothing else."""
    paths = _state_paths(target, _newest(spark, target)[1]["folders"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact_state(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Remove manifests but the newest ``keep``, and data that none of these names; returns the removed folders.

    Half-written data of failed batches goes too. Call it while no upsert runs; readers of older versions must be done.
    """
    if keep < 1:
        raise ValueError("keep at least the newest manifest")
    numbers = _manifests(spark, target)
    used = {f for n in numbers[-keep:] for f in _manifest(spark, target, n)["folders"].values()}
    for number in numbers[:-keep]:
        delete(spark, f"{target}/manifest/{number:012d}.json")
    unused = [f for f in names_in(spark, f"{target}/data") if f not in used]
    for folder in unused:
        delete(spark, f"{target}/data/{folder}")
    return unused


def stream_upsert(
    df: DataFrame,
    key: Names,
    ts: str,
    target: str,
    checkpoint: str,
    ties: Sequence[str] = (),
    buckets: int = 256,
) -> None:
    """Keep the current state per key from a change stream; read it with :func:`read_state`.

    The state is split into hash buckets of the key. A micro-batch rewrites only the buckets it touches, into a
    folder of its own, and then publishes a manifest, one small file that names the folder of every bucket. It
    appears in one step and is numbered by what the target holds, so a half-written batch is never seen and a new
    checkpoint goes on from the state there is. A manifest also holds the last batch of each checkpoint: a batch
    that runs again after it was published changes nothing. Two writers at once: the later one fails.
    """
    spark = df.sparkSession
    schema = df.schema
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in names(key)]), F.lit(buckets)).cast("int")

    def merge(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        stream = json.loads(read_text(session, f"{checkpoint}/metadata"))["id"]
        number, state = _newest(session, target)
        if batch <= state["applied"].get(stream, -1):
            return
        if state["buckets"] not in (None, buckets):
            raise ValueError(f"the state of {target} has {state['buckets']} buckets, not {buckets}")
        # what the batch brings is reduced first: one row per key
        changes = latest_per_key(rows, key, [ts, *ties]).withColumn("bucket", bucket).persist()
        try:
            touched = {str(r["bucket"]) for r in changes.select("bucket").distinct().collect()}
            known = {b: f for b, f in state["folders"].items() if b in touched}
            merged = changes
            if known:
                before = session.read.schema(schema).parquet(*_state_paths(target, known)).withColumn("bucket", bucket)
                merged = upsert(before, changes, key, ts, ties)
            folder = uuid.uuid4().hex
            merged.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{target}/data/{folder}")
        finally:
            changes.unpersist()
        state = {
            "buckets": buckets,
            "folders": state["folders"] | dict.fromkeys(touched, folder),
            "applied": state["applied"] | {stream: batch},
        }
        if not publish_text(session, f"{target}/manifest/{number + 1:012d}.json", json.dumps(state)):
            raise RuntimeError(f"another writer changed {target} during batch {batch}")

    query = (
        df.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
