"""Structured Streaming forms of the incremental operators.

The source system polls partner APIs with overlapping look-back windows;
here payloads / rows land as files in a shared folder and a file stream
picks them up. Every sink is a ``foreachBatch`` whose write is
idempotent for its epoch, so a replayed epoch (after an executor or
driver loss, with the checkpoint location) rewrites the same output:

* insert-if-absent (S7): the epoch's new rows go to ``epoch=<id>`` of the
  target, written with overwrite; rows already stored in other epochs are
  anti-joined away;
* slice replacement (A1 + S9): the company-days touched by the epoch are
  recomputed from everything landed and written with dynamic partition
  overwrite, so replays and later epochs converge on the batch result;
* cursor (I1 + S14): rows newer than the stored cursor pass; the cursor
  table is rewritten per epoch.

All paths live under ``spark.checkpoint.dir`` (the cluster's shared
folder) unless given.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.operators.dedupe import first_wins
from cargolens.session import checkpoint_dir, dropping_shuffles, write_once


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def land_files(df: DataFrame, path: str, partition_col: Column | None = None, partition_name: str = "part") -> str:
    """Write ``df`` as many small files (one folder per ``partition_col``
    value) — the landing folder a file stream reads."""
    w = df if partition_col is None else df.withColumn(partition_name, partition_col)
    writer = w.write.mode("overwrite")
    if partition_col is not None:
        writer = writer.partitionBy(partition_name)
    with dropping_shuffles(df.sparkSession):
        writer.parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, schema, max_files: int = 50) -> DataFrame:
    """A parquet file stream over a landing folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_available(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything available now, then stop (a scheduled run)."""
    q = (stream.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def insert_if_absent_sink(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence,
                          columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """S7 per epoch: first row per key within the epoch, minus keys stored by
    earlier epochs; written to ``target/epoch=<id>`` (overwrite = idempotent)."""

    def fn(batch: DataFrame, epoch_id: int) -> None:
        b = first_wins(batch.select(*columns), list(keys), list(order))
        if epoch_id > 0:  # every earlier epoch left its folder (possibly empty)
            stored = spark.read.parquet(target).where(F.col("epoch") < epoch_id).select(*keys)
            b = b.join(stored, list(keys), "left_anti")
        b.write.mode("overwrite").parquet(f"{target}/epoch={epoch_id}")

    return fn


def slice_refresh_sink(spark: SparkSession, target: str, slice_cols: Sequence[str],
                       compute: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A1 + S9 per epoch: recompute the slices the epoch touched (``compute``
    receives the touched slice keys, written once) and replace them with a
    dynamic partition overwrite. No shuffle files are left to the next epoch."""

    def fn(batch: DataFrame, epoch_id: int) -> None:
        touched = write_once(batch.select(*slice_cols).distinct(), "touched")
        out = compute(touched)
        with dropping_shuffles(out.sparkSession):
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*slice_cols).parquet(target))

    return fn


def cursor_sink(spark: SparkSession, passed: str, cursor: str, keys: Sequence[str], ts_col: str,
                initial: DataFrame) -> Callable[[DataFrame, int], None]:
    """I1 + S14 per epoch: rows newer than the stored cursor of their key go
    to ``passed/epoch=<id>``; the cursor moves to the epoch's high-water mark
    (a new cursor version per epoch; the latest version is read back)."""

    def read_cursor(before: int) -> DataFrame:
        if before == 0:
            return initial
        # the cursor version written by the previous epoch holds every key
        c = spark.read.parquet(cursor).where(F.col("epoch") == before - 1)
        return c.select(*keys, "last_processed_at")

    def fn(batch: DataFrame, epoch_id: int) -> None:
        cur = read_cursor(epoch_id)
        j = batch.join(cur, list(keys), "left")
        ok = F.col("last_processed_at").isNull() | (F.col(ts_col) > F.col("last_processed_at"))
        j.where(ok).drop("last_processed_at").write.mode("overwrite").parquet(f"{passed}/epoch={epoch_id}")
        hw = batch.groupBy(*keys).agg(F.max(ts_col).alias("_hw"))
        nxt = cur.join(hw, list(keys), "full_outer").select(
            *keys, F.greatest(F.col("last_processed_at"), F.col("_hw")).alias("last_processed_at"))
        nxt.write.mode("overwrite").parquet(f"{cursor}/epoch={epoch_id}")

    return fn


def payload_sink(spark: SparkSession, objects: str, quarantine: str, repair: bool = False,
                 path: str = "$") -> Callable[[DataFrame, int], None]:
    """S2/S3 per epoch, from rows ``source_file, line, text``: the objects of
    every page go to ``objects/epoch=<id>`` (as JSON text, with file, line and
    position), texts that do not parse to ``quarantine/epoch=<id>`` as they
    came. Both folders belong to one epoch and are overwritten by a replay."""
    from cargolens.sources import payload as pl

    def fn(batch: DataFrame, epoch_id: int) -> None:
        parsed = pl.parse_payloads(batch, repair=repair).persist()
        try:
            good = pl.expand_objects(parsed.where(F.col("payload").isNotNull()).drop("text"), path=path)
            good.withColumn("obj", F.to_json("obj")).write.mode("overwrite").parquet(f"{objects}/epoch={epoch_id}")
            pl.quarantine(parsed).write.mode("overwrite").parquet(f"{quarantine}/epoch={epoch_id}")
        finally:
            parsed.unpersist()

    return fn


def distinct_pulls(stream: DataFrame, keys: Sequence[str], ts_col: str, delay: str) -> DataFrame:
    """Overlapping pulls (I1, U6): each key once. The state keeps a key only
    until the watermark (the newest ``ts_col`` seen less ``delay``) has passed
    it, so it does not grow with the stream; rows that come in behind the
    watermark are late duplicates of a closed window and are dropped. ``delay``
    must cover the overlap of two pulls."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def append_available(stream: DataFrame, target: str, checkpoint: str) -> list[dict]:
    """Append everything available now to a Parquet table (the file sink's
    log makes each epoch count once); returns the progress of each trigger."""
    q = (stream.writeStream.format("parquet").outputMode("append").option("path", target)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return [p if isinstance(p, dict) else p.__dict__ for p in q.recentProgress]
