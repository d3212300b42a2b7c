"""Structured Streaming forms of the batch operators: an extension, the batch ones being the contract."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators.orphans import OrphanState, step
from tallyweave.session import checkpoint_dir


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream of its files (a pattern as path lets a single file stand for a folder)."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{path[:-1]}[{path[-1]}]")


def windowed(events: DataFrame, size: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Events (ts, event_type, value) counted and summed per tumbling window and type; rows later than the watermark are dropped by the engine."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
        .groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events", "total")
    )


def first_seen(evidence: DataFrame, late: str = "1 day") -> DataFrame:
    """Evidence (evidence_id, ts, ...) without repeated deliveries within the watermark."""
    return evidence.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(["evidence_id"])


def run_all(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a stream over all that is there now and return its result from the shared folder."""
    spark = stream.sparkSession
    at = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{at}/out")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(put).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def orphans_on_stream(refs: DataFrame, state: OrphanState) -> OrphanState:
    """Feed a stream of references (ref_id, ref_key, ref_at) batch by batch into an orphan state; returns the state after all that is there now."""
    spark = refs.sparkSession
    at = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    box = [state]

    def feed(df: DataFrame, batch: int) -> None:
        box[0] = step(box[0], new_refs=df)

    refs.writeStream.option("checkpointLocation", at).trigger(availableNow=True).foreachBatch(feed).start().awaitTermination()
    return box[0]
