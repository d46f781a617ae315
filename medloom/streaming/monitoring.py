"""Rates, lags and job states; the same operators over batch and streaming frames."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medloom.streaming.folding import FOLD_AT, fold_when_many
from medloom.streaming.landing import ONCE, batch_folder

# Job states from first to last; decides between equal times.
JOB_STATES = ("accepted", "processing", "completed", "failed")


def ingest_rate(
    df: DataFrame, ts: str, window: str = "5 minutes", seconds: int = 300, delay: str = "10 minutes"
) -> DataFrame:
    """Records per second in fixed windows.

    On a stream the watermark closes a window ``delay`` after its end and frees its state;
    a batch ignores it.
    """
    counts = (
        df.withWatermark(ts, delay).groupBy(F.window(ts, window)).agg(F.count(F.lit(1)).alias("records"))
    )
    return counts.select(
        F.col("window.start").alias("window_start"),
        "records",
        F.round(F.col("records") / seconds, 6).alias("records_per_second"),
    )


def stream_ingest_rate(
    stream: DataFrame, ts: str, out: str, checkpoint: str, trigger: dict = ONCE, **kwargs
) -> StreamingQuery:
    """Windows that a micro-batch has changed, open ones too; ``latest_rates`` over ``out`` has
    each window once. ``late_rows`` counts what came after its window was closed."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        part = batch_folder(batch.sparkSession, checkpoint, batch_id)
        batch.write.mode("overwrite").parquet(os.path.join(out, part))

    return (
        ingest_rate(stream, ts, **kwargs)
        .writeStream.outputMode("update")
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest_rates(df: DataFrame, seconds: int = 300) -> DataFrame:
    """Each window once, from what ``stream_ingest_rate`` has written: within a query the last
    count, over several queries on one target (each has its own input) the sum."""
    per_query = df.groupBy("run", "window_start").agg(F.max("records").alias("records"))
    return (
        per_query.groupBy("window_start")
        .agg(F.sum("records").alias("records"))
        .withColumn("records_per_second", F.round(F.col("records") / seconds, 6))
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows of the recent micro-batches that came too late for the watermark."""
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    return sum(s["numRowsDroppedByWatermark"] for s in states)


def ingest_lag(df: DataFrame, event_ts: str, ingest_ts: str, *by: str) -> DataFrame:
    """Average, largest and 95th percentile of ingest time minus event time, in seconds.

    Rows are first counted per whole second of lag, spread over all tasks. The exact
    percentile then holds one entry per distinct second, however many rows a source has.
    """
    lag = F.unix_seconds(F.col(ingest_ts).cast("timestamp")) - F.unix_seconds(
        F.col(event_ts).cast("timestamp")
    )
    per_second = df.groupBy(*by, lag.alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    weighted = F.sum(F.col("lag") * F.col("n")) / F.sum("n")
    return per_second.groupBy(*by).agg(
        F.sum("n").alias("records"),
        F.round(weighted, 4).alias("avg_lag_seconds"),
        F.max("lag").alias("max_lag_seconds"),
        F.round(F.percentile("lag", 0.95, F.col("n")), 4).alias("p95_lag_seconds"),
    )


def _rank(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in JOB_STATES]), status)


def job_latest_status(df: DataFrame) -> DataFrame:
    """Last status per job from ``job_id, status, ts``."""
    last = F.max(F.struct(F.col("ts"), _rank(F.col("status")).alias("rank"), F.col("status")))
    return (
        df.groupBy("job_id")
        .agg(last.alias("last"))
        .select("job_id", F.col("last.status").alias("status"), F.col("last.ts").alias("ts"))
    )


def stream_job_status(
    stream: DataFrame, out: str, checkpoint: str, trigger: dict = ONCE, fold_at: int = FOLD_AT
) -> StreamingQuery:
    """Last status of the jobs in each micro-batch; ``job_latest_status`` over ``out`` is the state.

    The stream keeps no state: what it has written is the state. When ``fold_at`` batches have come
    together they are folded into one row per job, so neither state rows nor files grow with the
    number of micro-batches. A status that comes late loses against a later one in the fold.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = batch_folder(spark, checkpoint, batch_id)
        job_latest_status(batch).write.mode("overwrite").parquet(os.path.join(out, part))
        fold_when_many(spark, out, job_latest_status, fold_at)

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
