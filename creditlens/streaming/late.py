"""Hourly totals beside a dead-letter table of the rows that came too late.

Spark drops late rows without a trace. Here a batch is split by the watermark its
predecessors have set (the latest event time seen, less the delay): rows on time go into
the totals, rows behind it into a table of their own, with the watermark they missed.
Each batch owns one folder per table and overwrites it when it runs again, and reads
only what earlier batches wrote, so results do not depend on failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.operators.portfolio import portfolio_totals
from creditlens.session import run_folder

DELAY = "1 day"


def _earlier(spark, folder: str, schema: str, batch: int) -> DataFrame:
    """Rows of the batches before this one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{schema}, batch int")
    return spark.read.schema(f"{schema}, batch int").parquet(folder).where(F.col("batch") < batch)


def run_hourly(stream: DataFrame, delay: str = DELAY, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Totals per hour of the rows on time, and the late rows, of a stream of decided applications.

    ``stream`` has event_time. A null time is late: it belongs to no hour. The totals of an
    hour are the sums over its batches, so a batch writes only the hours it touched.
    """
    spark = stream.sparkSession
    base = base or run_folder(spark, "hourly")
    times = "latest timestamp"

    def write(df: DataFrame, batch: int) -> None:
        session = df.sparkSession
        rows = f"{base}/batch-rows/batch={batch}"
        df.write.mode("overwrite").parquet(rows)
        held = session.read.schema(df.schema).parquet(rows)
        # One row per earlier batch.
        seen = _earlier(session, f"{base}/times", times, batch).agg(F.max("latest") - F.expr(f"INTERVAL {delay}")).first()[0]
        limit = F.lit(seen).cast("timestamp")
        on_time = F.col("event_time").isNotNull() & (F.lit(seen is None) | (F.col("event_time") >= limit))
        late = held.where(~on_time).withColumn("watermark", limit)
        late.write.mode("overwrite").parquet(f"{base}/late/batch={batch}")
        hour = F.date_trunc("hour", "event_time").alias("hour")
        portfolio_totals(held.where(on_time), hour).write.mode("overwrite").parquet(f"{base}/totals/batch={batch}")
        latest = held.agg(F.max("event_time").alias("latest"))
        latest.write.mode("overwrite").parquet(f"{base}/times/batch={batch}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _summed(spark.read.parquet(f"{base}/totals")), spark.read.parquet(f"{base}/late").drop("batch")


def _summed(totals: DataFrame) -> DataFrame:
    """The totals of an hour over all batches."""
    n = F.col("total_applications")
    added = [c for c in totals.columns if c not in ("hour", "batch", "average_risk_score")]
    return totals.groupBy("hour").agg(
        *[F.sum(c).alias(c) for c in added], (F.sum(F.col("average_risk_score") * n) / F.sum(n)).alias("average_risk_score")
    )
