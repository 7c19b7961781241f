"""The application flow as streams: validate, score, decide, store, total.

Every step is the batch operator on a streaming frame. What has state keeps it
bounded by a watermark, or by having a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.functions import scoring
from creditlens.functions.validation import required_errors, type_errors
from creditlens.operators.decisions import decide, score
from creditlens.operators.models import predict
from creditlens.operators.portfolio import portfolio_totals
from creditlens.operators.tables import split_wide_event
from creditlens.session import run_folder


def validate(df: DataFrame) -> DataFrame:
    """Add the failing phase and its errors; ranges are looked at once all fields are there."""
    checked = df.withColumns({"__required": required_errors(), "__types": type_errors()})
    phase = "CASE WHEN size(__required) > 0 THEN 'required' WHEN size(__types) > 0 THEN 'types' END"
    errors = "CASE WHEN size(__required) > 0 THEN __required ELSE __types END"
    return checked.selectExpr(*df.columns, f"{phase} AS failed_phase", f"{errors} AS errors")


def accepted(df: DataFrame) -> DataFrame:
    """Valid applications, with the code they go by from here on."""
    valid = validate(df).where(F.col("failed_phase").isNull()).drop("failed_phase", "errors")
    return valid.withColumns(
        {
            "application_code": scoring.application_code(F.col("application_id")),
            "validation_status": F.lit("validated"),
        }
    )


def rejected(df: DataFrame) -> DataFrame:
    """Dead letters with their errors."""
    return validate(df).where(F.col("failed_phase").isNotNull())


def scored(df: DataFrame) -> DataFrame:
    return score(accepted(df), "model_score")


def model_scored(df: DataFrame, model, statistics) -> DataFrame:
    """Valid applications scored by a fitted model; the rule stands in where it gives no number."""
    predicted = predict(model, accepted(df), statistics).drop("prediction_class")
    return score(predicted.withColumnRenamed("prob_default", "__model_score"), "__model_score").drop("__model_score")


def decided(df: DataFrame) -> DataFrame:
    return decide(scored(df))


def risk_alerts(df: DataFrame, limit: float = 0.7) -> DataFrame:
    """High-risk applications as alert rows."""
    return scored(df).where(F.col("risk_score") > limit).select(
        "application_id",
        "risk_score",
        F.lit("HIGH_RISK").alias("alert_type"),
        scoring.risk_level(F.col("risk_score")).alias("risk_level"),
    )


def with_event_time(df: DataFrame, column: str = "created_at", delay: str = "1 day") -> DataFrame:
    return df.withColumn("event_time", F.col(column).cast("timestamp")).withWatermark("event_time", delay)


def hourly_totals(df: DataFrame, delay: str = "1 day") -> DataFrame:
    """Totals per hour of event time; the watermark bounds the hours kept in state."""
    timed = with_event_time(decided(df), delay=delay)
    totals = portfolio_totals(timed, F.window("event_time", "1 hour"))
    return totals.select(F.col("window.start").alias("hour"), *[c for c in totals.columns if c != "window"])


def distinct_feature_sets(df: DataFrame, keep: str = "7 days") -> DataFrame:
    """Each feature set once while its score would still be cached."""
    keyed = with_event_time(df, delay=keep).withColumn("cache_key", scoring.cache_key())
    return keyed.dropDuplicatesWithinWatermark(["cache_key"])


def run_rows(stream: DataFrame, label: str, base: str | None = None, settings: dict[str, str] | None = None) -> DataFrame:
    """Run a stateless or append stream over what is there; rows land in files, exactly once.

    ``base`` names the folder of rows and state. A later run over the same folder goes
    on where the last one ended; without a name each run has a folder of its own.
    ``settings`` hold for this stream alone: it copies the session's as it starts.
    """
    spark = stream.sparkSession
    base = base or run_folder(spark, label)
    settings = settings or {}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        query = (
            stream.writeStream.format("parquet")
            .option("path", f"{base}/rows")
            .option("checkpointLocation", f"{base}/state")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def _run_batches(stream: DataFrame, label: str, mode: str, write, base: str | None = None) -> str:
    base = base or run_folder(stream.sparkSession, label)
    query = (
        stream.writeStream.foreachBatch(lambda df, batch: write(df, batch, base))
        .option("checkpointLocation", f"{base}/state")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return base


def _write_batch(df: DataFrame, batch: int, base: str) -> None:
    # A batch owns its folder: run again after a failure, it overwrites itself.
    df.write.mode("overwrite").parquet(f"{base}/rows/batch={batch}")


def run_totals(stream: DataFrame, label: str, key: str | None = None, base: str | None = None) -> DataFrame:
    """Run an aggregating stream in update mode; the last value per key is the result.

    Each batch merges its keys into those of the batch before, so the newest folder
    alone is the result, and a batch that runs again reads the same predecessor.
    """
    schema = stream.schema

    def merge(df: DataFrame, batch: int, folder: str) -> None:
        if key is None:
            if df.isEmpty():
                df = _totals_before(df.sparkSession, folder, batch, schema)
        else:
            earlier = _totals_before(df.sparkSession, folder, batch, schema)
            df = df.unionByName(earlier.join(df.select(key), key, "left_anti"))
        df.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    base = _run_batches(stream, label, "update", merge, base)
    return _totals_before(stream.sparkSession, base, None, schema)


def _totals_before(spark, base: str, batch: int | None, schema) -> DataFrame:
    """The totals of the newest batch before the given one, or of the newest of all."""
    rows = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/rows")
    files = rows.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [int(f.getPath().getName().removeprefix("batch=")) for f in files.listStatus(rows)] if files.exists(rows) else []
    earlier = [n for n in found if batch is None or n < batch]
    if not earlier:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base}/rows/batch={max(earlier)}")


def run_process(stream: DataFrame, label: str = "process", base: str | None = None) -> dict[str, DataFrame]:
    """Store decided applications: per micro-batch one folder in each of the three tables.

    The batch is decided and written once; the three tables are cut from what was written.
    """
    names = ("applications", "risk_scores", "decisions")

    def write(df: DataFrame, batch: int, folder: str) -> None:
        _write_batch(df, batch, f"{folder}/decided")
        stored = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/decided/rows/batch={batch}")
        for name, part in split_wide_event(stored).items():
            part.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch}")

    base = _run_batches(stream, label, "append", write, base)
    spark = stream.sparkSession
    return {name: spark.read.parquet(f"{base}/{name}").drop("batch") for name in names}


def retain(df: DataFrame, as_of: str, time: str, hours: int) -> DataFrame:
    """Rows whose lifetime has not run out; also the purge of stored streams."""
    ends = F.unix_timestamp(F.col(time).cast("timestamp")) + hours * 3600
    return df.withColumn("ttl", ends).where(F.col("ttl") > F.unix_timestamp(F.lit(as_of).cast("timestamp")))
