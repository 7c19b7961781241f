"""Queries: files written and read back."""

import time
from datetime import UTC, datetime

from pyspark.sql import functions as F

from creditlens.operators import cleaning, quality
from creditlens.plans.fixtures import AS_OF, CLEAN_COLUMNS, FEATURES, Tables
from creditlens.plans.quality import CONSISTENCY_SQL
from creditlens.plans.registry import query
from creditlens.plans.shape import as_text, rounded
from creditlens.plans.cleaning import CLEAN_JOB_RESULT, CLEAN_JOB_TABLES, COLUMNS
from creditlens.schemas import APPLICATION, COERCIONS, EVENT_ENVELOPE
from creditlens.session import FILE_ROWS, run_folder, staged
from creditlens.sources import events, readers, writers

KINDS = {"int": "INTEGER", "double": "DOUBLE"}


def _typed_sql(source: str, mark: str = "'?'") -> str:
    cells = [
        f"CAST(nullif({c}, {mark})::DOUBLE AS {KINDS[COERCIONS[c]]}) AS {c}" if c in COERCIONS else c
        for c in CLEAN_COLUMNS
    ]
    return f"SELECT {', '.join(cells)} FROM {source}"


GOOD_RAW = "(SELECT * REPLACE (CASE WHEN person_age = 'abc' THEN '?' ELSE person_age END AS person_age) FROM raw)"


@query("src_csv", uses=("raw",), sql=_typed_sql(GOOD_RAW))
def src_csv(t: Tables):
    # Ages that are no number are marked missing, as the feed does with rates.
    marked = t.raw.withColumn("person_age", F.regexp_replace("person_age", "^abc$", "?"))
    path = f"{run_folder(t.spark, 'csv')}/raw"
    # Missing cells are written as the feed's own mark, not as empty text.
    whole = marked.withColumns({c: F.coalesce(F.col(c), F.lit("?")) for c in COERCIONS})
    writers.save_csv(whole, path)
    return readers.read_csv(t.spark, path, APPLICATION)


@query(
    "src_dispatch",
    uses=("feed",),
    sql=" UNION ALL ".join(
        f"SELECT '{kind}' AS format, application_id, loan_grade, loan_amnt, loan_int_rate FROM feed"
        for kind in ("csv", "json", "parquet")
    ),
)
def src_dispatch(t: Tables):
    base = run_folder(t.spark, "dispatch")
    frame = t.feed.select("application_id", "loan_grade", "loan_amnt", "loan_int_rate")
    frame.write.parquet(f"{base}/feed.parquet")
    written = t.spark.read.parquet(f"{base}/feed.parquet")
    written.write.csv(f"{base}/feed.csv", header=True)
    written.write.json(f"{base}/feed.json")
    schema = "application_id bigint, loan_grade string, loan_amnt double, loan_int_rate double"
    frames = [
        readers.read_any(t.spark, f"{base}/feed.{kind}", schema).select(
            F.lit(kind).alias("format"), "application_id", "loan_grade", "loan_amnt", "loan_int_rate"
        )
        for kind in ("csv", "json", "parquet")
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("src_parquet", sql="SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def src_parquet(t: Tables):
    return readers.read_any(t.spark, f"{t.folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )


ARFF_COLUMNS = ["application_id", *FEATURES]


@query(
    "src_arff",
    uses=("raw",),
    sql="SELECT " + ", ".join(f"coalesce({c}::VARCHAR, '?') AS {c}" for c in ARFF_COLUMNS) + " FROM raw",
)
def src_arff(t: Tables):
    path = f"{run_folder(t.spark, 'arff')}/dataset"
    writers.save_arff(t.raw.select(*ARFF_COLUMNS), path, "credit")
    return readers.read_arff(t.spark, path)


@query(
    "src_time_window",
    uses=("feed",),
    sql="SELECT application_id, loan_grade, loan_amnt FROM feed",
)
def src_time_window(t: Tables):
    """Two sets of files, one older than a moment between them; the window takes the first."""
    base = run_folder(t.spark, "window")
    frame = t.feed.select("application_id", "loan_grade", "loan_amnt")
    low, middle = F.col("loan_grade").isin("A", "B", "C"), F.col("loan_grade").isin("D", "E")
    frame.where(low).write.csv(f"{base}/one", header=True)
    frame.where(middle).write.json(f"{base}/two")
    frame.where(~low & ~middle).write.parquet(f"{base}/three")
    # File times have whole seconds.
    time.sleep(1.1)
    moment = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S")
    time.sleep(1.1)
    later = frame.withColumn("application_id", -F.col("application_id"))
    later.write.csv(f"{base}/four", header=True)
    later.write.parquet(f"{base}/five")
    schema = "application_id bigint, loan_grade string, loan_amnt double"
    return readers.read_modified_between(t.spark, base, "2020-01-01T00:00:00", moment, schema)


NULL_COLUMNS = " + ".join(
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*) > 5 THEN 1 ELSE 0 END" for c in CLEAN_COLUMNS
)


@query(
    "sink_cleaned",
    uses=("feed_dup",),
    sql=f"""{CLEAN_JOB_TABLES}, cleaned AS ({CLEAN_JOB_RESULT})
SELECT *, '{AS_OF}' AS processing_date, 'data-ingestion' AS job_name,
  (SELECT round(1.0::DOUBLE - ({NULL_COLUMNS}) * 0.1::DOUBLE, 6) FROM cleaned) AS quality_score FROM cleaned""",
)
def sink_cleaned(t: Tables):
    cleaned = staged(cleaning.clean_job(t.feed_dup), "cleaned")
    score = quality.ingestion_score(quality.ingestion_report(cleaned))
    path = f"{run_folder(t.spark, 'cleaned')}/cleaned"
    writers.save_cleaned(cleaned, path, AS_OF, "data-ingestion", score)
    written = t.spark.read.parquet(path)
    return as_text(rounded(written, "person_income", "loan_amnt", "quality_score"), "processing_date")


@query("sink_csv", uses=("feed",), sql=f"SELECT {COLUMNS} FROM feed")
def sink_csv(t: Tables):
    path = f"{run_folder(t.spark, 'csv')}/cleaned"
    writers.save_csv(t.feed, path)
    return readers.read_csv(t.spark, path, APPLICATION)


@query(
    "sink_multi",
    uses=("predictions",),
    sql=" UNION ALL ".join(
        f"SELECT '{kind}' AS format, application_id, prob_default, prediction_class FROM predictions"
        for kind in ("parquet", "csv", "json")
    ),
)
def sink_multi(t: Tables):
    paths = writers.save_all_formats(
        t.predictions.select("application_id", "prob_default", "prediction_class"), run_folder(t.spark, "multi")
    )
    schema = "application_id bigint, prob_default double, prediction_class int"
    frames = []
    for kind, path in paths.items():
        reader = t.spark.read.schema(schema)
        reader = reader.option("header", True) if kind == "csv" else reader
        frames.append(reader.format(kind).load(path).withColumn("format", F.lit(kind)))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("sink_features")
def sink_features(t: Tables):
    from creditlens.operators import features as fe

    # Every step reads all rows: they are dealt over all cores once, and once derived.
    apps = staged(t.feed, "applications", FILE_ROWS)
    derived = staged(fe.complete_numbers(fe.derive_job(apps), fe.SCALED), "derived", FILE_ROWS)
    vectors = fe.fit_features(derived).transform(derived)
    split = fe.split_by_hash(vectors, "application_id").select("application_id", "features", "loan_status", "split")
    return writers.save_features(
        split.where(F.col("split") == "train"),
        split.where(F.col("split") == "test"),
        run_folder(t.spark, "features"),
        AS_OF,
        "feature-engineering",
        ["encoder", "scaler", "assembler"],
    )


@query("sink_report", uses=("feed_dup",), sql=CONSISTENCY_SQL)
def sink_report(t: Tables):
    path = f"{run_folder(t.spark, 'report')}/consistency"
    writers.save_report(quality.consistency(t.feed_dup), path)
    schema = "rule string, inconsistent_records bigint, percentage double, consistency_score double"
    return rounded(t.spark.read.schema(schema).json(path), "percentage", "consistency_score")


@query("event_roundtrip", uses=("feed",), sql=f"SELECT {COLUMNS} FROM feed")
def event_roundtrip(t: Tables):
    path = f"{run_folder(t.spark, 'events')}/validated"
    events.to_events(t.feed, events.VALIDATED).write.json(path)
    received = t.spark.read.schema(EVENT_ENVELOPE).json(path)
    return events.from_events(received, APPLICATION, events.VALIDATED)


@query(
    "cleaned_processing",
    uses=("feed",),
    sql=f"SELECT '{AS_OF}' AS processing_date, 'data-ingestion' AS job_name, count(*) AS rows FROM feed",
)
def cleaned_processing(t: Tables):
    marked = writers.with_processing_columns(t.feed, AS_OF, "data-ingestion", 1.0)
    return as_text(
        marked.groupBy("processing_date", "job_name").agg(F.count(F.lit(1)).alias("rows")), "processing_date"
    )

