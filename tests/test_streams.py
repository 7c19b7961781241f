"""Streams over several files and batches give what the batch operators give."""

import time

import pytest
from pyspark.sql import functions as F

from creditlens.functions import scoring
from creditlens.operators.portfolio import portfolio_totals
from creditlens.session import run_folder
from creditlens.streaming import flow


@pytest.fixture(scope="module")
def submitted(spark, tables):
    """The applications as several JSON files, and a stream that takes them one by one."""
    path = run_folder(spark, "submitted")
    tables.apps.repartition(4).write.json(path)
    schema = tables.apps.schema
    return spark.read.schema(schema).json(path), lambda: (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)
    )


def rows(df):
    return sorted(map(str, df.collect()))


def test_validated_scored_and_decided(submitted):
    batch, stream = submitted
    columns = ["application_id", "risk_score", "decision", "rule_fired"]
    assert rows(flow.run_rows(flow.decided(stream()).select(*columns), "d")) == rows(flow.decided(batch).select(*columns))
    errors = ["application_id", "failed_phase", "errors"]
    assert rows(flow.run_rows(flow.rejected(stream()).select(*errors), "r")) == rows(flow.rejected(batch).select(*errors))


def test_accepted_and_rejected_are_all(submitted):
    batch, _ = submitted
    assert flow.accepted(batch).count() + flow.rejected(batch).count() == batch.count()


def test_totals_over_many_batches(submitted):
    batch, stream = submitted
    ours = flow.run_totals(portfolio_totals(flow.decided(stream())), "t").first().asDict()
    theirs = portfolio_totals(flow.decided(batch)).first().asDict()
    assert {k: pytest.approx(v) for k, v in theirs.items()} == ours


def test_hourly_totals_over_many_batches(submitted):
    batch, stream = submitted
    ours = flow.run_totals(flow.hourly_totals(stream(), delay="5000 days"), "h", key="hour")
    theirs = portfolio_totals(flow.decided(batch), F.date_trunc("hour", F.col("created_at").cast("timestamp")).alias("hour"))
    assert rows(ours.select("hour", "total_applications", "total_loan_amount")) == rows(
        theirs.select("hour", "total_applications", "total_loan_amount")
    )


def test_late_rows_beyond_the_watermark_are_dropped(spark, tables):
    path = run_folder(spark, "late")
    recent = tables.apps.where("created_at >= '2001-01-01'")
    old = tables.apps.where("created_at < '1996-01-01'")
    # Spark judges lateness by the watermark before the last, so the old rows come third.
    for part in (recent.where("loan_status = 0"), recent.where("loan_status = 1"), old):
        part.coalesce(1).write.mode("append").json(path)
        time.sleep(1.1)
    stream = spark.readStream.schema(recent.schema).option("maxFilesPerTrigger", 1).json(path)
    ours = flow.run_totals(flow.hourly_totals(stream, delay="365 days"), "l", key="hour")
    assert ours.agg(F.sum("total_applications")).first()[0] == flow.accepted(recent).count()


def test_feature_sets_once(submitted):
    batch, stream = submitted
    once = flow.run_rows(flow.distinct_feature_sets(stream(), keep="5000 days").select("cache_key"), "k")
    assert rows(once) == rows(batch.select(scoring.cache_key().alias("cache_key")).distinct())


def test_a_batch_run_twice_overwrites_itself(spark, tables):
    base = run_folder(spark, "again")
    frame = tables.apps.select("application_id")
    flow._write_batch(frame, 3, base)
    flow._write_batch(frame, 3, base)
    assert spark.read.parquet(f"{base}/rows").count() == frame.count()


def test_a_second_run_goes_on_where_the_first_ended(spark, tables):
    """New files reach rows, totals and tables once, with the same base folder."""
    source, base = run_folder(spark, "restart"), run_folder(spark, "restart-base")
    schema = tables.apps.schema
    first, second = tables.apps.where("application_id % 2 = 0"), tables.apps.where("application_id % 2 = 1")
    seen = None
    for part, so_far in ((first, first), (second, tables.apps)):
        part.coalesce(1).write.mode("append").json(source)

        def stream():
            return spark.readStream.schema(schema).json(source)

        ids = flow.run_rows(flow.accepted(stream()).select("application_id"), "r", f"{base}/rows")
        assert rows(ids) == rows(flow.accepted(so_far).select("application_id"))
        totals = flow.run_totals(portfolio_totals(flow.decided(stream())), "t", base=f"{base}/totals").first()
        assert totals["total_applications"] == flow.accepted(so_far).count()
        hourly = flow.run_totals(flow.hourly_totals(stream(), delay="5000 days"), "h", key="hour", base=f"{base}/hourly")
        assert hourly.agg(F.sum("total_applications")).first()[0] == flow.accepted(so_far).count()
        stored = flow.run_process(flow.decided(stream()), base=f"{base}/process")
        seen = {name: frame.select("application_id").count() for name, frame in stored.items()}
        assert set(seen.values()) == {flow.accepted(so_far).count()}
    assert flow.run_totals(portfolio_totals(flow.decided(spark.readStream.schema(schema).json(source))), "t", base=f"{base}/totals").count() == 1


def test_a_model_scores_a_stream(spark, tables, submitted):
    from pyspark.ml import PipelineModel

    from creditlens.operators import models

    batch, stream = submitted
    ready, vectors, statistics = models.prepare(tables.apps)
    model = PipelineModel(stages=[*vectors.stages, models.forest(3, 3).fit(models.part(ready, "train"))])
    scored = flow.run_rows(flow.model_scored(stream(), model, statistics).select("application_id", "risk_score"), "m")
    direct = models.predict(model, flow.accepted(batch), statistics).select("application_id", F.col("prob_default").alias("risk_score"))
    assert rows(scored) == rows(direct)
