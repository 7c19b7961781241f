"""Cleaning, updates, audit, cache and files on small tables."""

import pytest
from pyspark.sql import functions as F

from creditlens.operators import cleaning, features, monitoring
from creditlens.operators import tables as ops
from creditlens.session import run_folder, shared_folder
from creditlens.sources import events, readers, writers


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")
    one, two = run_folder(spark, "x"), run_folder(spark, "x")
    assert one != two and one.startswith(shared_folder(spark))


def test_caps_and_floors_keep_nulls(spark):
    frame = spark.createDataFrame([(101, -1.0, None, -5.0), (None, None, 51.0, None)], "person_age int, person_income double, person_emp_length double, loan_amnt double")
    rows = cleaning.floor_amounts(cleaning.cap_constants(frame)).collect()
    assert [tuple(r) for r in rows] == [(100, 0.0, None, 0.0), (None, None, 50.0, None)]


def test_group_median_leaves_unknown_groups(spark):
    frame = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("A", None), ("B", None), (None, None)], "loan_grade string, loan_int_rate double")
    found = sorted(map(str, (tuple(r) for r in cleaning.impute_rate_by_grade(frame).collect())))
    assert found == sorted(map(str, [("A", 1.0), ("A", 3.0), ("A", 2.0), ("B", None), (None, None)]))


def test_coercion_turns_text_into_null(spark):
    frame = spark.createDataFrame([("25", "?"), ("abc", "12.5"), ("25.0", None)], "person_age string, loan_int_rate string")
    assert [tuple(r) for r in cleaning.coerce_numeric(frame).collect()] == [(25, None), (None, 12.5), (25, None)]


def test_latest_per_key_breaks_ties(spark):
    frame = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 0, 9)], "k string, ts int, id int")
    assert sorted(tuple(r) for r in ops.latest_per_key(frame, "k", "ts", "id").collect()) == [("a", 2, 3), ("b", 0, 9)]


def test_audit_diff_is_null_safe(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, v string")
    new = spark.createDataFrame([(1, None), (2, None), (4, "z")], "id int, v string")
    rows = {r["entity_id"]: (r["action"], r["old_value"], r["new_value"]) for r in ops.audit_diff(old, new, "id", "t").collect()}
    assert rows == {
        "2": ("UPDATE", '{"id":2,"v":"x"}', '{"id":2,"v":null}'),
        "3": ("DELETE", '{"id":3,"v":"y"}', None),
        "4": ("INSERT", None, '{"id":4,"v":"z"}'),
    }


def test_constraints_pass_on_null_but_not_null_does_not(spark):
    frame = spark.createDataFrame(
        [(1, 17, None)], "application_id bigint, person_age int, person_income double"
    )
    for name in ("person_home_ownership", "loan_intent", "loan_grade", "cb_person_default_on_file", "status"):
        frame = frame.withColumn(name, F.lit("A" if name == "loan_grade" else None).cast("string"))
    for name in ("person_emp_length", "loan_amnt", "loan_int_rate", "loan_percent_income", "cb_person_cred_hist_length"):
        frame = frame.withColumn(name, F.lit(0.0))
    found = {r["constraint_name"] for r in ops.application_violations(frame).collect()}
    assert found == {
        "person_age_check",
        "person_income_not_null",
        "person_home_ownership_not_null",
        "loan_intent_not_null",
        "cb_person_default_on_file_not_null",
    }


def test_missing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="b"):
        ops.require_columns(spark.range(1).withColumnRenamed("id", "a"), ["a", "b"])


def test_arff_text(spark, tmp_path):
    (tmp_path / "d.arff").write_text(
        "% a comment\n@RELATION credit\n\n@ATTRIBUTE age NUMERIC\n@attribute grade STRING\n@DATA\n 25 , A\n\n% skipped\n?,  B \n@ home, C\n"
    )
    rows = readers.read_arff(spark, str(tmp_path))
    assert rows.columns == ["age", "grade"]
    assert sorted(tuple(r) for r in rows.collect()) == [("25", "A"), ("?", "B"), ("@ home", "C")]


def test_time_window_leaves_other_files_out(spark, tmp_path):
    spark.range(3).write.json(str(tmp_path / "a"))
    inside = readers.read_modified_between(spark, str(tmp_path), "2020-01-01T00:00:00", "2100-01-01T00:00:00", "id bigint")
    outside = readers.read_modified_between(spark, str(tmp_path), "2000-01-01T00:00:00", "2001-01-01T00:00:00", "id bigint")
    assert (inside.count(), outside.count()) == (3, 0)


def test_events_of_another_type_are_left_out(spark):
    sent = events.to_events(spark.range(2), events.SCORED).unionByName(events.to_events(spark.range(5), events.DECIDED))
    assert events.from_events(sent, "id bigint", events.SCORED).count() == 2


def test_results_in_three_formats(spark, tmp_path):
    paths = writers.save_all_formats(spark.range(4), str(tmp_path))
    assert {kind: spark.read.format(kind).options(header=True).load(path).count() for kind, path in paths.items()} == {
        "parquet": 4,
        "csv": 4,
        "json": 4,
    }


def test_monitoring_without_current_data_is_skipped(tables):
    outcome = monitoring.run_monitoring(tables.baseline, tables.current.where("false"))
    assert outcome["status"] == "SKIPPED"


def test_quality_job_reports_failure(spark):
    from creditlens.operators.quality import quality_job

    assert quality_job(spark, "/nowhere/at/all.parquet", "2001-08-02")["status"] == "FAILED"


def test_stored_tables_join_without_a_shuffle(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = ops.application_summary(tables.applications, tables.risk_scores, tables.decisions)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        latest = ops.latest_per_key(tables.risk_scores, "application_id", "prediction_timestamp", "risk_score_id")
        grouped = latest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    assert "Exchange" not in grouped
