"""Keyed streams run in a session that has none of our settings, with the driver in another folder."""

import os
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.session.timeZone", "UTC").getOrCreate())
from creditlens.session import ship
from creditlens.streaming import flow, state
ship(spark)
name = "spark.sql.streaming.stateStore.providerClass"
before = spark.conf.get(name)
rows = [(1, 10, 0, False), (2, 20, 0, False), (1, 11, 1, False), (2, 20, 1, True)]
spark.createDataFrame(rows, "id long, amount long, version long, deleted boolean").write.parquet("images")
stream = spark.readStream.schema("id long, amount long, version long, deleted boolean").parquet("images")
changes = state.captured_changes(stream, "id", ["amount"], "version", "deleted", "loans")
print("CHANGES", sorted((r.entity_id, r.version, r.action) for r in flow.run_rows(changes, "audit", None, state.STORE).collect()))
times = [(1, "2020-01-01 00:00:00", .5), (2, "2020-01-02 00:00:00", .7), (3, "2020-01-09 00:00:00", .9)]
timed = spark.createDataFrame(times, "application_id long, t string, s double").select("application_id", F.col("t").cast("timestamp").alias("event_time"), "s")
timed.write.parquet("scores")
stream = spark.readStream.schema(timed.schema).parquet("scores")
found = flow.run_rows(state.cached_scores(stream, F.lit("k"), F.col("s")), "cache", None, state.STORE)
print("SCORES", sorted((r.application_id, r.risk_score, r.cache_hit) for r in found.collect()))
print("KEPT", spark.conf.get(name) == before)
spark.stop()
"""


def test_keyed_streams_need_no_settings(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "CHANGES [('1', 0, 'INSERT'), ('1', 1, 'UPDATE'), ('2', 0, 'INSERT'), ('2', 1, 'DELETE')]" in run.stdout, run.stderr[-2000:]
    assert "SCORES [(1, 0.5, False), (2, 0.5, True), (3, 0.9, False)]" in run.stdout
    assert "KEPT True" in run.stdout
