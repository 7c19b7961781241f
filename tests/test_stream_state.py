"""Score cache, event correlation, change capture and late rows against plain loops, in any batching."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from creditlens.operators.tables import audit_diff
from creditlens.plans import streams
from creditlens.session import run_folder
from creditlens.streaming import correlate, flow, late, state

START = datetime(2024, 1, 1)


def feed(spark, parts, schema, run):
    """The last result of running over parts that arrive one after another."""
    folder, result = run_folder(spark, "feed"), None
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        result = run(spark.readStream.schema(schema).parquet(folder))
    return result


def plain_cache(events, days=7):
    held, out = {}, {}
    for key, number, at, score in sorted(events, key=lambda e: (e[2], e[1])):
        since = held.get(key)
        hit = since is not None and at < since[0] + timedelta(days=days)
        if not hit:
            held[key] = (at, score)
        out[number] = (key, held[key][1], held[key][0], hit)
    return out


@pytest.mark.parametrize("cuts", [[], [20, 45], [10, 30, 55, 80]])
def test_scores_hold_for_seven_days(spark, cuts):
    rng = random.Random(4)
    events = [(rng.choice("abc"), i, START + timedelta(hours=6 * i + rng.randrange(6)), rng.choice([0.25, 0.5, None])) for i in range(100)]
    schema = "segment string, application_id long, event_time timestamp, score double"
    edges = [0, *cuts, len(events)]
    parts = [rng.sample(events[a:b], b - a) for a, b in zip(edges, edges[1:])]
    base = run_folder(spark, "cache")
    found = feed(spark, parts, schema, lambda s: flow.run_rows(state.cached_scores(s, F.col("segment"), F.col("score")), "cache", base))
    ours = {r["application_id"]: (r["cache_key"], r["risk_score"], r["scored_at"], r["cache_hit"]) for r in found.collect()}
    assert ours == plain_cache(events) and found.count() == 100


def test_expired_entries_leave_the_state(spark):
    """Keys that come once are forgotten when the watermark has passed their week."""
    schema = "segment string, application_id long, event_time timestamp, score double"
    parts = [[(f"k{i}", i, START + timedelta(days=30 * part, minutes=i), 0.5) for i in range(50 * part, 50 * part + 50)] for part in range(3)]
    folder, base, sizes = run_folder(spark, "feed"), run_folder(spark, "cache"), []
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        stream = state.cached_scores(spark.readStream.schema(schema).parquet(folder), F.col("segment"), F.col("score"))
        query = stream.writeStream.format("noop").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        held = spark.read.format("statestore").option("stateVarName", "score").load(f"{base}/state")
        sizes.append(held.count())
    # The part before is gone once the next has moved the watermark.
    assert sizes == [50, 50, 50]


def test_events_of_an_application_meet(spark):
    far = START + timedelta(days=400)
    submitted = [(i, START + timedelta(hours=i)) for i in range(8)] + [(-1, far)]
    scored = [(0, START + timedelta(hours=1), 0.1), (1, START + timedelta(days=1, hours=1), 0.2), (2, START + timedelta(days=5), 0.3)]
    scored += [(4, START - timedelta(hours=1), 0.4), (5, START + timedelta(hours=6), 0.5), (9, START, 0.9), (-1, far, 0.0)]
    decided = [(0, START + timedelta(days=2), "A"), (3, START + timedelta(days=3), "B"), (5, START + timedelta(days=9), "C"), (-1, far, "Z")]
    base, folder, found = run_folder(spark, "meet"), run_folder(spark, "feed"), None
    schemas = {
        "submitted": "application_id long, created_at timestamp",
        "scored": "application_id long, prediction_timestamp timestamp, risk_score double",
        "decided": "application_id long, decision_timestamp timestamp, decision string",
    }
    tables = {"submitted": submitted, "scored": scored, "decided": decided}
    for part in range(2):
        streams = {}
        for name, rows in tables.items():
            # The second part holds what is far ahead.
            own = [r for r in rows if (r[0] == -1) == (part == 1)]
            spark.createDataFrame(own, schemas[name]).write.mode("append").parquet(f"{folder}/{name}")
            streams[name] = spark.readStream.schema(schemas[name]).parquet(f"{folder}/{name}")
        found = flow.run_rows(correlate.correlated(**streams), "meet", base)
    outcome = {r["application_id"]: (r["risk_score"], r["decision"], r["outcome"]) for r in found.where("application_id >= 0").collect()}
    assert outcome == {
        0: (0.1, "A", "COMPLETE"),
        1: (0.2, None, "AWAITING_DECISION"),
        2: (None, None, "LOST"),
        3: (None, "B", "DECIDED_UNSCORED"),
        4: (None, None, "LOST"),
        5: (0.5, None, "AWAITING_DECISION"),
        6: (None, None, "LOST"),
        7: (None, None, "LOST"),
    }


@pytest.mark.parametrize("batches", [1, 3])
def test_capture_equals_the_snapshot_diff(spark, batches):
    rng = random.Random(8)
    old = {i: (rng.choice(["x", None]), rng.randrange(3)) for i in range(40)}
    new = {i: (rng.choice(["x", None]), rng.randrange(3)) for i in range(20, 60)}
    images = [(i, *v, 0, False) for i, v in old.items()] + [(i, *v, 1, False) for i, v in new.items()]
    images += [(i, None, None, 1, True) for i in old if i not in new]
    schema = "id long, name string, amount int, version int, deleted boolean"
    images.sort(key=lambda r: r[3])
    step = -(-len(images) // batches)
    # Everything is delivered twice, and at the end an old image once more.
    parts = [images[i : i + step] * 2 for i in range(0, len(images), step)] + [images[:5]]
    base = run_folder(spark, "capture")
    found = feed(spark, parts, schema, lambda s: flow.run_rows(state.captured_changes(s, "id", ["name", "amount"], "version", "deleted", "e"), "capture", base))
    frames = [spark.createDataFrame([(i, *v) for i, v in side.items()], "id long, name string, amount int") for side in (old, new)]
    expected = audit_diff(*frames, "id", "e")
    ours = found.where("version = 1").drop("version")
    assert sorted(map(str, ours.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    first = found.where("version = 0")
    assert first.count() == len(old) and {r["action"] for r in first.collect()} == {"INSERT"}


def test_late_rows_are_kept_apart(spark):
    def row(i, hours):
        return (i, START + timedelta(hours=hours) if hours is not None else None, "AUTO_APPROVE", 100.0, 0.5)

    schema = "application_id long, event_time timestamp, decision string, loan_amnt double, risk_score double"
    parts = [[row(0, 0), row(1, 50), row(2, None)], [row(3, 25.9), row(4, 26), row(5, 50.5), row(6, 200)], [row(7, 175), row(8, 176)]]
    base = run_folder(spark, "late")
    totals, rows = feed(spark, parts, schema, lambda s: late.run_hourly(s, base=base))
    assert {r["application_id"]: r["watermark"] for r in rows.collect()} == {
        2: None,
        3: START + timedelta(hours=26),
        7: START + timedelta(hours=176),
    }
    counted = {r["hour"]: (r["total_applications"], r["total_loan_amount"], r["average_risk_score"]) for r in totals.collect()}
    assert counted == {
        START: (1, 100.0, 0.5),
        START + timedelta(hours=50): (2, 200.0, 0.5),
        START + timedelta(hours=26): (1, 100.0, 0.5),
        START + timedelta(hours=200): (1, 100.0, 0.5),
        START + timedelta(hours=176): (1, 100.0, 0.5),
    }


def test_large_parts_arrive_in_pieces(spark, tables, monkeypatch):
    """A join holds one arrival in state; what is cut finer by time gives the same rows."""
    orders = tables.given("orders")
    assert streams.arrival_cuts(orders, "o_orderdate") == list(streams.ARRIVALS)
    whole = streams.stream_correlate(tables)
    monkeypatch.setattr(streams, "ARRIVAL_ROWS", 300)
    cuts = streams.arrival_cuts(orders, "o_orderdate")
    sizes = [r["count"] for r in orders.groupBy(streams.part_of(F.col("o_orderdate"), cuts).alias("part")).count().collect()]
    assert max(sizes) <= 310 and set(streams.ARRIVALS) <= set(cuts) and sum(sizes) == orders.count()
    pieces = streams.stream_correlate(tables)
    assert pieces.exceptAll(whole).isEmpty() and whole.exceptAll(pieces).isEmpty() and whole.count() == orders.count()


def test_capture_keeps_many_entities_in_one_value(spark, monkeypatch):
    """Few values in the state, one call for each; deleted and null entities too, in any batching."""
    monkeypatch.setattr(state, "GROUPS", 4)
    schema = "id long, name string, version int, deleted boolean"
    parts = [[(i if i else None, f"n{i}", 0, False) for i in range(300)], [(i if i else None, f"n{i % 50}", 1, i % 3 == 1) for i in range(300)]]
    base = run_folder(spark, "capture")
    found = feed(spark, [parts[0][:99], parts[0][99:] + parts[1][:50], parts[1][50:], parts[0]], schema, lambda s: flow.run_rows(state.captured_changes(s, "id", ["name"], "version", "deleted", "e"), "capture", base, state.STORE))
    held = spark.read.format("statestore").option("stateVarName", "images").load(f"{base}/state")
    assert held.count() == 4
    expected = {"INSERT": 300, "DELETE": sum(i % 3 == 1 for i in range(300)), "UPDATE": sum(i % 3 != 1 and i >= 50 for i in range(300))}
    assert {r["action"]: r["count"] for r in found.groupBy("action").count().collect()} == expected
    assert found.where("entity_id IS NULL").count() == 1
