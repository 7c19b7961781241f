"""Queries: the application flow as streams over the given orders.

Each runs a real streaming query to the end of what is there; its result is what
the sink holds. The checks compute the same from the tables.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.plans.decisions import STATUS_SQL
from creditlens.plans.fixture_sql import CACHE_KEY, RULE_SCORE
from creditlens.plans.fixtures import AS_OF, FEATURES, GIVEN, Tables, applications_from
from creditlens.plans.portfolio import TOTALS_SQL
from creditlens.plans.tables import _json_sql
from creditlens.plans.registry import query
from creditlens.plans.shape import joined, rounded
from creditlens.plans.validation import TYPES_SQL, _required_sql
from creditlens.functions import scoring
from creditlens.operators.portfolio import portfolio_totals
from creditlens.schemas import REQUIRED_FIELDS
from creditlens.session import run_folder
from creditlens.sources.readers import stream_table
from creditlens.streaming import correlate, flow, late, state


def submitted(t: Tables):
    """Orders as a stream of applications, joined with the customers at rest."""
    orders = stream_table(t.spark, t.folder, "orders", GIVEN["orders"])
    return applications_from(orders, t.given("customer"))


#: The given orders arrive in parts, cut at these times; each part is a run of the stream.
ARRIVALS = ("1997-01-01", "1999-01-01", "2001-01-01")


#: About the most submissions that arrive together where events are joined: a join holds a whole arrival in state.
ARRIVAL_ROWS = 4_000_000


def part_of(time: Column, cuts=ARRIVALS) -> Column:
    """The part that an event of this time arrives in."""
    return sum((F.when(time >= F.lit(cut).cast("timestamp_ntz"), 1).otherwise(0) for cut in cuts), F.lit(0))


def arrival_cuts(frame: DataFrame, time: str) -> list[str]:
    """``ARRIVALS``, and further cuts in time where a part has more than ``ARRIVAL_ROWS`` rows."""
    cuts = list(ARRIVALS)
    for part, rows in frame.groupBy(part_of(F.col(time))).count().collect():
        if rows > ARRIVAL_ROWS:
            shares = [k * ARRIVAL_ROWS / rows for k in range(1, -(-rows // ARRIVAL_ROWS))]
            at = frame.where(part_of(F.col(time)) == part).select(F.percentile_approx(time, shares, 100_000).alias("at"))
            cuts += [str(x) for x in at.first()["at"] or []]
    return sorted(set(cuts))


def part_sql(time: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {time} >= TIMESTAMP '{cut}' THEN 1 ELSE 0 END" for cut in ARRIVALS) + ")"


def replayed(t: Tables, tables: dict, run, parts: int = len(ARRIVALS) + 1):
    """Let the parts of the tables arrive one after another and run the stream after each.

    ``tables`` has a frame and its part by name; ``run`` gets the streams and goes on where
    it ended before. Its last result counts.
    """
    folder, result = run_folder(t.spark, "arrivals"), None
    # Each table is derived once; an arrival copies the rows of its part.
    dealt = {}
    for name, (frame, number) in tables.items():
        numbered = frame.withColumn("part", number.cast("int"))
        numbered.write.partitionBy("part").parquet(f"{folder}/parts/{name}")
        dealt[name] = t.spark.read.schema(numbered.schema).parquet(f"{folder}/parts/{name}")
    for part in range(parts):
        streams = {}
        for name, (frame, _) in tables.items():
            dealt[name].where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{folder}/{name}")
            streams[name] = t.spark.readStream.schema(frame.schema).parquet(f"{folder}/{name}")
        result = run(streams)
    return result


VALID = f"({_required_sql(REQUIRED_FIELDS)} = '' AND {TYPES_SQL} = '')"


@query(
    "stream_validate",
    uses=("apps",),
    sql=f"""SELECT application_id, CASE WHEN required <> '' THEN 'required' WHEN types <> '' THEN 'types' ELSE 'accepted' END AS outcome,
  CASE WHEN required <> '' THEN required ELSE types END AS errors
FROM (SELECT application_id, {_required_sql(REQUIRED_FIELDS)} AS required, {TYPES_SQL} AS types FROM apps)""",
)
def stream_validate(t: Tables):
    checked = flow.validate(submitted(t)).select(
        "application_id", F.coalesce("failed_phase", F.lit("accepted")).alias("outcome"), "errors"
    )
    return joined(flow.run_rows(checked, "validate"), "errors")


@query("stream_score", uses=("scored",), sql=f"SELECT application_id, risk_score FROM scored WHERE {VALID}")
def stream_score(t: Tables):
    return flow.run_rows(flow.scored(submitted(t)).select("application_id", "risk_score"), "score")


@query(
    "stream_decide",
    uses=("decided",),
    sql=f"SELECT application_id, risk_score, decision, fired AS rule_fired, risk_level FROM decided WHERE {VALID}",
)
def stream_decide(t: Tables):
    chosen = flow.decided(submitted(t)).select("application_id", "risk_score", "decision", "rule_fired", "risk_level")
    return flow.run_rows(chosen, "decide")


@query(
    "stream_process",
    uses=("decided",),
    sql=f""", valid AS (SELECT *, {STATUS_SQL} AS status FROM decided WHERE {VALID})
SELECT 'applications' AS table_name, CASE WHEN status = 'PENDING_REVIEW' THEN 'MANUAL_REVIEW' ELSE status END AS outcome, count(*) AS rows FROM valid GROUP BY ALL
UNION ALL SELECT 'risk_scores', risk_level, count(*) FROM valid GROUP BY ALL
UNION ALL SELECT 'decisions', CASE decision WHEN 'AUTO_APPROVE' THEN 'APPROVE' WHEN 'AUTO_REJECT' THEN 'REJECT' ELSE 'MANUAL_REVIEW' END, count(*) FROM valid GROUP BY ALL""",
)
def stream_process(t: Tables):
    stored = flow.run_process(flow.decided(submitted(t)))
    outcome = {"applications": "status", "risk_scores": "risk_category", "decisions": "decision"}
    counted = [
        stored[name]
        .groupBy(F.lit(name).alias("table_name"), F.col(column).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("rows"))
        for name, column in outcome.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("stream_portfolio", uses=("decided",), sql=f"SELECT {TOTALS_SQL} FROM decided WHERE {VALID}")
def stream_portfolio(t: Tables):
    totals = flow.run_totals(portfolio_totals(flow.decided(submitted(t))), "portfolio")
    return rounded(totals, "average_risk_score")


@query(
    "stream_hourly",
    uses=("decided",),
    sql=f"SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S') AS hour, {TOTALS_SQL} FROM decided WHERE {VALID} GROUP BY 1",
)
def stream_hourly(t: Tables):
    # The given orders are in no order of time, so the delay covers all of it.
    totals = flow.run_totals(flow.hourly_totals(submitted(t), delay="5000 days"), "hourly", key="hour")
    return rounded(totals, "average_risk_score").withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


@query("stream_dedup", uses=("apps",), sql=f"SELECT DISTINCT {CACHE_KEY} AS cache_key FROM apps")
def stream_dedup(t: Tables):
    once = flow.distinct_feature_sets(submitted(t), keep="5000 days").select("cache_key")
    return flow.run_rows(once, "dedup")


@query(
    "ttl_retention",
    uses=("apps",),
    sql=" UNION ALL ".join(
        f"""SELECT '{name}' AS retention, count(*) AS rows, CAST(max(epoch(created_at)) AS BIGINT) + {hours} * 3600 AS last_ttl FROM apps
WHERE epoch(created_at) + {hours} * 3600 > epoch(TIMESTAMP '{AS_OF}')"""
        for name, hours in (("1d", 24), ("7d", 168), ("30d", 720), ("90d", 2160))
    ),
)
def ttl_retention(t: Tables):
    frames = [
        flow.retain(t.apps, AS_OF, "created_at", hours).agg(
            F.lit(name).alias("retention"), F.count(F.lit(1)).alias("rows"), F.max("ttl").alias("last_ttl")
        )
        for name, hours in (("1d", 24), ("7d", 168), ("30d", 720), ("90d", 2160))
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query(
    "stream_alerts",
    uses=("scored",),
    sql=f"SELECT application_id, risk_score, 'HIGH_RISK' AS alert_type, risk_level FROM scored WHERE risk_score > 0.7::DOUBLE AND {VALID}",
)
def stream_alerts(t: Tables):
    return flow.run_rows(flow.risk_alerts(submitted(t)), "alerts")


#: A coarse feature set, so that many applications share one.
SEGMENT = ["loan_grade", "person_home_ownership", "cb_person_default_on_file"]


@query(
    "stream_score_cache",
    uses=("apps",),
    sql=f"""SELECT * FROM (WITH RECURSIVE given AS (SELECT application_id, created_at, concat_ws('_', {", ".join(SEGMENT)}) AS cache_key, {RULE_SCORE} AS score FROM apps),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY created_at, application_id) AS n FROM given),
walk AS (SELECT cache_key, n, application_id, created_at, score AS risk_score, created_at AS since, false AS cache_hit FROM numbered WHERE n = 1
  UNION ALL SELECT g.cache_key, g.n, g.application_id, g.created_at,
    CASE WHEN g.created_at < w.since + INTERVAL 7 DAY THEN w.risk_score ELSE g.score END,
    CASE WHEN g.created_at < w.since + INTERVAL 7 DAY THEN w.since ELSE g.created_at END, g.created_at < w.since + INTERVAL 7 DAY
  FROM walk w JOIN numbered g ON g.cache_key = w.cache_key AND g.n = w.n + 1)
SELECT cache_key, application_id, risk_score, strftime(since, '%Y-%m-%d %H:%M:%S') AS scored_at, cache_hit FROM walk)""",
)
def stream_score_cache(t: Tables):
    """A score holds for seven days of event time; state forgets it afterwards."""
    base = run_folder(t.spark, "score-cache")

    def run(streams):
        timed = streams["apps"].withColumn("event_time", F.col("created_at").cast("timestamp"))
        found = state.cached_scores(timed, F.concat_ws("_", *SEGMENT), scoring.rule_score())
        return flow.run_rows(found, "score-cache", base, state.STORE)

    apps = t.apps.select("application_id", *FEATURES, "created_at")
    found = replayed(t, {"apps": (apps, part_of(F.col("created_at")))}, run)
    return found.select("cache_key", "application_id", "risk_score", F.date_format("scored_at", "yyyy-MM-dd HH:mm:ss").alias("scored_at"), "cache_hit")


@query(
    "stream_correlate",
    uses=("apps", "risk_scores", "decisions"),
    sql="""SELECT a.application_id, strftime(r.prediction_timestamp, '%Y-%m-%d %H:%M:%S') AS scored_at, r.risk_score,
  strftime(d.decision_timestamp, '%Y-%m-%d %H:%M:%S') AS decided_at, d.decision,
  CASE WHEN r.application_id IS NULL AND d.application_id IS NULL THEN 'LOST' WHEN r.application_id IS NULL THEN 'DECIDED_UNSCORED'
    WHEN d.application_id IS NULL THEN 'AWAITING_DECISION' ELSE 'COMPLETE' END AS outcome
FROM apps a LEFT JOIN (SELECT * FROM risk_scores WHERE model_version = '1.1') r
  ON r.application_id = a.application_id AND r.prediction_timestamp BETWEEN a.created_at AND a.created_at + INTERVAL 2 DAY
LEFT JOIN decisions d ON d.application_id = a.application_id AND d.decision_timestamp BETWEEN a.created_at AND a.created_at + INTERVAL 3 DAY""",
)
def stream_correlate(t: Tables):
    """Submissions with their model score and decision, and those that never got one."""
    base = run_folder(t.spark, "correlate")
    end = F.lit("2100-01-01").cast("timestamp_ntz")

    def closed(frame, time: str):
        """With a last event far ahead, that moves the watermark past all others."""
        nothing = {f.name: F.lit(None).cast(f.dataType) for f in frame.schema}
        last = t.spark.range(1).select(*[{**nothing, "application_id": F.lit(-1).cast("long"), time: end}[c].alias(c) for c in frame.columns])
        return frame.unionByName(last), part_of(F.col(time), cuts)

    cuts = arrival_cuts(t.given("orders"), "o_orderdate")
    tables = {
        "submitted": closed(t.apps.select("application_id", "created_at"), "created_at"),
        "scored": closed(
            t.risk_scores.where("model_version = '1.1'").select("application_id", "prediction_timestamp", "risk_score"), "prediction_timestamp"
        ),
        "decided": closed(t.decisions.select("application_id", "decision_timestamp", "decision"), "decision_timestamp"),
    }

    def run(streams):
        return flow.run_rows(correlate.correlated(**streams), "correlate", base)

    found = replayed(t, tables, run, len(cuts) + 1).where("application_id >= 0")
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("scored_at", "decided_at")}
    return found.withColumns(times).drop("submitted_at")


@query(
    "stream_audit",
    uses=("snapshot_old", "snapshot_new"),
    sql=f"""SELECT CASE WHEN o.application_id IS NULL THEN 'INSERT' WHEN n.application_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
  'applications' AS entity_type, coalesce(o.application_id, n.application_id)::VARCHAR AS entity_id,
  {_json_sql('o')} AS old_value, {_json_sql('n')} AS new_value, 1::BIGINT AS version
FROM snapshot_old o FULL JOIN snapshot_new n ON o.application_id = n.application_id
WHERE o.application_id IS NULL OR n.application_id IS NULL OR o.loan_amnt IS DISTINCT FROM n.loan_amnt
UNION ALL SELECT 'INSERT', 'applications', o.application_id::VARCHAR, NULL, {_json_sql('o')}, 0 FROM snapshot_old o""",
)
def stream_audit(t: Tables):
    """Change capture over a feed of row images: the old snapshot, then the new one with what is gone."""

    def exact(df):
        return df.withColumns({c: F.col(c).cast("decimal(12,2)").cast("string") for c in ("person_income", "loan_amnt", "loan_int_rate")})

    old, new = exact(t.snapshot_old), exact(t.snapshot_new)
    gone = old.join(new.select("application_id"), "application_id", "left_anti")
    columns = [c for c in old.columns if c != "application_id"]
    images = old.withColumns({"version": F.lit(0), "deleted": F.lit(False)})
    images = images.unionByName(new.withColumns({"version": F.lit(1), "deleted": F.lit(False)}))
    images = images.unionByName(gone.withColumns({"version": F.lit(1), "deleted": F.lit(True)}))
    base = run_folder(t.spark, "audit")

    def run(streams):
        changes = state.captured_changes(streams["images"], "application_id", columns, "version", "deleted", "applications")
        return flow.run_rows(changes, "audit", base, state.STORE)

    # Each version arrives in two parts.
    return replayed(t, {"images": (images, F.col("version") * 2 + F.pmod(F.col("application_id"), F.lit(2)))}, run)


#: Every seventh application arrives one part later than its time says.
ARRIVAL_SQL = f""", arriving AS (SELECT *, {part_sql("created_at")} + CASE WHEN application_id % 7 = 0 AND {part_sql("created_at")} < {len(ARRIVALS)} THEN 1 ELSE 0 END AS part
  FROM decided WHERE {VALID}),
marks AS (SELECT p.part, (SELECT max(created_at) FROM arriving b WHERE b.part < p.part) - INTERVAL 1 DAY AS watermark FROM (SELECT DISTINCT part FROM arriving) p),
marked AS (SELECT *, watermark IS NOT NULL AND created_at < watermark AS late FROM arriving JOIN marks USING (part))"""


def _hourly_with_late(t: Tables):
    base = run_folder(t.spark, "hourly")
    moved = part_of(F.col("o_orderdate"))
    moved = moved + F.when((F.col("o_orderkey") % 7 == 0) & (moved < len(ARRIVALS)), 1).otherwise(0)

    def run(streams):
        decided = flow.decided(applications_from(streams["orders"], t.given("customer")))
        return late.run_hourly(decided.withColumn("event_time", F.col("created_at").cast("timestamp")), base=base)

    return replayed(t, {"orders": (t.given("orders"), moved)}, run)


@query(
    "stream_hourly_on_time",
    uses=("decided",),
    sql=f"""{ARRIVAL_SQL} SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S') AS hour, {TOTALS_SQL} FROM marked WHERE NOT late GROUP BY 1""",
)
def stream_hourly_on_time(t: Tables):
    totals, _ = _hourly_with_late(t)
    return rounded(totals, "average_risk_score").withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


@query(
    "stream_late_rows",
    uses=("decided",),
    sql=f"""{ARRIVAL_SQL} SELECT application_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS event_time, strftime(watermark, '%Y-%m-%d %H:%M:%S') AS watermark FROM marked WHERE late""",
)
def stream_late_rows(t: Tables):
    _, rows = _hourly_with_late(t)
    return rows.select("application_id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("event_time", "watermark")])


@query(
    "stream_process_rows",
    uses=("decided",),
    sql=f""", valid AS (SELECT *, {STATUS_SQL} AS final FROM decided WHERE {VALID})
SELECT application_id, CASE WHEN final = 'PENDING_REVIEW' THEN 'MANUAL_REVIEW' ELSE final END AS status, risk_score, risk_level AS risk_category,
  CASE decision WHEN 'AUTO_APPROVE' THEN 'APPROVE' WHEN 'AUTO_REJECT' THEN 'REJECT' ELSE 'MANUAL_REVIEW' END AS decision FROM valid""",
)
def stream_process_rows(t: Tables):
    """The three stored tables of the processed applications, joined."""
    stored = flow.run_process(flow.decided(submitted(t)))
    return (
        stored["applications"].select("application_id", "status")
        .join(stored["risk_scores"].select("application_id", "risk_score", "risk_category"), "application_id")
        .join(stored["decisions"].select("application_id", "decision"), "application_id")
    )


@query(
    "stream_model_score",
    uses=("apps",),
    sql=f"SELECT application_id, true AS scored, true AS as_in_a_batch FROM apps WHERE {VALID}",
)
def stream_model_score(t: Tables):
    """Applications scored on a stream by a fitted model, each beside its score in a batch."""
    from pyspark.ml import PipelineModel

    from creditlens.operators import models

    ready, vectors, statistics = models.prepare(t.apps)
    model = PipelineModel(stages=[*vectors.stages, models.forest(20, 5).fit(models.part(ready, "train"))])
    found = flow.run_rows(flow.model_scored(submitted(t), model, statistics).select("application_id", "risk_score"), "model-score")
    batch = models.predict(model, flow.accepted(t.apps), statistics).select("application_id", F.col("prob_default").alias("own"))
    # Both follow from the row alone, so they agree but for the last bits of sums over trees.
    same = F.abs(F.col("risk_score") - F.col("own")) < 1e-9
    return found.join(batch, "application_id").select("application_id", F.col("risk_score").between(0, 1).alias("scored"), same.alias("as_in_a_batch"))
