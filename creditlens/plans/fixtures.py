"""Loan tables derived from the given orders and customers.

One application per order. The driver tables have no bad values in the columns
used, so missing and impossible values come from arithmetic on the keys. Which
rows have a second score, a decision or a copy follows from their attributes.
All of it is lazy: a query reads only the columns it needs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.functions import scoring
from creditlens.schemas import COERCIONS, LOAN_GRADES, LOAN_INTENTS
from creditlens.session import run_folder
from creditlens.sources.writers import save_bucketed

#: "Now" in every query that depends on the time.
AS_OF = "2001-08-02"

FEATURES = [
    "person_age",
    "person_income",
    "person_home_ownership",
    "person_emp_length",
    "loan_intent",
    "loan_grade",
    "loan_amnt",
    "loan_int_rate",
    "loan_percent_income",
    "cb_person_default_on_file",
    "cb_person_cred_hist_length",
]
CLEAN_COLUMNS = ["application_id", *FEATURES, "loan_status"]
SNAPSHOT_COLUMNS = [
    "application_id",
    "person_age",
    "person_income",
    "loan_grade",
    "loan_amnt",
    "loan_int_rate",
    "status",
]


# One application per order; what is missing or impossible follows from the keys.
APPLICATION_EXPRESSIONS = [
    "o_orderkey AS application_id",
    "CAST(15 + o_custkey % 90 AS int) AS person_age",
    "CAST(floor(c_acctbal * 20) AS double) AS person_income",
    """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'OWN' WHEN 'MACHINERY' THEN 'MORTGAGE'
       WHEN 'HOUSEHOLD' THEN 'OTHER' ELSE 'RENT' END AS person_home_ownership""",
    "CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderkey % 60 AS double) END AS person_emp_length",
    f"element_at(array({', '.join(map(repr, LOAN_INTENTS))}), CAST(o_orderkey % 6 + 1 AS int)) AS loan_intent",
    f"element_at(array({', '.join(map(repr, LOAN_GRADES))}), CAST(o_orderkey % 7 + 1 AS int)) AS loan_grade",
    """CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE 1 END * CAST(floor(o_totalprice / 4) AS double) AS loan_amnt""",
    "CASE WHEN o_orderkey % 11 <> 0 THEN 5D + (o_orderkey % 180) / 10D END AS loan_int_rate",
    "(o_orderkey % 110) / 100D AS loan_percent_income",
    "CASE WHEN o_custkey % 7 = 0 THEN 'Y' ELSE 'N' END AS cb_person_default_on_file",
    "CAST(o_custkey % 30 AS int) AS cb_person_cred_hist_length",
    "CASE WHEN (o_orderkey % 110) * 2 + o_orderkey % 180 + (o_orderkey * 17 + o_custkey * 31) % 60 > 230 THEN 1 ELSE 0 END AS loan_status",
    "o_orderdate AS created_at",
    "CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey * 37 % 1000) / 1000D END AS model_score",
    "CASE WHEN o_orderkey % 4 <> 0 THEN concat('UW-', o_orderkey % 12) END AS underwriter_id",
    "o_orderstatus AS intake",
    "o_orderpriority AS priority",
]


def applications_from(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Applications from orders and their customers; works on streams of orders too."""
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.selectExpr(*APPLICATION_EXPRESSIONS)


#: Schemas of the given tables that are read most; they save an inference job.
GIVEN = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}

#: Stored tables by application, source folder and name.
STORED: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """The given tables of one folder and the loan tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def apps(self) -> DataFrame:
        return applications_from(self.given("orders"), self.given("customer"))

    @property
    def feed(self) -> DataFrame:
        """Applications as the cleaning jobs read them."""
        return self.apps.select(*CLEAN_COLUMNS)

    @property
    def feed_dup(self) -> DataFrame:
        """The feed with a second copy of the urgent grade-A applications."""
        again = self.apps.where((F.col("loan_grade") == "A") & (F.col("priority") == "1-URGENT"))
        return self.feed.unionByName(again.select(*CLEAN_COLUMNS))

    @property
    def raw(self) -> DataFrame:
        """The feed as text, with the faults that text brings."""
        key = F.col("application_id")

        def text(name: str) -> Column:
            # Text of a number without a decimal part where it has none.
            value = F.col(name)
            return value.cast("decimal(12,2)").cast("string") if COERCIONS[name] == "double" else value.cast("string")

        return self.apps.select(
            "application_id",
            F.when(key % 101 == 0, "abc").otherwise(text("person_age")).alias("person_age"),
            F.when(key % 107 != 0, text("person_income")).alias("person_income"),
            "person_home_ownership",
            text("person_emp_length").alias("person_emp_length"),
            "loan_intent",
            F.when(key % 103 == 0, "Z").otherwise(F.col("loan_grade")).alias("loan_grade"),
            text("loan_amnt").alias("loan_amnt"),
            F.coalesce(text("loan_int_rate"), F.lit("?")).alias("loan_int_rate"),
            text("loan_percent_income").alias("loan_percent_income"),
            "cb_person_default_on_file",
            text("cb_person_cred_hist_length").alias("cb_person_cred_hist_length"),
            "loan_status",
        )

    @cached_property
    def decided(self) -> DataFrame:
        """Applications with score and decision; the model's score where it gave one."""
        from creditlens.operators.decisions import decide, score

        return decide(score(self.apps, "model_score"))

    def _stored(self, name: str, build) -> DataFrame:
        """A table of the platform, written to the shared folder on first use.

        Repository queries read stored tables; deciding anew in each of them would
        hide their filters behind the whole decision logic. All are bucketed by
        application, on which they are joined.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in STORED:
            folder = run_folder(self.spark, "tables")
            table = f"{name}_{folder.rsplit('-', 1)[-1]}"
            STORED[key] = save_bucketed(build(), table, folder, "application_id")
        return STORED[key]

    @property
    def applications(self) -> DataFrame:
        return self._stored("applications", self._applications)

    @property
    def risk_scores(self) -> DataFrame:
        return self._stored("risk_scores", self._risk_scores)

    @property
    def decisions(self) -> DataFrame:
        return self._stored("decisions", self._decisions)

    def _applications(self) -> DataFrame:
        """The applications table, with a status that follows from intake and decision."""
        status = (
            F.when((F.col("intake") == "P") & F.col("priority").isin("1-URGENT", "2-HIGH"), "PROCESSING")
            .when(F.col("intake") == "P", "PENDING")
            .otherwise(scoring.table_status(scoring.final_status(F.col("decision"))))
        )
        return self.decided.select("application_id", *FEATURES, status.alias("status"), "created_at")

    def _risk_scores(self) -> DataFrame:
        """A rule score per application and a model score one day later where there is one."""

        def scores(source: DataFrame, version: str, value: Column, at: Column) -> DataFrame:
            return source.select(
                F.concat(F.lit("RS-"), F.col("application_id").cast("string"), F.lit(f"-{version}")).alias(
                    "risk_score_id"
                ),
                "application_id",
                value.alias("risk_score"),
                scoring.risk_level(value).alias("risk_category"),
                F.lit(version).alias("model_version"),
                F.greatest(value, F.lit(1.0) - value).alias("confidence_score"),
                at.alias("prediction_timestamp"),
                (F.lit(20) + F.col("application_id") % 180).cast("int").alias("processing_time_ms"),
            )

        first = scores(self.apps, "1.0", scoring.rule_score(), F.col("created_at"))
        again = scores(
            self.apps.where(F.col("model_score").isNotNull()),
            "1.1",
            F.col("model_score"),
            F.col("created_at") + F.expr("INTERVAL 1 DAY"),
        )
        return first.unionByName(again)

    def _decisions(self) -> DataFrame:
        """A decision per application that is past intake."""
        delay = F.make_dt_interval((F.col("application_id") % 5).cast("int"))
        return self.decided.where(F.col("intake") != "P").select(
            F.concat(F.lit("D-"), F.col("application_id").cast("string")).alias("decision_id"),
            "application_id",
            scoring.table_decision(F.col("decision")).alias("decision"),
            "decision_reason",
            "risk_score",
            "underwriter_id",
            F.lit(None).cast("string").alias("underwriter_notes"),
            (F.col("created_at") + delay).alias("decision_timestamp"),
        )

    @property
    def snapshot_old(self) -> DataFrame:
        return self.applications.select(*SNAPSHOT_COLUMNS)

    @property
    def snapshot_new(self) -> DataFrame:
        """Later state: grade-G defaulters are gone, medical loans changed, some loans are new."""
        old = self.applications
        gone = (F.col("loan_grade") == "G") & (F.col("cb_person_default_on_file") == "Y")
        changed = F.when(F.col("loan_intent") == "MEDICAL", F.col("loan_amnt") + 500).otherwise(F.col("loan_amnt"))
        kept = old.where(~gone).withColumn("loan_amnt", changed)
        added = old.where(
            (F.col("loan_grade") == "A") & (F.col("person_home_ownership") == "OWN")
        ).withColumn("application_id", -F.col("application_id") - 1)
        return kept.select(*SNAPSHOT_COLUMNS).unionByName(added.select(*SNAPSHOT_COLUMNS))

    @property
    def cache(self) -> DataFrame:
        """One cached score per distinct feature set, some expired at AS_OF."""
        now = F.unix_timestamp(F.lit(AS_OF).cast("timestamp"))
        keyed = self.apps.withColumn("cache_key", scoring.cache_key()).withColumn("score", scoring.rule_score())
        rows = keyed.groupBy("cache_key").agg(
            F.min("score").alias("risk_score"), F.min("application_id").alias("first_id")
        )
        days = (F.col("first_id") % 15) - 7
        return rows.select(
            "cache_key",
            "risk_score",
            scoring.risk_level(F.col("risk_score")).alias("risk_category"),
            F.lit("1.0").alias("model_version"),
            (now + days * 86400).alias("ttl"),
        )

    @property
    def baseline(self) -> DataFrame:
        return self.apps.where(F.col("created_at") < F.lit("1998-01-01").cast("timestamp_ntz"))

    @property
    def current(self) -> DataFrame:
        """Applications since 1998, with incomes a fifth higher."""
        later = self.apps.where(F.col("created_at") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        return later.withColumn("person_income", F.floor(F.col("person_income") * 1.2).cast("double"))

    @property
    def predictions(self) -> DataFrame:
        """Labels with a probability and class per application."""
        probability = F.coalesce(F.col("model_score"), F.lit(0.5))
        return self.apps.select(
            "application_id",
            "loan_status",
            probability.alias("prob_default"),
            F.when(probability > 0.5, 1).otherwise(0).alias("prediction_class"),
        )

    @property
    def events(self) -> DataFrame:
        """Applications as submitted events, nothing missing."""
        return self.apps.select(
            "application_id", *FEATURES, "created_at", "model_score", "loan_status", "underwriter_id"
        )
