"""Keyed state on streams: a score cache whose entries run out, and change capture.

Run them with the settings ``STORE``. The cache keeps one small value per key in the state store, change
capture the last images of many entities in one.
The cache runs on event time: an entry's timer fires once the watermark has passed its end and
removes it, so state holds the keys of about one lifetime and the watermark's delay, however
long the stream.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from creditlens.session import SETTINGS

# Spark first sets a processor up in a Python process beside the driver, which does not get the
# files shipped to the executors: so classes of this module travel whole, not by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keyed state of this kind needs a store with column families, which Spark's default store has not.
STORE = {name: SETTINGS[name] for name in ("spark.sql.streaming.stateStore.providerClass",)}

#: Lifetime of a cached score.
LIFETIME_DAYS = 7


class ScoreCache(StatefulProcessor):
    """The first row of a lifetime is scored; rows that follow take its score."""

    def __init__(self, lifetime_days: float):
        self.lifetime = int(lifetime_days * 86_400_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("score", "risk_score double, scored_at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Rows of a batch come in no order of time; a row here is four numbers wide.
        own = pd.concat(list(rows)).sort_values(["at", "application_id"], kind="stable")
        score, since = self.held.get() if self.held.exists() else (None, None)
        first, out = since, []
        for at, own_score in zip(own["at"].tolist(), own["own_score"].tolist()):
            hit = since is not None and since <= at < since + self.lifetime
            # A row from before the entry is scored for itself and changes nothing.
            early = since is not None and at < since
            if not hit and not early:
                score, since = own_score, at
            out.append((own_score if early else score, at if early else since, hit))
        if since != first:
            self.held.update((score, since))
            self.handle.registerTimer(since + self.lifetime)
        columns = list(zip(*out))
        yield pd.DataFrame(
            {
                "cache_key": key[0],
                "application_id": own["application_id"].to_numpy(),
                "at": own["at"].to_numpy(),
                "risk_score": columns[0],
                "scored_at": columns[1],
                "cache_hit": columns[2],
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.held.exists() and self.held.get()[1] + self.lifetime <= expiredTimerInfo.getExpiryTimeInMs():
            self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def cached_scores(stream: DataFrame, key: Column, score: Column, delay: str = "1 day", lifetime_days: float = LIFETIME_DAYS) -> DataFrame:
    """Rows with the score in force for their key at their time, whether it was cached, and since when.

    ``stream`` has application_id and event_time. Rows later than the watermark are dropped, as
    in every stateful step. A null score is cached like any other.
    """
    timed = stream.withWatermark("event_time", delay).select(
        key.alias("cache_key"),
        "application_id",
        "event_time",
        F.unix_millis("event_time").alias("at"),
        score.cast("double").alias("own_score"),
    )
    found = timed.groupBy("cache_key").transformWithStateInPandas(
        statefulProcessor=ScoreCache(lifetime_days),
        outputStructType="cache_key string, application_id long, at long, risk_score double, scored_at long, cache_hit boolean",
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select(
        "cache_key",
        "application_id",
        F.timestamp_millis("at").alias("event_time"),
        F.when(~F.isnan("risk_score"), F.col("risk_score")).alias("risk_score"),
        F.timestamp_millis("scored_at").alias("scored_at"),
        "cache_hit",
    )


#: Groups that entities are dealt into by hash. A group's last images are one value of the state, read and
#: written once a batch: a call and a trip to the store for every entity cost far more than its rows.
GROUPS = 1024


class LastImages(StatefulProcessor):
    """The last images of a group's entities, each against its newer ones."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("images", "images binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        own = pd.concat(list(rows)).sort_values("version", kind="stable")
        before = self.held.get() if self.held.exists() else None
        last = {}
        if before is not None:
            table = pa.ipc.open_stream(before[0]).read_all()
            last = dict(zip(table.column(0).to_pylist(), zip(*[c.to_pylist() for c in table.columns[1:]])))
        changed, out = False, []
        for entity, new, number in zip(own["entity_id"].tolist(), own["image"].tolist(), own["version"].tolist()):
            entity = entity if isinstance(entity, str) else None
            image, version = last.get(entity, (None, None))
            if version is not None and number <= version:
                continue  # an older image, or one that was seen: a repeated delivery
            new = new if isinstance(new, str) else None
            if new != image:
                action = "INSERT" if image is None else "DELETE" if new is None else "UPDATE"
                out.append((entity, action, number, image, new))
            # A deleted key keeps its version, so that an older image cannot bring it back.
            last[entity], changed = (new, number), True
        if changed:
            held = [list(last), *map(list, zip(*last.values()))]
            table = pa.table([pa.array(c, kind) for c, kind in zip(held, (pa.string(), pa.string(), pa.int64()))], names=["entity", "image", "version"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table)
            self.held.update((sink.getvalue().to_pybytes(),))
        columns = list(zip(*out)) if out else [[]] * 5
        yield pd.DataFrame(
            {
                "entity_id": pd.Series(columns[0], dtype="object"),
                "action": pd.Series(columns[1], dtype="object"),
                "version": pd.Series(columns[2], dtype="int64"),
                "old_value": pd.Series(columns[3], dtype="object"),
                "new_value": pd.Series(columns[4], dtype="object"),
            }
        )

    def close(self) -> None:
        pass


def captured_changes(stream: DataFrame, key: str, columns: list[str], version: str, deleted: str, entity: str) -> DataFrame:
    """Audit rows of a feed of row images: every change of a key, with its old and new values.

    ``version`` numbers a key's images; ``deleted`` marks one that says the row is gone.
    Equal images say nothing, and neither does a version that is not newer than the last.
    """
    image = F.to_json(F.struct(key, *columns), {"ignoreNullFields": "false"})
    images = stream.select(
        F.col(key).cast("string").alias("entity_id"),
        F.col(version).cast("long").alias("version"),
        F.when(~F.coalesce(F.col(deleted), F.lit(False)), image).alias("image"),
    )
    grouped = images.withColumn("part", F.pmod(F.xxhash64("entity_id"), F.lit(GROUPS)).cast("int")).groupBy("part")
    found = grouped.transformWithStateInPandas(
        statefulProcessor=LastImages(),
        outputStructType="entity_id string, action string, version long, old_value string, new_value string",
        outputMode="Append",
        timeMode="None",
    )
    return found.select("action", F.lit(entity).alias("entity_type"), "entity_id", "old_value", "new_value", "version")
