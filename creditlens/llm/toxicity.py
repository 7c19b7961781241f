"""Toxicity by a convolutional text classifier in numpy, with thresholds by language.

Every word of a text becomes the sum of hashed embeddings, of itself and of its
beginnings of a few lengths, so that unseen forms of a known stem are understood.
Filters over one, two and three neighbouring words, rectified and pooled by their maximum over the
whole text, feed a logistic output.

The network is trained by Adam on all labelled rows, in ``EPOCHS`` rounds. They are dealt into
shards of about ``SHARD_ROWS`` by a hash of their id and stored bucketed, so a round moves no
texts: every shard descends from the same parameters, and what the shards reach is averaged by
rows, block by block. A shard's rows pass by in batches and the network has a fixed size, so
memory does not follow the input. A quarter of the rows is kept from training to set the
output's scale: the cut that agrees best with the labels, found exactly over all these rows,
gets the score ``CUT``. For each language a threshold is then found on the same rows; it is
reported beside the score, of which language, source and id are no part.

Defined results: null and empty texts get the score of a text without any word; rows
with a null label or an unknown id teach nothing; of rows that share an id the least text
teaches, once; without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from creditlens.llm import text as tx
from creditlens.llm.decontaminate import LOWERED, SEPARATORS
from creditlens.operators.quantiles import in_ranges
from creditlens.session import run_folder, staged

SLOTS = 1 << 16
SIZE = 16
#: Bytes of the beginnings that have embeddings beside the word's own.
STEMS = (4, 5, 6, 7)
TABLES = 1 + len(STEMS)
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Labelled rows of a shard, about; a shard is one task's share of a round.
SHARD_ROWS = 25_000
#: Up to so many labelled ids are sent to the texts; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Embeddings of a block, the unit in which averages are taken; all other parameters are one.
BLOCK = 4096
DENSE = -1
MOVED = (("block", pa.int32()), ("shard", pa.int32()), ("n", pa.float64()), ("slots", pa.binary()), ("data", pa.binary()))
EPOCHS = 6
BATCH = 64
RATE = 0.01
CUT = 0.7
SEED = 11
PAD = max(WIDTHS) - 1
NO_WORD = SLOTS  # a row of zeros


def word_slots(chunk: tx.Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of each word and its beginnings, with ``PAD`` empty places after each text, and the bounds of texts."""
    lowered = tx.Chunk(chunk.first, chunk.last, LOWERED[chunk.data], chunk.offsets)
    words = tx.find_words(lowered, inside)
    spans = tx.Spans(lowered.data)
    rows = len(words.of) - 1
    of = words.of + PAD * np.arange(rows + 1)
    slots = np.full((TABLES, int(of[-1])), NO_WORD, np.int32)
    at = np.arange(len(words.start)) + PAD * words.text()
    slots[0, at] = spans.hashes(words.start, words.end) & np.uint64(SLOTS - 1)
    for k, size in enumerate(STEMS, 1):
        long = words.end - words.start >= size
        start = words.start[long]
        slots[k, at[long]] = spans.hashes(start, start + size) & np.uint64(SLOTS - 1)
    return slots, of


@dataclass
class Network:
    tables: np.ndarray  # embeddings of words and of each length of beginnings
    filters: dict[int, np.ndarray]  # by width: (width, SIZE, FILTERS)
    shifts: np.ndarray
    weights: np.ndarray
    bias: float = 0.0
    scale: float = 1.0
    cut: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    taught: bool = True

    @classmethod
    def start(cls, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        tables = rng.normal(0, 0.05, (TABLES, SLOTS + 1, SIZE)).astype(np.float32)
        tables[:, NO_WORD] = 0
        filters = {w: rng.normal(0, (1 / (w * SIZE)) ** 0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS}
        n = len(WIDTHS) * FILTERS
        return cls(tables, filters, np.zeros(n, np.float32), rng.normal(0, 0.1, n).astype(np.float32))

    def copied(self) -> Network:
        """With arrays of its own."""
        filters = {w: x.copy() for w, x in self.filters.items()}
        return replace(self, tables=self.tables.copy(), filters=filters, shifts=self.shifts.copy(), weights=self.weights.copy())

    def moved(self, start: Network) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """What differs from another network as (block, rows of it, values): embeddings by block, and all else as one row."""
        dense = [self.filters[w].ravel() for w in WIDTHS] + [self.shifts, self.weights, [self.bias]]
        yield DENSE, np.zeros(1, np.int32), np.concatenate(dense).astype(np.float32)
        for table in range(TABLES):
            hit = np.flatnonzero((self.tables[table] != start.tables[table]).any(axis=1))
            for k in np.unique(hit // BLOCK).tolist():
                own = hit[hit // BLOCK == k]
                yield table * (SLOTS // BLOCK) + k, (own - k * BLOCK).astype(np.int32), self.tables[table][own]

    def put(self, block: int, slots: np.ndarray, values: np.ndarray) -> None:
        if block != DENSE:
            table, k = divmod(block, SLOTS // BLOCK)
            self.tables[table][k * BLOCK + slots] = values.reshape(-1, SIZE)
            return
        sizes = [self.filters[w].size for w in WIDTHS] + [len(self.shifts), len(self.weights)]
        *filters, self.shifts, self.weights, bias = (x.copy() for x in np.split(values, np.cumsum(sizes)))
        self.filters = {w: x.reshape(self.filters[w].shape) for w, x in zip(WIDTHS, filters)}
        self.bias = float(bias[0])

    def convolved(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word vectors and the outputs of all filters at each place where a window starts."""
        x = self.tables[0][slots[0]]
        for table, own in zip(self.tables[1:], slots[1:]):
            x += table[own]
        stacked = np.concatenate([self.filters[w][j] for w in WIDTHS for j in range(w)], axis=1)
        parts = x @ stacked
        out = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32)
        at = 0
        for k, w in enumerate(WIDTHS):
            own = parts[:, at * FILTERS : (at + 1) * FILTERS].copy()
            for j in range(1, w):
                own[:-j] += parts[j:, (at + j) * FILTERS : (at + j + 1) * FILTERS]
            out[:, k * FILTERS : (k + 1) * FILTERS] = own
            at += w
        return x, out + self.shifts

    def logits(self, slots: np.ndarray, of: np.ndarray) -> np.ndarray:
        if len(of) < 2:
            return np.zeros(0)
        _, out = self.convolved(slots)
        pooled = np.maximum(np.maximum.reduceat(out, of[:-1], axis=0), 0)
        return (pooled @ self.weights + self.bias).astype(np.float64)

    def scores(self, slots: np.ndarray, of: np.ndarray) -> np.ndarray:
        if not self.taught:
            return np.zeros(len(of) - 1)
        z = self.scale * (self.logits(slots, of) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Adam:
    def __init__(self, rate: float):
        self.rate, self.held, self.t = rate, {}, 0

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray, rows=None) -> None:
        """Update in place, only the given rows where there are any."""
        m, v = self.held.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * gradient
        v[at] = 0.99 * v[at] + 0.01 * gradient**2
        value[at] -= self.rate * (m[at] / (1 - 0.9**self.t)) / (np.sqrt(v[at] / (1 - 0.99**self.t)) + 1e-7)


class Descent:
    """Minibatch steps of Adam on a network, in place, with dropout."""

    def __init__(self, net: Network, rng: np.random.Generator):
        self.net, self.rng, self.adam = net, rng, Adam(RATE)

    def step(self, slots: list[np.ndarray], labels: np.ndarray, importance: np.ndarray) -> None:
        """One minibatch of texts given by their slots."""
        net, adam = self.net, self.adam
        batch = np.concatenate(slots, axis=1)
        of = np.concatenate([[0], np.cumsum([x.shape[1] for x in slots])])
        x, out = net.convolved(batch)
        best = np.stack([a + out[a:b].argmax(axis=0) for a, b in zip(of[:-1], of[1:])])
        pooled = np.take_along_axis(out, best, axis=0)
        live = pooled > 0
        keep = self.rng.random(pooled.shape) > 0.2
        pooled = np.where(live & keep, pooled, 0) / 0.8
        p = 1 / (1 + np.exp(-np.clip(pooled @ net.weights + net.bias, -50, 50)))
        slope = ((p - labels) * importance / len(labels)).astype(np.float32)
        back = slope[:, None] * net.weights[None] * live * keep / 0.8
        adam.t += 1
        touched, moves = [], []
        for k, w in enumerate(WIDTHS):
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            gradient = np.empty_like(net.filters[w])
            for j in range(w):
                at = np.minimum(best[:, part] + j, len(x) - 1)
                gradient[j] = np.einsum("nf,nfd->df", back[:, part], x[at])
                touched.append(at.ravel())
                moves.append((back[:, part, None] * net.filters[w][j].T[None]).reshape(-1, SIZE))
            adam.step(f"filter{w}", net.filters[w], gradient + 1e-5 * net.filters[w])
        at, move = np.concatenate(touched), np.concatenate(moves)
        for table in range(TABLES):
            rows_hit, where = np.unique(batch[table][at], return_inverse=True)
            total = np.zeros((len(rows_hit), SIZE), np.float32)
            np.add.at(total, where, move)
            real = rows_hit != NO_WORD
            adam.step(f"table{table}", net.tables[table], total[real], rows_hit[real])
        adam.step("weights", net.weights, pooled.T @ slope + 1e-4 * net.weights)
        adam.step("shifts", net.shifts, back.sum(axis=0))
        net.bias -= 0.05 * float(slope.sum())


def importances(positive: float, rows: float) -> tuple[float, float]:
    """Weights of a row of label 0 and of label 1, by which classes weigh alike."""
    share = max(positive / max(rows, 1), 1e-6)
    return 0.5 / max(1 - share, 1e-6), 0.5 / share


def train(slots: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Fit on texts given by their slots; classes weigh alike."""
    net, rng = Network.start(seed), np.random.default_rng(seed)
    descent = Descent(net, rng)
    importance = np.where(labels == 1, *importances(labels.sum(), len(labels))[::-1])
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for first in range(0, len(order), BATCH):
            rows = order[first : first + BATCH]
            descent.step([slots[i] for i in rows], labels[rows], importance[rows])
    return net


def best_cuts(values: DataFrame) -> dict[str, tuple[float, int, int]]:
    """By group the middle of the gap between values whose cut has the best F1, with the group's positives and rows.

    ``values`` has (group, value, label). Equal values count once; the largest of equally good cuts is taken.
    """
    counted = values.groupBy("group", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("hits"))
    counts = staged(counted, "toxic-counts")
    placed = in_ranges(counts, ["n", "hits"], ["group"], fixed=False)
    inside, before = Window.partitionBy("group", "range").orderBy("value"), Window.partitionBy("group").orderBy("range")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("group", "range").agg(F.sum("n").alias("_n"), F.sum("hits").alias("_hits"))
    starts = starts.select("group", "range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_n", "_hits")])
    # Rows and positives at or above each value: all, less those below.
    above = placed.select("*", *[(F.sum(c).over(inside) - F.col(c)).alias(f"{c}_in") for c in ("n", "hits")]).join(starts, ["group", "range"])
    rows, hits = F.col("n_all") - F.col("n_in") - F.col("_n"), F.col("hits_all") - F.col("hits_in") - F.col("_hits")
    f1 = 2 * hits / (rows + F.greatest("hits_all", F.lit(1)))
    best = above.groupBy("group").agg(
        F.max_by("value", F.struct(f1, "value")).alias("best"), F.max("hits_all").alias("positive"), F.max("n_all").alias("rows")
    )
    lower = F.max(F.when(F.col("value") < F.col("best"), F.col("value"))).alias("lower")
    found = counts.join(best, "group").groupBy("group", "best", "positive", "rows").agg(lower).collect()
    return {r["group"]: ((r["best"] + (r["best"] - 1 if r["lower"] is None else r["lower"])) / 2, r["positive"], r["rows"]) for r in found}


def labelled(docs: DataFrame, labels: DataFrame, label: str, teaches) -> tuple[DataFrame, int]:
    """text, lang, label, place (a hash of the id), held and shard of all rows that teach, bucketed by shard; the shards."""
    known = labels.where(F.col(label).isin(0, 1) & teaches).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = staged(known.select(F.col("doc_id").alias("_taught_id"), "label"), "toxic-labels")
    ids = known.count()
    shards = max(1, -(-ids // SHARD_ROWS))
    # Few enough ids go to the texts, so that texts without a label need not move.
    joined = docs.join(F.broadcast(known) if ids <= BROADCAST_IDS else known, F.col("doc_id") == F.col("_taught_id"))
    once = joined.groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("row"), F.max("label").alias("label"))
    place = F.xxhash64("doc_id")
    rows = once.select("row.*", "label", place.alias("place"), (F.pmod(place, F.lit(4)) == 0).alias("held"))
    rows = rows.withColumn("shard", F.pmod(F.shiftrightunsigned("place", 8), F.lit(shards)).cast("int"))
    folder = run_folder(docs.sparkSession, "toxic-rows")
    name = f"toxic_rows_{folder.rsplit('-', 1)[-1]}"
    writer = rows.repartition(shards, "shard").write.bucketBy(shards, "shard").sortBy("shard", "place")
    writer.option("path", f"{folder}/{name}").format("parquet").saveAsTable(name)
    return docs.sparkSession.table(name), shards


def train_round(rows: DataFrame, net: Network, turn: int, weights: tuple[float, float]) -> Network:
    """One pass over all rows by shards that start alike, and the average of what they reach.

    A word's embedding is averaged over the shards that moved it.
    """
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, inside, shard, taught, descent = shared.value, tx.table(SEPARATORS), 0, 0, None
        for batch in batches:
            if descent is None:
                shard = batch["shard"][0].as_py()
                descent = Descent(start.copied(), np.random.default_rng([SEED, turn, shard]))
            labels = batch["label"].to_numpy().astype(np.float32)
            importance = np.where(labels == 1, weights[1], weights[0])
            for chunk in tx.chunks(batch["text"]):
                slots, of = word_slots(chunk, inside)
                order = descent.rng.permutation(len(of) - 1)
                for a in range(0, len(order), BATCH):
                    own = order[a : a + BATCH]
                    descent.step([slots[:, of[i] : of[i + 1]] for i in own], labels[chunk.first + own], importance[chunk.first + own])
            taught += batch.num_rows
        if descent is None:
            return
        for block, slot, values in descent.net.moved(start):
            columns = [pa.array([x], kind) for x, (_, kind) in zip((block, shard, float(taught), slot.tobytes(), values.tobytes()), MOVED)]
            yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in MOVED])

    def whole(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for block, _, n, slot, values in zip(*[c.to_pylist() for c in batch.columns]):
                slot, values = np.frombuffer(slot, np.int32), np.frombuffer(values, np.float32)
                size = (1, len(values)) if block == DENSE else (BLOCK, SIZE)
                sums, counts = totals.setdefault(block, [np.zeros(size), np.zeros(size[0])])
                sums[slot] += n * values.reshape(len(slot), -1)
                counts[slot] += n
        for block, (sums, counts) in totals.items():
            slot = np.flatnonzero(counts).astype(np.int32)
            values = (sums[slot] / counts[slot, None]).astype(np.float32)
            columns = [pa.array([x], kind) for x, (_, kind) in zip((block, 0, float(counts.max()), slot.tobytes(), values.tobytes()), MOVED)]
            yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in MOVED])

    schema = "block int, shard int, n double, slots binary, data binary"
    parts = rows.groupBy("shard").applyInArrow(descend, schema)
    # Added in the order of shards, so that a second run gives the same last bits.
    averaged = parts.repartition(1 + TABLES * (SLOTS // BLOCK), "block").sortWithinPartitions("block", "shard").mapInArrow(whole, schema)
    net = net.copied()
    for row in averaged.select("block", "slots", "data").collect():
        net.put(row["block"], np.frombuffer(row["slots"], np.int32), np.frombuffer(row["data"], np.float32))
    return net


def fit(docs: DataFrame, labels: DataFrame, teaches) -> Network:
    """The network from labels of all rows for which ``teaches`` holds."""
    rows, _ = labelled(docs, labels, "toxic", teaches)
    found = {r["held"]: r for r in rows.groupBy("held").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")).collect()}

    def both(held: bool) -> bool:
        return held in found and 0 < found[held]["hits"] < found[held]["n"]

    net = Network.start()
    if not both(False):
        net.taught = False
        return net
    weights = importances(found[False]["hits"], found[False]["n"])
    for turn in range(EPOCHS):
        net = train_round(rows.where("NOT held"), net, turn, weights)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def logits(batches):
        inside = tx.table(SEPARATORS)
        for batch in batches:
            for chunk in tx.chunks(batch["text"]):
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                value = pa.array(shared.value.logits(*word_slots(chunk, inside)))
                yield pa.RecordBatch.from_arrays([part["group"], part["label"], value], names=["group", "label", "value"])

    # Nothing is told of a class that the held rows lack; then the taught rows set the scale.
    checked = rows.where(F.col("held") == both(True)).select("text", "label", F.coalesce("lang", F.lit("")).alias("group"))
    values = staged(checked.mapInArrow(logits, "group string, label int, value double"), "toxic-values")
    net.cut = best_cuts(values.withColumn("group", F.lit("")))[""][0]
    net.scale = float(4.0 / (values.agg(F.avg(F.abs(F.col("value") - F.lit(net.cut)))).first()[0] or 1.0))
    z = F.lit(net.scale) * (F.col("value") - F.lit(net.cut)) + F.lit(float(np.log(CUT / (1 - CUT))))
    scored = values.withColumn("value", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0)))))
    for lang, (cut, positive, count) in sorted(best_cuts(scored).items()):
        if positive >= 10 and count - positive >= 10:
            net.thresholds[lang] = cut
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, score, and the threshold of the document's language."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    source = docs.select("doc_id", "lang", "text")
    schema = T.StructType(
        [source.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("threshold", T.DoubleType())]
    )

    def run(batches):
        own, inside = shared.value, tx.table(SEPARATORS)
        for batch in batches:
            for chunk in tx.chunks(batch.column(2)):
                slots, of = word_slots(chunk, inside)
                langs = batch.column(1).slice(chunk.first, chunk.last - chunk.first).to_pylist()
                limits = [own.thresholds.get(lang or "", CUT) for lang in langs]
                ids = batch.column(0).slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(own.scores(slots, of)), pa.array(limits, pa.float64())], names=schema.names)

    return source.mapInArrow(run, schema)
