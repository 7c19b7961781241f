"""Masked pseudo-likelihood of documents under a bidirectional window network in numpy.

The network sees ``REACH`` words on both sides of a hidden word: each place has an
embedding table of its own, their sum goes through tanh, and a two-level softmax (class,
then word in the class) gives the hidden word's probability. A document's score is the
sum of log-probabilities of all its words, each hidden in turn.

All documents teach. All their words are counted. Words above a count keep an id; the
count is the least that leaves as many as ``GROWTH`` times the root of all occurrences,
or ``VOCABULARY`` - 1 where that is more. The rest share one id, and each has its own probability
within that: its count over all of theirs, from a table of all words that stays in Spark.
Words seen once are told apart by their bytes, under a model of byte pairs taught by all
words without an id. Training runs in rounds over the whole corpus: each task
starts from the shared parameters, hides ``HIDDEN_SHARE`` of the words of every document
(by a hash of document text and position) and descends on them; the tasks' parameters
are then averaged, weighted by words, block by block in a stream, so neither a task nor
the driver holds more than one copy of a block and the sum. The parameters grow with the
root of the corpus. The first round counts the byte pairs too, so texts are read once for
the words' counts, once a round and once for the scores.

Defined results: null and texts without words have 0 words, score 0 and a null mean;
without any word in the corpus all scores are 0; repeated rows teach each time. A word
that the model's counts lack scores like a word seen once; where none was seen once, as
if one were. Rows are told apart by a 64-bit hash of id and text; equal rows score alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.llm import text as tx
from creditlens.llm.decontaminate import LOWERED, SEPARATORS
from creditlens.session import staged

REACH = 2
SIZE = 24
#: The least number of ids; a larger corpus has more.
VOCABULARY = 4096
GROWTH = 2
HIDDEN_SHARE = 0.15
ROUNDS = 2
RATE = 0.15
BATCH = 2048
BLOCK = 8192
#: Blocks of parameters that a task adds up.
TOGETHER = 4
#: Rows of a softmax that are worked on at once while scoring, so that they stay in a core's cache.
ROWS = 2048
#: Bytes of text whose words are found at once, for the same reason.
PIECE = 1 << 17
#: Bytes of text whose words are counted before they leave a task.
TALLY_BYTES = 8 << 20
SEED = 3
OUTSIDE = -1  # the id beyond a text's ends, the last row of a table
END = 256  # the byte before and behind a word
#: Up to here a number and its negative have an exponential, and rows of them a sum, in float32.
SAFE = 60
#: What makes of squares in a row the mean over its weights and the square of its bias.
SQUARES = np.array([[1 / SIZE, 0]] * SIZE + [[0, 1]], np.float32)
OFFSETS = [j for j in range(-REACH, REACH + 1) if j]


@dataclass
class Window:
    """Parameters, float32 arrays by name; the known words' hashes sorted, with their ids."""

    known: np.ndarray
    ids: np.ndarray
    parts: dict[str, np.ndarray]
    others: int = 0  # occurrences of words without an id
    once: int = 0  # of these, words seen once
    spelling: np.ndarray | None = None  # log-probability of a byte behind a byte
    counts: DataFrame | None = None  # all words' counts; stays with the driver

    @classmethod
    def start(cls, known: np.ndarray, counts: np.ndarray, others: int, seed: int = SEED) -> Window:
        """Near zero, with biases of the words' shares, so that training starts at the unigram model."""
        rng = np.random.default_rng(seed)
        classes = math.isqrt(max(VOCABULARY, len(known) + 1) - 1) + 1
        share = np.zeros(classes**2)
        share[: len(counts)] = counts
        share[-1] = others
        share = (share + 0.5) / (share + 0.5).sum()
        by_class = share.reshape(classes, classes)
        parts = {
            "context": rng.normal(0, 0.1, (len(OFFSETS), len(share) + 1, SIZE)),
            "shift": np.zeros(SIZE),
            "class": rng.normal(0, 0.05, (classes, SIZE)),
            "class_bias": np.log(by_class.sum(axis=1)),
            "word": rng.normal(0, 0.05, (classes, classes, SIZE)),
            "word_bias": np.log(by_class / by_class.sum(axis=1, keepdims=True)),
        }
        order = np.argsort(known)
        return cls(known[order], np.arange(len(known))[order], {k: v.astype(np.float32) for k, v in parts.items()}, others)

    @property
    def classes(self) -> int:
        """Classes, and words in each."""
        return len(self.parts["class"])

    @property
    def other(self) -> int:
        """The id of all rarer words."""
        return self.classes**2 - 1

    def bare(self) -> Window:
        """What tasks need."""
        return replace(self, counts=None)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.parts[k].ravel() for k in sorted(self.parts)])

    def with_flat(self, values: np.ndarray) -> Window:
        parts, at = {}, 0
        for k in sorted(self.parts):
            size = self.parts[k].size
            parts[k] = values[at : at + size].reshape(self.parts[k].shape).astype(np.float32)
            at += size
        return replace(self, parts=parts)

    @cached_property
    def leading(self) -> tuple[np.ndarray, np.uint64, int]:
        """Where known words of each leading bits begin, how far to shift for these, and the most words that share them."""
        bits = len(self.known).bit_length() + 3
        shift = np.uint64(64 - bits)
        first = np.searchsorted(self.known, np.arange(1 << bits, dtype=np.uint64) << shift)
        return first, shift, int(np.diff(first, append=len(self.known)).max())

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(hashes), self.other)
        # A search of all known words for every word took as long as finding the words.
        first, shift, most = self.leading
        at, end = first[hashes >> shift], len(self.known) - 1
        np.minimum(at, end, out=at)
        for _ in range(most):
            at += self.known[at] < hashes
            np.minimum(at, end, out=at)
        return np.where(self.known[at] == hashes, self.ids[at], self.other)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        return self.hidden_and_one(around)[:, :-1]

    def hidden_and_one(self, around: np.ndarray) -> np.ndarray:
        """Rows that end in a one, which picks up the bias in a product with ``joined`` weights."""
        total = self.parts["context"][0].take(around[0], axis=0)
        for table, ids in zip(self.parts["context"][1:], around[1:]):
            total += table.take(ids, axis=0)
        total += self.parts["shift"]
        result = np.ones((len(total), SIZE + 1), np.float32)
        np.tanh(total, out=result[:, :-1])
        return result

    def joined(self, name: str) -> np.ndarray:
        """Weights with each row's bias behind it."""
        return np.concatenate([self.parts[name], self.parts[f"{name}_bias"][..., None]], axis=-1)

    def log_probabilities(self, around: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Of each word between the words around it."""
        h = self.hidden_and_one(around)
        group, inner = words // self.classes, words % self.classes
        result = _picked(h, [(self.joined("class"), 0, len(words))], group, self.classes)
        # Words are dealt by class, so that each class is one product; small numbers sort faster.
        order = np.argsort(group.astype(np.min_scalar_type(self.classes)), kind="stable")
        bounds = np.searchsorted(group[order], np.arange(self.classes + 1)).tolist()
        spans = [(rows, a, b) for rows, a, b in zip(self.joined("word"), bounds, bounds[1:]) if a < b]
        result[order] += _picked(h.take(order, axis=0), spans, inner[order], self.classes)
        return result


def _exponentials(z: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """In place. The sum of each row, and what was taken off the rows so that none overflows or vanishes.
    """
    off: np.ndarray | float = 0.0
    if not (z.max() < SAFE and z.min() > -SAFE):
        off = z.max(axis=1)
        z -= off[:, None]
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], np.float32), off


def _picked(h: np.ndarray, spans: list[tuple[np.ndarray, int, int]], at: np.ndarray, size: int) -> np.ndarray:
    """Log-probability of one of ``size`` columns of each row's product; spans of rows have weights of their own."""
    result = np.empty(len(at))
    room, number = np.empty((min(ROWS, len(at)), size), np.float32), 0
    for first in range(0, len(at), ROWS):
        own = at[first : first + ROWS]
        last, z = first + len(own), room[: len(own)]
        while number < len(spans) and spans[number][1] < last:
            weights, a, b = spans[number]
            a, until = max(a, first), min(b, last)
            np.dot(h[a:until], weights.T, out=z[a - first : until - first])
            if b > last:
                break
            number += 1
        picked = z[np.arange(len(own)), own]
        total, off = _exponentials(z)
        result[first:last] = picked - off - np.log(total)
    return result


class Descent:
    """Steps of gradient descent, scaled by the past size of each row's gradients."""

    def __init__(self, model: Window, rate: float = RATE):
        self.model, self.rate = model, rate
        self.past = {"context": np.full(model.parts["context"].shape[:-1], 1e-7, np.float32), "shift": np.full(SIZE, 1e-7, np.float32)}
        # Weights and biases lie in one array, so that one product serves both; the model sees parts of it.
        self.rows = {k: model.joined(k) for k in ("class", "word")}
        for k, rows in self.rows.items():
            model.parts[k], model.parts[f"{k}_bias"] = rows[..., :-1], rows[..., -1]
            self.past[k] = np.full((*rows.shape[:-1], 2), 1e-7, np.float32)

    def _move(self, name: str, at, gradient: np.ndarray) -> None:
        """Rows of weights, each with its bias; the biases of a class's words share one size. Uses up ``gradient``."""
        rows, past = self.rows[name], self.past[name]
        squares = np.square(gradient) @ SQUARES
        if squares.ndim > 2:
            squares[..., 1] = squares[..., 1].mean(axis=-1, keepdims=True)
        past[at] += squares
        scale = self.rate / np.sqrt(past[at])
        gradient[..., :-1] *= scale[..., :1]
        gradient[..., -1] *= scale[..., 1]
        rows[at] -= gradient

    def step(self, around: np.ndarray, words: np.ndarray) -> None:
        """Errors stay unnormalised: the rows' sums divide the narrow sides of the products."""
        n, classes = len(words), self.model.classes
        h = self.model.hidden_and_one(around)
        group, inner = words // classes, words % classes
        rows = self.rows["class"]
        p = h @ rows.T
        total, _ = _exponentials(p)
        p[np.arange(n), group] -= total
        back = p @ rows[:, :-1]
        back /= total[:, None]
        self._move("class", slice(None), p.T @ (h / (total * np.float32(n))[:, None]))
        # Rows are dealt by class: each class is three products, all else is done for all of them at once.
        order = np.argsort(group, kind="stable")
        dealt, own, rows = group[order], h[order], self.rows["word"]
        first = np.flatnonzero(np.concatenate([[True], dealt[1:] != dealt[:-1]]))
        met, edges = dealt[first], [*first.tolist(), n]
        spans = list(zip(met.tolist(), edges, edges[1:]))
        q = np.empty((n, classes), np.float32)
        for c, a, b in spans:
            np.dot(own[a:b], rows[c].T, out=q[a:b])
        total, _ = _exponentials(q)
        q[np.arange(n), inner[order]] -= total
        own /= (total * np.float32(n))[:, None]
        below, gradient = np.empty_like(own), np.empty((len(met), classes, SIZE + 1), np.float32)
        for k, (c, a, b) in enumerate(spans):
            np.dot(q[a:b], rows[c], out=below[a:b])
            np.dot(q[a:b].T, own[a:b], out=gradient[k])
        below /= total[:, None]
        back[order] += below[:, :-1]
        self._move("word", met if len(met) < classes else slice(None), gradient)
        back *= 1 - h[:, :-1] ** 2
        back /= n
        self._shift(back.sum(axis=0))
        self._context(around, back)

    def _shift(self, gradient: np.ndarray) -> None:
        self.past["shift"] += gradient**2
        self.model.parts["shift"] -= self.rate / np.sqrt(self.past["shift"]) * gradient

    def _context(self, around: np.ndarray, back: np.ndarray) -> None:
        """Each row of the tables moves by the sum over its places, found without sorting."""
        tables, past = self.model.parts["context"], self.past["context"]
        size = tables.shape[1]
        place = around % size + np.arange(len(OFFSETS))[:, None] * size
        met = np.zeros(past.size, bool)
        met[place] = True
        at = np.flatnonzero(met)
        slot = np.empty(past.size, np.int64)
        slot[at] = np.arange(len(at))
        slot = slot[place].ravel()
        gradient = np.empty((len(at), SIZE), np.float32)
        for j, column in enumerate(np.tile(back.T.astype(np.float64), len(OFFSETS))):
            gradient[:, j] = np.bincount(slot, column, len(at))
        rows, past = tables.reshape(-1, SIZE), past.reshape(-1)
        sizes = past[at] + np.square(gradient) @ SQUARES[:SIZE, 0]
        past[at] = sizes
        gradient *= (self.rate / np.sqrt(sizes))[:, None]
        rows[at] = rows.take(at, axis=0) - gradient


def _spelled_words(chunk: tx.Chunk, inside: np.ndarray) -> tuple[np.ndarray, tx.Words, np.ndarray]:
    """Hashes of all words, their bounds, and the bytes that these bound."""
    data, parts = LOWERED[chunk.data], []
    # Runs of whole texts of about PIECE bytes, whose arrays stay in a core's cache.
    first, n = 0, len(chunk.offsets) - 1
    while first < n or not parts:
        last = int(np.searchsorted(chunk.offsets, chunk.offsets[first] + PIECE, "right")) - 1
        last = min(max(last, first + 1), n)
        low = chunk.offsets[first]
        piece = tx.Chunk(first, last, data[low : chunk.offsets[last]], chunk.offsets[first : last + 1] - low)
        words = tx.find_words(piece, inside)
        parts.append((tx.hash_spans(piece.data, words.start, words.end), words.start + low, words.end + low, np.diff(words.of)))
        first = last
    hashes, start, end, sizes = (np.concatenate(x) for x in zip(*parts))
    return hashes, tx.Words(start, end, np.concatenate([[0], np.cumsum(sizes)])), data


def _words(chunk: tx.Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, words, _ = _spelled_words(chunk, inside)
    return hashes, words.of


def byte_pairs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte pairs of words, ends included, as first x 257 + second; and where each word's begin."""
    size = end - start
    bounds = np.concatenate([[0], np.cumsum(size + 1)])
    at = np.arange(int(bounds[-1])) + np.repeat(start - bounds[:-1], size + 1)
    second = data[np.minimum(at, max(len(data) - 1, 0))].astype(np.int64)
    second[bounds[1:] - 1] = END
    first = np.empty(len(second), np.int64)
    first[1:] = second[:-1]
    first[bounds[:-1]] = END
    return first * 257 + second, bounds


def spell(model: Window, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log-probability of each word's bytes and its end."""
    if not len(start):
        return np.zeros(0)
    pairs, bounds = byte_pairs(data, start, end)
    return np.add.reduceat(model.spelling[pairs], bounds[:-1])


class Pairs:
    """Byte pairs of all occurrences of words without an id."""

    def __init__(self, model: Window):
        self.other, self.held = model.other, np.zeros(257 * 257, np.int64)

    def add(self, ids: np.ndarray, words: tx.Words, data: np.ndarray) -> None:
        rare = ids == self.other
        if rare.any():
            self.held += np.bincount(byte_pairs(data, words.start[rare], words.end[rare])[0], minlength=len(self.held))


def spelling_of(counts: np.ndarray) -> np.ndarray:
    """The byte model of so many pairs."""
    table = (counts + 0.1).reshape(257, 257)
    return np.log(table / table.sum(axis=1, keepdims=True)).ravel()


def spelling(docs: DataFrame, model: Window) -> np.ndarray:
    """The byte model, taught by all occurrences of words without an id."""
    shared = docs.sparkSession.sparkContext.broadcast(model.bare())

    def count(batches):
        inside, own = tx.table(SEPARATORS), shared.value
        pairs = Pairs(own)
        for batch in batches:
            for chunk in tx.chunks(batch.column(0)):
                hashes, words, data = _spelled_words(chunk, inside)
                pairs.add(own.word_ids(hashes), words, data)
        pair = np.flatnonzero(pairs.held)
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(pairs.held[pair], pa.int64())], names=["pair", "n"])

    counted = docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(257 * 257, np.int64)
    counts[counted["pair"].to_numpy(np.int64)] += counted["n"].to_numpy(np.int64)
    return spelling_of(counts)


def _around(ids: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids at each offset from the given words, ``OUTSIDE`` beyond their text."""
    owner = np.searchsorted(of, at, "right") - 1
    result = np.empty((len(OFFSETS), len(at)), np.int64)
    for k, j in enumerate(OFFSETS):
        place = at + j
        within = (place >= of[owner]) & (place < of[owner + 1])
        result[k] = np.where(within, ids[np.clip(place, 0, max(len(ids) - 1, 0))], OUTSIDE) if len(ids) else OUTSIDE
    return result


def counted_words(batches):
    """Hashes of words and how often each occurs in about ``TALLY_BYTES`` of text.

    Texts are walked in small chunks, since finding words takes many times their memory; only hashes are held.
    """
    inside = tx.table(SEPARATORS)
    held: list[np.ndarray] = []
    size = 0

    def tally():
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])

    for batch in batches:
        for chunk in tx.chunks(batch.column(0)):
            held.append(_words(chunk, inside)[0])
            size += len(chunk.data)
            if size >= TALLY_BYTES:
                yield tally()
                held, size = [], 0
    if held:
        yield tally()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hashes of all words of all documents and how often each occurs."""
    counted = docs.select("text").mapInArrow(counted_words, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def counted_model(docs: DataFrame) -> Window:
    """The model before its first round, without its spelling, which the first round learns in passing."""
    counts = staged(word_counts(docs), "word-counts")
    facts = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")).first()
    total = int(facts["n"] or 0)
    most = max(VOCABULARY - 1, int(GROWTH * math.sqrt(total)))
    # All words above the least count that leaves no more than ``most``.
    tally = counts.groupBy("n").agg(F.count("*").alias("words")).toPandas().sort_values("n", ascending=False)
    fits = tally["n"][tally["words"].cumsum() <= most]
    least = int(fits.min()) if len(fits) else total + 1
    top = counts.where(F.col("n") >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    known = top["word"].to_numpy(np.int64).view(np.uint64)
    model = Window.start(known, top["n"].to_numpy(np.int64), total - int(top["n"].sum()))
    return replace(model, once=int(facts["once"]) - int((top["n"] == 1).sum()), counts=counts)


def first_model(docs: DataFrame) -> Window:
    model = counted_model(docs)
    return replace(model, spelling=spelling(docs, model))


def train_round(docs: DataFrame, model: Window, turn: int) -> Window:
    """One pass over all documents by tasks that start alike, and the average of what they reach.

    A model without its spelling learns that too: byte pairs travel as blocks of numbers below 0, which are added up.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.bare())
    fields = ["block", "taught", "values"]

    def descend(batches):
        inside, own = tx.table(SEPARATORS), shared.value
        pairs = Pairs(own) if own.spelling is None else None
        own = own.with_flat(own.flat())
        descent, taught = Descent(own), 0
        for batch in batches:
            for chunk in tx.chunks(batch.column(0)):
                hashes, found, data = _spelled_words(chunk, inside)
                of, ids = found.of, own.word_ids(hashes)
                if pairs:
                    pairs.add(ids, found, data)
                place = np.arange(len(ids)) - np.repeat(of[:-1], np.diff(of))
                draw = tx.mix(hashes ^ tx.mix(place.astype(np.uint64) + tx.seeded(turn)))
                at = np.flatnonzero(draw < np.uint64(int(HIDDEN_SHARE * 2.0**64)))
                around, words = _around(ids, of, at), ids[at]
                for a in range(0, len(at), BATCH):
                    descent.step(around[:, a : a + BATCH], words[a : a + BATCH])
                taught += len(at)
        for first, weight, values in ((0, taught, own.flat() if taught else ()), (-1, 1, pairs.held if pairs and pairs.held.any() else ())):
            for k, a in enumerate(range(0, len(values), BLOCK)):
                number, block = first - k if first else k, values[a : a + BLOCK].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([weight], pa.int64()), pa.array([block], pa.binary())], names=fields)

    def total(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for number, taught, values in zip(*(batch[k] for k in range(3))):
                number, taught = number.as_py(), taught.as_py()
                sums = held.setdefault(number, [0, 0])
                sums[0] += taught
                part = np.frombuffer(values.as_buffer(), np.int64 if number < 0 else np.float32)
                sums[1] = sums[1] + (part if number < 0 else part.astype(np.float64) * taught)
        for number, (taught, values) in held.items():
            block = (values if number < 0 else values / taught).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([taught], pa.int64()), pa.array([block], pa.binary())], names=fields)

    schema = "block long, taught long, values binary"
    reached = docs.select("text").mapInArrow(descend, schema)
    # The rows of a block meet in one task, which adds them up as they come; a task has a few blocks.
    tasks = -(-model.flat().size // (BLOCK * TOGETHER))
    averaged = reached.repartition(tasks, "block").mapInArrow(total, schema).toArrow()
    blocks = {number.as_py(): values.as_buffer() for number, values in zip(averaged["block"], averaged["values"])}
    if model.spelling is None:
        counts = [np.frombuffer(blocks[k], np.int64) for k in sorted((k for k in blocks if k < 0), reverse=True)]
        model = replace(model, spelling=spelling_of(np.concatenate(counts) if counts else np.zeros(257 * 257, np.int64)))
    values = [np.frombuffer(blocks[k], np.float64) for k in sorted(blocks) if k >= 0]
    return model.with_flat(np.concatenate(values)) if values else model


def train(docs: DataFrame, rounds: int = ROUNDS) -> Window:
    model = counted_model(docs) if rounds else first_model(docs)
    for turn in range(rounds):
        model = train_round(docs, model, turn)
    return model


def score(docs: DataFrame, model: Window) -> DataFrame:
    """doc_id, n_words, the sum of log-probabilities and its mean per word."""
    shared = docs.sparkSession.sparkContext.broadcast(model.bare())
    source = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_row"))
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("_row", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("_sum", T.DoubleType()),
            T.StructField("_rare", T.ArrayType(T.LongType())),
            T.StructField("_spelled", T.ArrayType(T.FloatType())),
        ]
    )

    def run(batches):
        inside, own = tx.table(SEPARATORS), shared.value
        for batch in batches:
            for chunk in tx.chunks(batch.column(1)):
                hashes, words, data = _spelled_words(chunk, inside)
                of, ids = words.of, own.word_ids(hashes)
                logs = np.zeros(len(ids))
                for a in range(0, len(ids), 1 << 15):
                    at = np.arange(a, min(a + (1 << 15), len(ids)))
                    logs[at] = own.log_probabilities(_around(ids, of, at), ids[at])
                running = np.concatenate([[0.0], np.cumsum(logs)])
                sums = running[of[1:]] - running[of[:-1]]
                rare = np.flatnonzero(ids == own.other)
                bounds = pa.array(np.searchsorted(rare, of), pa.int32())
                spelled = spell(own, data, words.start[rare], words.end[rare]).astype(np.float32)
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(np.diff(of), pa.int64()),
                        pa.array(sums),
                        pa.ListArray.from_arrays(bounds, pa.array(hashes[rare].view(np.int64))),
                        pa.ListArray.from_arrays(bounds, pa.array(spelled)),
                    ],
                    names=schema.names,
                )

    rows = staged(source.mapInArrow(run, schema), "network-scores")
    # Words without an id get their share of that id's probability from the counts of all words.
    words = rows.select("_row", F.explode(F.arrays_zip("_rare", "_spelled")).alias("x")).select(
        "_row", F.col("x._rare").alias("word"), F.col("x._spelled").alias("spelled")
    )
    all_of_them = float(max(model.others, 1))
    alone = math.log(max(model.once, 1) / all_of_them)
    share = F.when(F.col("n") > 1, F.log(F.col("n") / all_of_them)).otherwise(F.col("spelled") + alone)
    within = words.join(model.counts, "word", "left").groupBy("_row").agg(F.sum(share).alias("_within"))
    # Equal rows have one key; each brought its words.
    copies = rows.where(F.size("_rare") > 0).groupBy("_row").agg(F.count("*").alias("_copies"))
    within = within.join(copies, "_row").select("_row", (F.col("_within") / F.col("_copies")).alias("_within"))
    total = F.col("_sum") + F.coalesce("_within", F.lit(0.0))
    return (
        rows.select("doc_id", "_row", "n_words", "_sum")
        .join(within, "_row", "left")
        .select(
            "doc_id",
            "n_words",
            total.alias("pseudo_log_likelihood"),
            F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_probability"),
        )
    )
