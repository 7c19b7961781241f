"""Quality by positive-unlabelled learning.

Trusted documents (label 1) are the positives; documents that no label names are the
unlabelled web text. The share of good documents in the latter, the class prior, is
estimated first: a plain positive-against-unlabelled model ranks held-back rows of both,
and the best bin at the top of the ranking, with its sampling error added, bounds the
share. Then a small network is trained in numpy to minimise the non-negative unbiased
risk

    prior * loss(positives, +1) + max(0, loss(unlabelled, -1) - prior * loss(positives, -1))

with the logistic loss; where the bracket turns negative the step goes back along it.
The output estimates the probability of a good document. Labels of 0 teach nothing.

Inputs are shapes of the whole text only (``FEATURES``). The samples are bounded: the
first ``MOST_ROWS`` positives and unlabelled rows by hash of id.

Defined results: null and empty texts have zero features and get their score; without
positives or unlabelled rows every score is 1, as nothing speaks against a document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.llm import text as tx
from creditlens.llm.toxicity import Adam
from creditlens.session import staged

MOST_ROWS = 12_000
EPOCHS = 40
BATCH = 512
HIDDEN = 32
RATE = 0.003
SEED = 5
FEATURES = (
    "log_words", "word_length", "long_words", "distinct_words", "doubled_words", "upper", "digits", "punctuation", "marks",
    "symbols", "bars", "exclaims", "beyond_ascii", "line_length", "repeated_lines", "one_word_lines", "spread", "symbol_ends",
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features(chunk: tx.Chunk, inside: np.ndarray) -> np.ndarray:
    """One row per text."""
    data, of = chunk.data, chunk.offsets
    rows = len(of) - 1
    words = tx.find_words(chunk, inside)
    hashes = tx.hash_spans(data, words.start, words.end)
    counts = np.diff(words.of)
    owner = words.text()
    points = (data & 0xC0) != 0x80
    chars = tx.per_text(points, of)
    letters = tx.per_text(inside[data] & points, of)

    def bytes_in(listed: bytes) -> np.ndarray:
        chosen = np.zeros(256, bool)
        chosen[list(listed)] = True
        return tx.per_text(chosen[data], of)

    length = words.end - words.start
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[new], minlength=rows)
    doubled = np.zeros(len(hashes), bool)
    doubled[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    ends_odd = np.zeros(len(hashes), bool)
    if len(hashes):
        odd = np.zeros(256, bool)
        odd[list(b"#*$%&|<>!")] = True
        ends_odd = odd[data[words.end - 1]]
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([of[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, of[1:]]))
    line_of = np.searchsorted(of, start, "right") - 1
    line_of = np.minimum(line_of, rows - 1)
    first = np.searchsorted(words.start, start)
    in_line = np.searchsorted(words.start, end) - first
    line = tx.hash_spans(data, start, end)
    order = np.lexsort((line, line_of))
    a, b = line[order], line_of[order]
    again = np.zeros(len(a), bool)
    again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    lines = np.bincount(line_of, minlength=rows)
    squares = np.bincount(owner, weights=length.astype(float) ** 2, minlength=rows)
    mean = _share(np.bincount(owner, weights=length, minlength=rows), counts)
    return np.stack(
        [
            np.log1p(counts),
            _share(letters, counts) / 10,
            _share(np.bincount(owner, weights=length > 20, minlength=rows), counts),
            _share(distinct, counts),
            _share(tx.per_text(doubled, words.of), counts),
            _share(tx.per_text((data >= 65) & (data <= 90), of), letters),
            _share(tx.per_text((data >= 48) & (data <= 57), of), letters),
            _share(bytes_in(b".,;:"), counts),
            _share(bytes_in(b"'\"()[]{}-_/\\@=+~`^"), counts),
            _share(bytes_in(b"#*$%&<>"), counts),
            _share(bytes_in(b"|"), counts),
            _share(bytes_in(b"!?"), counts),
            _share(tx.per_text(data >= 0xC0, of), chars),
            np.log1p(_share(counts, lines)),
            _share(np.bincount(b, weights=again, minlength=rows), lines),
            _share(np.bincount(line_of, weights=in_line == 1, minlength=rows), lines),
            np.sqrt(np.maximum(_share(squares, counts) - mean**2, 0)) / 10,
            _share(tx.per_text(ends_odd, words.of), counts),
        ],
        axis=1,
    ).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    prior: float
    taught: bool = True

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.layers[0] + self.layers[1], 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.layers[2] + self.layers[3][0]

    def normal(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.taught:
            return np.ones(len(x))
        return 1 / (1 + np.exp(-np.clip(self.logits(self.normal(x)).astype(np.float64), -50, 50)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _new(width: int, mean: np.ndarray, spread: np.ndarray, rng) -> Model:
    layers = [rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)]
    return Model(mean, spread, layers, 0.5)


def _descend(model: Model, adam: Adam, x: np.ndarray, slope: np.ndarray) -> None:
    """One step along the loss's slope at each row's output."""
    h = model.hidden(x)
    back = (slope[:, None] * model.layers[2][None]) * (h > 0)
    adam.t += 1
    gradients = [x.T @ back + 1e-4 * model.layers[0], back.sum(axis=0), h.T @ slope + 1e-4 * model.layers[2], np.array([slope.sum()])]
    for i, gradient in enumerate(gradients):
        adam.step(f"layer{i}", model.layers[i], gradient)


def _batches(n: int, m: int, rng):
    """Matching batches of row numbers of two samples, as many as the larger has."""
    steps = max(1, -(-max(n, m) // BATCH))
    first, second = (np.resize(rng.permutation(k), steps * min(BATCH, k)).reshape(steps, -1) for k in (n, m))
    yield from zip(first, second)


def risk_parts(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """prior * positive risk, and the bracket of the unbiased risk, from outputs."""
    as_good, as_bad = np.logaddexp(0, -positive).mean(), np.logaddexp(0, positive).mean()
    return prior * as_good, float(np.logaddexp(0, unlabelled).mean() - prior * as_bad)


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, model: Model, epochs: int, rng, plain: bool = False) -> Model:
    """Minimise the non-negative risk, or with ``plain`` tell the two samples apart."""
    adam = Adam(RATE)
    for _ in range(epochs):
        for a, b in _batches(len(positive), len(unlabelled), rng):
            p, u = positive[a], unlabelled[b]
            x = np.concatenate([p, u])
            gp, gu = model.logits(p), model.logits(u)
            if plain:
                slope = np.concatenate([(_sigmoid(gp) - 1) / len(p), _sigmoid(gu) / len(u)])
            elif risk_parts(gp, gu, prior)[1] >= 0:
                slope = np.concatenate([prior * ((_sigmoid(gp) - 1) - _sigmoid(gp)) / len(p), _sigmoid(gu) / len(u)])
            else:  # the bracket has overshot: go back along it alone
                slope = -np.concatenate([-prior * _sigmoid(gp) / len(p), _sigmoid(gu) / len(u)])
            _descend(model, adam, x, slope)
    return model


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, error: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of rows kept back: the best bin at the top."""
    cuts = np.sort(positive)
    above_p = 1 - np.searchsorted(cuts, cuts) / len(cuts)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    slack = np.sqrt(np.log(4 / error) / (2 * len(unlabelled))) + np.sqrt(np.log(4 / error) / (2 * len(positive)))
    best = int(np.argmin(above_u / above_p + slack / above_p))
    return float(min(max(above_u[best] / above_p[best], 0.01), 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray, seed: int = SEED) -> Model:
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    if min(len(positive), len(unlabelled)) < 4:
        model = _new(both.shape[1], np.zeros(both.shape[1]), np.ones(both.shape[1]), rng)
        model.taught = False
        return model
    model = _new(both.shape[1], both.mean(axis=0), both.std(axis=0) + 1e-6, rng)
    p, u = model.normal(positive), model.normal(unlabelled)
    plain = fit_pu(p[::2], u[::2], 0.5, _new(p.shape[1], model.mean, model.spread, rng), EPOCHS // 4, rng, plain=True)
    model.prior = estimated_prior(plain.logits(p[1::2]), plain.logits(u[1::2]))
    return fit_pu(p, u, model.prior, model, EPOCHS, rng)


def with_features(docs: DataFrame) -> DataFrame:
    source = docs.select("doc_id", "text")
    schema = T.StructType([source.schema["doc_id"], T.StructField("shape", T.ArrayType(T.FloatType()))])

    def run(batches):
        inside = tx.table(tx.SPACES)
        for batch in batches:
            for chunk in tx.chunks(batch.column(1)):
                x = features(chunk, inside)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.last - chunk.first), lists], names=schema.names)

    return source.mapInArrow(run, schema)


def _matrix(frame: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` rows of features, first by hash of id."""
    rows = frame.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("shape").toArrow()["shape"].combine_chunks()
    return rows.flatten().to_numpy().reshape(-1, len(FEATURES))


def classify(docs: DataFrame, labels: DataFrame, teaches, most: int = MOST_ROWS) -> tuple[DataFrame, Model]:
    """doc_id and score of every document, from labels for which ``teaches`` holds."""
    shaped = staged(with_features(docs), "quality-shapes")
    good = labels.where((F.col("quality") == 1) & teaches).select("doc_id").distinct()
    positive = _matrix(shaped.join(good, "doc_id", "left_semi"), most)
    unlabelled = _matrix(shaped.where("doc_id IS NOT NULL").join(labels.select("doc_id").distinct(), "doc_id", "left_anti"), most)
    model = train(positive, unlabelled)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([shaped.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(x))], names=schema.names)

    return shaped.mapInArrow(run, schema), model
