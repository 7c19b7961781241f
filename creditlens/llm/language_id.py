"""Languages by interpolated Kneser-Ney models of characters, one per language.

A text counts as its letters in lower case, with one blank where others stand between. Each
letter is a 16-bit unit (letters beyond the basic plane share 6,400 units), so a run of
four is one 64-bit number and shorter runs are its lower bits.

Runs of four are counted over all texts that teach, by Spark; counts of shorter runs are
the numbers of different letters seen before them. A run's share is its count less the
language's discount, over its context's total; the mass taken away goes to the next
shorter run, at last to all units alike. A model holds at most ``MODEL_GRAMS`` runs over
all languages and lengths: where there are more, those of the lowest counts go, and their
mass goes to the shorter runs too, so probabilities always sum to 1. Per language they lie
in one array sorted by a hash of the run.

The language with the lowest cross-entropy per unit is chosen. A tenth of the teaching
texts, by a hash of the text, is kept from the counts of languages with ``LEAST_ROWS`` or more
and calibrates two things: a limit per language that ``REJECTED`` of its own texts exceed
(texts above it are not accepted), and how sharply a difference in entropy turns into a score.

Defined results: a null text or one without letters is ``und`` with score 0 and accepted;
equal entropies go to the first language by bytes; rows without text or language teach
nothing; without any teaching text all is ``und``; repeated rows count as often as they appear;
a language without calibration texts has no limit.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.llm import text as tx
from creditlens.session import staged

ORDER = 4
BITS = 16
UNITS = 1 << BITS
BLANK = 0x20
UNKNOWN = "und"
#: Runs that a model keeps in all, 12 bytes each; contexts are fewer.
MODEL_GRAMS = 4_000_000
#: Different runs that a task holds before it passes them on.
HELD_GRAMS = 2_000_000
LEAST_ROWS = 200
CALIBRATION = 10
REJECTED = 0.005
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)


@functools.cache
def _letters() -> np.ndarray:
    """The unit of every code point, 0 for what is no letter."""
    units = np.zeros(0x110000, np.uint16)
    for point in range(0x110000):
        if chr(point).isalpha():
            units[point] = point if point < UNITS else 0xE000 + point % 6400
    return units


def units_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Units of the texts end to end, each with a lead of blanks, and where each lead begins."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    of = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    units = _letters()[points]
    letter = units != 0
    after = np.zeros(len(points) + 1, bool)
    after[1:] = letter
    after[of] = False
    keep = letter | after[:-1]
    kept = np.where(letter, units, BLANK)[keep].astype(np.uint64)
    lengths = np.diff(np.concatenate([[0], np.cumsum(keep)])[of])
    lead = ORDER - 1
    starts = np.concatenate([[0], np.cumsum(lengths + lead)]).astype(np.int64)
    padded = np.full(int(starts[-1]), BLANK, np.uint64)
    at = np.arange(len(kept)) + lead * (np.repeat(np.arange(len(lengths)), lengths) + 1)
    padded[at] = kept
    return padded, starts


def runs_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The run that ends at each unit, as numbers, and the bounds of the texts."""
    padded, starts = units_of(texts)
    lead = ORDER - 1
    n = len(padded)
    if n <= lead:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    runs = np.zeros(n, np.uint64)
    for back in range(ORDER):
        runs[back:] |= padded[: n - back] << np.uint64(BITS * back)
    inside = np.ones(n, bool)
    for back in range(lead):
        inside[starts[:-1] + back] = False
    return runs[inside], starts - lead * np.arange(len(starts))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, where, np.concatenate([n for _, n in parts]))
    return keys, counts


def _texts(batch: pa.RecordBatch, column: int):
    """Chunks of rows and their texts."""
    for chunk in tx.chunks(batch.column(column)):
        size = chunk.last - chunk.first
        yield chunk.first, size, batch.column(column).slice(chunk.first, size).to_pylist()


def counted(taught: DataFrame) -> DataFrame:
    """lang, gram and n: the runs of all texts of a language, counted."""

    def run(batches):
        held: dict[str, list] = {}

        def passed():
            for lang, parts in held.items():
                keys, counts = _merged(parts)
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(keys), np.int32)))
                yield pa.RecordBatch.from_arrays([langs, pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, size, texts in _texts(batch, 1):
                by_lang: dict[str, list] = {}
                for lang, text in zip(langs[first : first + size], texts):
                    by_lang.setdefault(lang, []).append(text)
                for lang, own in by_lang.items():
                    held.setdefault(lang, []).append(np.unique(runs_of(own)[0], return_counts=True))
                if sum(len(k) for parts in held.values() for k, _ in parts) > HELD_GRAMS:
                    for lang, parts in held.items():
                        held[lang] = [_merged(parts)]
                    if sum(len(parts[0][0]) for parts in held.values()) > HELD_GRAMS / 2:
                        yield from passed()
        yield from passed()

    found = taught.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def by_length(counts: DataFrame) -> DataFrame:
    """lang, length, gram and n of the runs of all lengths; n of shorter ones counts the units before them."""
    own = staged(counts, "runs")
    frames = [own.select("lang", F.lit(ORDER).alias("length"), "gram", "n")]
    for length in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << BITS * length) - 1).alias("gram")
        grouped = frames[-1].groupBy("lang", shorter).agg(F.count(F.lit(1)).alias("n"))
        frames.append(grouped.select("lang", F.lit(length).alias("length"), "gram", "n"))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return staged(result, "runs-by-length")


def discount(once: int, twice: int) -> float:
    """The usual estimate from how many runs were seen once and twice."""
    return once / (once + 2 * twice) if once and twice else 0.5


@dataclass
class Model:
    langs: list[str]
    grams: list[np.ndarray]  # hashes of runs, sorted
    values: list[np.ndarray]
    contexts: list[np.ndarray]  # hashes of contexts, sorted
    weights: list[np.ndarray]
    limits: dict[str, float]
    sharpness: float = 8.0

    @staticmethod
    def _get(keys: np.ndarray, stored: np.ndarray, asked: np.ndarray, otherwise: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(asked), otherwise)
        hashes = tx.mix(asked)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, stored[at], otherwise)

    def probabilities(self, lang: int, runs: np.ndarray) -> np.ndarray:
        """Of each run's last unit after the others."""
        p = np.full(len(runs), 1 / UNITS)
        for length in range(1, ORDER + 1):
            own = runs & np.uint64((1 << BITS * length) - 1)
            weight = self._get(self.contexts[lang], self.weights[lang], own >> np.uint64(BITS), 1.0)
            p = self._get(self.grams[lang], self.values[lang], own, 0.0) + weight * p
        return p

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per unit by text and language, and the texts' lengths in units."""
        runs, of = runs_of(texts)
        lengths = np.diff(of)
        found, where = np.unique(runs, return_inverse=True)
        out = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(lengths)
        for lang in range(len(self.langs)) if len(full) else ():
            # A weight that rounds to 0 leaves no chance to unseen units.
            bits = -np.log2(np.maximum(self.probabilities(lang, found), 2.0**-64))
            out[full, lang] = np.add.reduceat(bits[where], of[:-1][full]) / lengths[full]
        return np.round(out, 9), lengths


def _arrays(frame: DataFrame, langs: int, value: str) -> tuple[list, list]:
    """Per language, hashes and numbers in the order of hashes."""
    table = frame.select("lang_no", "gram", value).toArrow()
    of, keys = table["lang_no"].to_numpy(), tx.mix(table["gram"].to_numpy().view(np.uint64))
    numbers = table[value].to_numpy()
    order = np.lexsort((keys, of))
    cuts = np.searchsorted(of[order], np.arange(langs + 1))
    parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
    return [keys[p] for p in parts], [numbers[p].astype(np.float32) for p in parts]


def estimated(grams: DataFrame, most: int = MODEL_GRAMS) -> Model:
    """The models from counts by length."""
    step = F.floor(8 * F.log2(F.col("n"))).cast("int")
    stats = grams.groupBy("lang", "length", step.alias("step")).agg(
        F.count(F.lit(1)).alias("k"),
        F.min("n").alias("low"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
    )
    by_model: dict[tuple, list] = {}
    for row in stats.collect():  # a few hundred steps per language and length
        by_model.setdefault((row["lang"], row["length"]), []).append(row)
    langs = sorted({lang for lang, _ in by_model}, key=lambda x: x.encode())
    room, params = most // max(len(langs) * ORDER, 1), []
    for (lang, length), rows in sorted(by_model.items()):
        least, total = None, 0
        for row in sorted(rows, key=lambda r: -r["step"]):
            total += row["k"]
            if total > room:
                break
            least = row["low"]
        cut = discount(sum(r["once"] for r in rows), sum(r["twice"] for r in rows))
        params.append((lang, length, langs.index(lang), cut, least))
    schema = "lang string, length int, lang_no int, discount double, least long"
    # Four rows per language.
    known = grams.join(F.broadcast(grams.sparkSession.createDataFrame(params, schema)), ["lang", "length"])
    known = known.withColumn("context", F.shiftrightunsigned("gram", BITS))
    share = F.when(F.col("n") >= F.col("least"), F.col("n") - F.col("discount"))
    totals = known.groupBy("lang_no", "length", "context").agg(F.sum("n").alias("total"), F.sum(share).alias("kept"))
    totals = totals.where(F.col("kept") > 0)
    weights = totals.select("lang_no", F.col("context").alias("gram"), (1 - F.col("kept") / F.col("total")).alias("weight"))
    values = known.where(share > 0).join(totals, ["lang_no", "length", "context"])
    values = values.select("lang_no", "gram", (share / F.col("total")).alias("value"))
    return Model(langs, *_arrays(values, len(langs), "value"), *_arrays(weights, len(langs), "weight"), {})


def fit(docs: DataFrame, teaches: Column, most: int = MODEL_GRAMS) -> Model:
    """Models of all languages among the rows that teach, and their calibration."""
    taught = docs.where(teaches & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sizes = taught.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS)
    large = [r["lang"] for r in sizes.select("lang").collect()]
    spared = F.col("lang").isin(large) & (F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0)
    model = estimated(by_length(counted(taught.where(~spared))), most)
    if model.langs and large:
        calibrate(model, taught.where(spared))
    return model


def calibrate(model: Model, rows: DataFrame) -> None:
    """Set the model's limits and sharpness from texts of known language that it has not counted."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = "lang string, entropy double, losses array<double>"

    def run(batches):
        own = shared.value
        number = {lang: i for i, lang in enumerate(own.langs)}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, size, texts in _texts(batch, 1):
                bits, lengths = own.entropies(texts)
                true = np.array([number.get(lang, -1) for lang in langs[first : first + size]])
                use = np.flatnonzero((lengths > 0) & (true >= 0))
                bits, true = bits[use], true[use]
                at = bits[np.arange(len(use)), true]
                losses = np.stack([np.log(np.exp2(-s * np.maximum(bits - at[:, None], -60 / s)).sum(axis=1)) for s in SHARPNESS], axis=1)
                ends = pa.array(np.arange(len(use) + 1) * len(SHARPNESS), pa.int32())
                names = pa.array([own.langs[i] for i in true], pa.string())
                lists = pa.ListArray.from_arrays(ends, pa.array(losses.ravel()))
                yield pa.RecordBatch.from_arrays([names, pa.array(at), lists], names=["lang", "entropy", "losses"])

    found = rows.mapInArrow(run, schema).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("entropy", 1 - REJECTED, 10_000).alias("limit"),
        *[F.sum(F.col("losses")[i]).alias(f"loss{i}") for i in range(len(SHARPNESS))],
    )
    rows_ = found.collect()  # one row per language
    model.limits = {r["lang"]: r["limit"] for r in rows_}
    if rows_:
        model.sharpness = min(SHARPNESS, key=lambda s: math.fsum(r[f"loss{SHARPNESS.index(s)}"] for r in rows_))


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` with _lang, _score, _entropy (bits per unit) and _accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.struct(*keep).alias("kept"), "text")
    schema = T.StructType(
        [
            source.schema["kept"],
            T.StructField("lang", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("entropy", T.DoubleType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )

    def run(batches):
        own = shared.value
        limits = np.array([own.limits.get(lang, math.inf) for lang in own.langs])
        for batch in batches:
            for first, size, texts in _texts(batch, 1):
                if own.langs:
                    bits, lengths = own.entropies(texts)
                    best = bits.argmin(axis=1)
                    least = bits[np.arange(size), best]
                    score = 1 / np.exp2(-own.sharpness * (bits - least[:, None])).sum(axis=1)
                    known, accepted = lengths > 0, (lengths == 0) | (least <= limits[best])
                else:
                    best, least, score, known, accepted = *np.zeros((3, size)), np.zeros(size, bool), np.ones(size, bool)
                names = [own.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                entropy = pa.array(least, mask=~known)
                columns = [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), entropy, pa.array(accepted)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, size), *columns], names=schema.names)

    found = source.mapInArrow(run, schema)
    return found.select(
        *[F.col("kept")[name].alias(name) for name in keep],
        F.col("lang").alias("_lang"),
        F.col("score").alias("_score"),
        F.col("entropy").alias("_entropy"),
        F.col("accepted").alias("_accepted"),
    )
