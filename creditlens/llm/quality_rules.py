"""Quality rules whose cutoffs carry a guarantee: exact binomial bounds on labelled documents.

Each document gets counts of its whole text. A rule rejects when its ratio lies above a
cutoff. For each stratum (language) and rule the cutoffs of a fixed grid are tested from
the mildest to the strictest: the hypothesis "this cutoff rejects more than ``risk`` of
the good documents" is discarded when the exact binomial probability of so few rejected
good labels is at most ``error`` divided by the number of strata and rules. Testing in a
fixed order stops at the first hypothesis that stands, so the order needs no further
correction. With probability 1 - ``error`` all strata then keep their bound together:
at most ``risk`` of good documents lost by each rule, ``risk`` times rules in all. The
labels only choose cutoffs, no rule is fitted to them, so all of them are holdout.

Defined results: a null text has no words; a document of a null or unlabelled language
has no cutoffs and only the base rules; too few labels certify no cutoff; labels that
are null or name no document count for nothing; repeated documents count each time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.llm import text as tx
from creditlens.session import staged

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words
RISK = 0.004
ERROR = 0.05
SYMBOLS = b"#*$%&|<>"

#: Ratio of each rule, and its grid of cutoffs.
RULES = {
    "symbols": ("n_symbols", "n_words", (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 1.2, 2.0)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8)),
    "repeats": ("n_repeat_words", "n_words", (0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3)),
    "upper": ("n_upper", "word_chars", (0.08, 0.12, 0.16, 0.2, 0.3, 0.4, 0.5, 0.7)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")
STATS = "_rule_counts"


def _count(chunk: tx.Chunk, inside: np.ndarray, symbol: np.ndarray) -> dict[str, np.ndarray]:
    data, of = chunk.data, chunk.offsets
    rows = len(of) - 1
    words = tx.find_words(chunk, inside)
    in_word = inside[data]
    code_point = (data & 0xC0) != 0x80
    result = {
        "n_words": np.diff(words.of),
        "word_chars": tx.per_text(in_word & code_point, of),
        "n_symbols": tx.per_text(symbol[data], of),
        "n_upper": tx.per_text((data >= 65) & (data <= 90), of),
    }

    # Lines: a break ends one, and so does the text.
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([of[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([breaks, of[1:]]))
    running = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=running[1:])
    filled = running[line_end] > running[line_start]
    line_start, line_end = line_start[filled], line_end[filled]
    owner = np.searchsorted(of, line_start, "right") - 1
    line = tx.mix(tx.hash_spans(data, line_start, line_end) + owner.astype(np.uint64) * np.uint64(tx.BASE))
    result["n_lines"] = np.bincount(owner, minlength=rows)
    _, kept = np.unique(line, return_index=True)
    result["n_dup_lines"] = result["n_lines"] - np.bincount(owner[kept], minlength=rows)

    # Windows of words that occur again in their text, and the words they cover.
    hashes = tx.hash_spans(data, words.start, words.end)
    window, first = tx.windows(hashes, words.of, WINDOW)
    result["n_repeat_words"] = np.zeros(rows, np.int64)
    if len(window):
        window = tx.mix(window + words.text()[first].astype(np.uint64) * np.uint64(tx.BASE))
        ordered = np.sort(window)
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(again):
            at = np.minimum(np.searchsorted(again, window), len(again) - 1)
            hit = first[again[at] == window]
            step = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(step, hit, 1)
            np.add.at(step, hit + WINDOW, -1)
            result["n_repeat_words"] = tx.per_text(np.cumsum(step[:-1]) > 0, words.of)
    return result


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every document, and a struct of its counts."""
    source = docs.select(*keep, F.col("text").alias("_rule_text"))
    schema = T.StructType(
        [*docs.select(*keep).schema.fields]
        + [T.StructField(STATS, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))]
    )

    def count(batches):
        inside, symbol = tx.table(tx.SPACES), ~tx.table(SYMBOLS)
        for batch in batches:
            parts = [_count(c, inside, symbol) for c in tx.chunks(batch.column(len(keep)))]
            columns = [
                pa.array(np.concatenate([p[name] for p in parts]) if parts else [], pa.int64()) for name in COUNTS
            ]
            stats = pa.StructArray.from_arrays(columns, names=list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], stats], names=[*keep, STATS])

    return source.mapInArrow(count, schema)


def ratio(rule: str):
    above, below, _ = RULES[rule]
    count = F.col(f"{STATS}.{below}")
    return F.when(count > 0, F.col(f"{STATS}.{above}") / count).otherwise(F.lit(0.0))


def lower_tail(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` of ``n`` at rate ``p``; 1 where ``k`` is above the mean."""
    if n == 0 or k >= n * p:
        return 1.0
    i = np.arange(k + 1)
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i]
    return float(np.exp(np.array(logs) + i * math.log(p) + (n - i) * math.log1p(-p)).sum())


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum with the strictest certified cutoff of each rule (null: none).

    ``counted`` has doc_id, lang and the counts. Only one row per stratum leaves the
    aggregation, however many labels there are.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").alias("_good_id")).distinct()
    held = counted.join(good, F.col("doc_id") == F.col("_good_id"), "left_semi").where("lang IS NOT NULL")
    tallies = [
        F.count_if(ratio(rule) > cutoff).alias(f"{rule}_{i}")
        for rule, (_, _, grid) in RULES.items()
        for i, cutoff in enumerate(grid)
    ]
    table = staged(held.groupBy(F.col("lang").alias("_stratum")).agg(F.count("*").alias("n"), *tallies), "rule-tallies")
    level = error / (max(table.count(), 1) * len(RULES))

    @F.pandas_udf("double")
    def tail(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([lower_tail(int(a), int(b), risk) for a, b in zip(k, n)])

    chosen = []
    for rule, (_, _, grid) in RULES.items():
        tested = [F.struct(F.lit(c).alias("cutoff"), tail(f"{rule}_{i}", "n").alias("p")) for i, c in enumerate(grid)]
        # From the mildest down; a cutoff stands when no milder one, nor itself, failed.
        failed = F.array_max(F.transform(F.filter(F.col(rule), lambda x: x.p > level), lambda x: x.cutoff))
        passed = F.filter(F.col(rule), lambda x: failed.isNull() | (x.cutoff > failed))
        chosen.append((rule, F.array(*tested), F.array_min(F.transform(passed, lambda x: x.cutoff))))
    for rule, tested, _ in chosen:
        table = table.withColumn(rule, tested)
    return staged(table.select("_stratum", *[pick.alias(f"_{rule}_cutoff") for rule, _, pick in chosen]), "rule-cutoffs")


def verdicts(counted: DataFrame, chosen: DataFrame) -> DataFrame:
    """Adds base_failed and kept. ``chosen`` is small and read from files, so Spark sees its size."""
    judged = counted.join(chosen, F.col("lang") == F.col("_stratum"), "left")
    words, repeated = F.col(f"{STATS}.n_words"), F.col(f"{STATS}.n_repeat_words")
    failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(ratio(rule) > F.col(f"_{rule}_cutoff"), F.lit(False))
    judged = judged.withColumn("_base_failed", failed).withColumn("_kept", ~failed & ~rejected)
    return judged.drop("_stratum", *[f"_{rule}_cutoff" for rule in RULES])


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Counts and verdict of every document."""
    counted = staged(with_counts(docs, ["doc_id", "lang"]), "rule-counts")
    return verdicts(counted, cutoffs(counted, labels, risk, error))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The documents that pass, with all their columns. Texts are counted twice, never shuffled."""
    counted = staged(with_counts(docs, ["doc_id", "lang"]), "rule-counts")
    chosen = cutoffs(counted, labels, risk, error)
    again = with_counts(docs, docs.columns)
    return verdicts(again, chosen).where("_kept").select(*docs.columns)
