"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and documents become lower-case words. The automaton accepts every run of words of
every item; feeding it a document's words gives, at each word, the longest run ending
there that some item holds. A run of ``WINDOW`` words that lies in an item (or a whole
item that is shorter) marks its words as hit. Runs of hit words are spans; cleaning
removes them, and drops documents that are mostly hit.

A pair of neighbouring words that no item holds brings the matched length back to one at
most, so the automaton only walks runs of known pairs that are long enough to hold a
window. A table of pair hashes finds these runs for a whole chunk of texts; being too
generous is harmless, since the automaton compares the words themselves.

An automaton holds about ``SHARD_WORDS`` item words; more items make several, built in
tasks, each applied to all documents in turn. Spans of all of them are cut together from
the text as given, and touched texts are matched again with all until none is found, so
results are the same for every number of automata.

Defined results: null or wordless texts have no hits; null or wordless items have no
window; items without an id are left out; items that repeat an id count once; each
document row is judged by itself.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from creditlens.llm import text as tx
from creditlens.session import staged

WINDOW = 10
#: Documents with a larger share of hit words are removed whole.
MOST_COVERED = 0.5
SHARD_WORDS = 100_000
#: Bytes that separate words: all of ASCII but digits and lower-case letters (capitals are lowered first).
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
INFO = "_leak"
NOW = "_leak_now"


def words_of(value: str | None) -> list[bytes]:
    body = (value or "").encode("utf-8", "surrogatepass").lower()
    return [w for w in re.split(b"[" + re.escape(SEPARATORS) + b"]+", body) if w]


@dataclass
class SuffixAutomaton:
    """Every run of words of every item; states also know the items they occur in."""

    window: int = WINDOW
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    moves: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    items: list[set] = field(default_factory=lambda: [set()])
    short: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    chained: list[bool] = field(default_factory=list)
    pairs: set[tuple[bytes, bytes]] = field(default_factory=set)
    singles: set[bytes] = field(default_factory=set)
    least: int = WINDOW

    def _extend(self, last: int, word: int) -> int:
        moves, link, length = self.moves, self.link, self.length
        known = moves[last].get(word)
        if known is not None:  # another item has this run
            return known if length[known] == length[last] + 1 else self._clone(last, word, known)
        new = self._state(length[last] + 1, {})
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = new
            at = link[at]
        if at < 0:
            link[new] = 0
        else:
            known = moves[at][word]
            link[new] = known if length[known] == length[at] + 1 else self._clone(at, word, known)
        return new

    def _state(self, size: int, moves: dict[int, int]) -> int:
        self.moves.append(moves)
        self.link.append(0)
        self.length.append(size)
        self.items.append(set())
        return len(self.moves) - 1

    def _clone(self, at: int, word: int, known: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.moves[known]))
        self.link[copy], self.link[known] = self.link[known], copy
        while at >= 0 and self.moves[at].get(word) == known:
            self.moves[at][word] = copy
            at = self.link[at]
        return copy

    @classmethod
    def build(cls, items: list[tuple[int, list[bytes]]], window: int = WINDOW) -> SuffixAutomaton:
        made = cls(window=window, least=window)
        coded = [(item, [made.vocabulary.setdefault(w, len(made.vocabulary)) for w in words]) for item, words in items]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = made._extend(last, code)
        for (item, words), (_, codes) in zip(items, coded):
            if not codes:
                continue
            made.least = min(made.least, len(codes))
            made.pairs.update(zip(words, words[1:]))
            if len(words) == 1:
                made.singles.add(words[0])
            state = 0
            for code in codes:
                state = made.moves[state][code]
                if len(codes) >= window:
                    at = state
                    while at > 0 and item not in made.items[at]:
                        made.items[at].add(item)
                        at = made.link[at]
            if len(codes) < window:
                made.short.setdefault(state, []).append((len(codes), item))
        # Whether a state or one above it ends a short item.
        made.chained = [False] * len(made.moves)
        for state in sorted(range(1, len(made.moves)), key=made.length.__getitem__):
            made.chained[state] = state in made.short or made.chained[made.link[state]]
        return made

    def walk(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """Hit windows as (first, last + 1), the items they occur in, the longest match."""
        hits, found, longest = [], set(), 0
        state = matched = 0
        moves, link, length, window = self.moves, self.link, self.length, self.window
        for i, word in enumerate(words):
            code = self.vocabulary.get(word, -1)
            while state and code not in moves[state]:
                state = link[state]
                matched = length[state]
            if code in moves[state]:
                state = moves[state][code]
                matched += 1
            longest = max(longest, matched)
            if matched >= window:
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                if self.items[at]:
                    hits.append((i + 1 - window, i + 1))
                    found |= self.items[at]
            if state and self.chained[state]:
                at, most = state, matched
                while at > 0:
                    for size, item in self.short.get(at, ()):
                        if size <= most:
                            hits.append((i + 1 - size, i + 1))
                            found.add(item)
                    at = link[at]
                    most = length[at]
        return hits, found, longest

    def sieve(self) -> tuple[np.ndarray, np.ndarray]:
        """Tables over hash bits that hold the pairs of all items, and the one-word items."""
        size = 1 << max(16, (64 * len(self.pairs)).bit_length())
        tables = np.zeros((2, size), bool)
        for k, runs in enumerate((sorted(self.pairs), [(w,) for w in sorted(self.singles)])):
            if runs:
                data = np.frombuffer(b"".join(b"".join(run) for run in runs), np.uint8)
                ends = np.cumsum([len(w) for run in runs for w in run])
                hashes = tx.hash_spans(data, np.concatenate([[0], ends[:-1]]), ends).reshape(len(runs), -1)
                tables[k, _slot(hashes[:, 0], hashes[:, -1] if k == 0 else hashes[:, 0], size)] = True
        return tables[0], tables[1]


def _slot(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    return ((first * np.uint64(tx.BASE) + second) >> np.uint64(20)) & np.uint64(size - 1)


def scan(chunk: tx.Chunk, automaton: SuffixAutomaton, sieve, inside: np.ndarray):
    """Word counts of a chunk's texts, and for each text with a match (hits, items, longest, words)."""
    lowered = tx.Chunk(chunk.first, chunk.last, LOWERED[chunk.data], chunk.offsets)
    words = tx.find_words(lowered, inside)
    counts = np.diff(words.of)
    found: dict[int, tuple[list, set, int]] = {}
    total = len(words.start)
    if total:
        hashes = tx.hash_spans(lowered.data, words.start, words.end)
        joined = np.zeros(total, bool)  # this word and the next are a pair of some item
        joined[:-1] = sieve[0][_slot(hashes[:-1], hashes[1:], len(sieve[0]))]
        ends = words.of[1:] - 1
        joined[ends[counts > 0]] = False
        first = np.flatnonzero(np.concatenate([[True], ~joined[:-1]]))
        last = np.flatnonzero(~joined)
        long = last - first + 1 >= automaton.least
        if automaton.least == 1:
            alone = sieve[1][_slot(hashes[first], hashes[first], len(sieve[1]))]
            long &= (last > first) | alone
        owners = np.searchsorted(words.of, first[long], "right") - 1
        for a, b, row in zip(first[long].tolist(), last[long].tolist(), owners.tolist()):
            run = [lowered.data[words.start[i] : words.end[i]].tobytes() for i in range(a, b + 1)]
            hits, items, longest = automaton.walk(run)
            kept = found.setdefault(row, ([], set(), [0]))
            base = a - int(words.of[row])
            kept[0].extend((base + x, base + y) for x, y in hits)
            kept[1].update(items)
            kept[2][0] = max(kept[2][0], longest)
    return counts, found, words


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Hit windows as disjoint runs of words."""
    spans: list[list[int]] = []
    for a, b in sorted(hits):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Automata:
    """Automata over all items, each of about ``most`` words, built in tasks and stored."""

    def __init__(self, items: DataFrame, window: int = WINDOW, most: int = SHARD_WORDS):
        self.window = window
        known = items.where("item_id IS NOT NULL").select("item_id", "text").distinct()
        total = known.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
        self.count = max(1, -(-total // most))
        self.kind = known.schema["item_id"].dataType

        def build(table: pa.Table) -> pa.Table:
            rows = sorted(zip(table["item_id"].to_pylist(), table["text"].to_pylist()), key=lambda r: (r[0], r[1] or ""))
            made = SuffixAutomaton.build([(item, words_of(text)) for item, text in rows], window)
            return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int32()), "automaton": pa.array([pickle.dumps(made)], pa.binary())})

        dealt = known.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count)).cast("int"))
        self.stored = staged(dealt.groupBy("shard").applyInArrow(build, "shard int, automaton binary"), "automata")

    def __iter__(self) -> Iterator[SuffixAutomaton]:
        """One after another, so that the driver and a task hold one at a time."""
        found = False
        for shard in range(self.count):
            row = self.stored.where(F.col("shard") == shard).select("automaton").first()
            if row is not None:
                found = True
                yield pickle.loads(row["automaton"])
        if not found:
            yield SuffixAutomaton.build([], self.window)


def _without(body: bytes, words: tx.Words, spans: list[tuple[int, int]]) -> bytes:
    """The bytes without runs of words, given by their numbers in order."""
    kept, at = [], 0
    for a, b in spans:
        kept.append(body[at : words.start[a]])
        at = words.end[b - 1]
    return b"".join([*kept, body[at:]])


def without_hits(value: str, automaton: SuffixAutomaton) -> str:
    """The text without its hit spans, repeated until joining the rest makes no new hit."""
    body = value.encode("utf-8", "surrogatepass")
    sieve, inside = automaton.sieve(), tx.table(SEPARATORS)
    while True:
        data = np.frombuffer(body, np.uint8)
        _, found, words = scan(tx.Chunk(0, 1, data, np.array([0, len(data)])), automaton, sieve, inside)
        spans = _merged(found[0][0]) if 0 in found else []
        if not spans:
            return body.decode("utf-8", "surrogatepass")
        body = _without(body, words, spans)


SPAN = "array<struct<first: long, end: long>>"


def _scanned(frame: DataFrame, keep: list[str], automaton: SuffixAutomaton, clean: bool, schema: T.StructType) -> DataFrame:
    """The columns ``keep``, which stand first, and what the next column, a text, holds besides what the last says already."""
    spark = frame.sparkSession
    shared = spark.sparkContext.broadcast(automaton)
    width, name = len(keep), schema.names[-1]
    kind = to_arrow_type(schema[-1].dataType["items"].dataType)

    def find(parts):
        own, inside = shared.value, tx.table(SEPARATORS)
        sieve = own.sieve()
        for part in parts:
            column, before = part[width], part[width + 1]
            n_words, n_hit, longest, items, spans, rewritten = [], [], [], [], [], []
            for chunk in tx.chunks(column):
                counts, found, _ = scan(chunk, own, sieve, inside)
                for row, count in enumerate(counts.tolist()):
                    hits, names, most = found.get(row, ((), (), (0,)))
                    earlier = before[chunk.first + row].as_py()
                    if earlier:
                        hits = [*hits, *((x["first"], x["end"]) for x in earlier["spans"])]
                        names = {*names, *earlier["items"]}
                        count, most = earlier["n_words"], (max(most[0], earlier["longest"]),)
                    joined = _merged(list(hits))
                    n_words.append(count)
                    n_hit.append(sum(b - a for a, b in joined))
                    longest.append(most[0])
                    items.append(sorted(names))
                    spans.append([{"first": a, "end": b} for a, b in joined])
                    if clean and row in found and found[row][0]:
                        rewritten.append(chunk.first + row)
            columns = list(part.columns[:width])
            if rewritten:
                at = keep.index("text")
                values = columns[at].to_pylist()
                for row in rewritten:
                    values[row] = without_hits(values[row], own)
                columns[at] = pa.array(values, columns[at].type)
            info = pa.StructArray.from_arrays(
                [
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(longest, pa.int64()),
                    pa.array(items, kind),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["n_words", "n_hit", "longest", "items", "spans"],
            )
            yield pa.RecordBatch.from_arrays([*columns, info], names=[*keep, name])

    return frame.mapInArrow(find, schema)


def _matched(docs: DataFrame, keep: list[str], automata: Automata, clean: bool, name: str) -> DataFrame:
    """The columns ``keep`` and a struct ``name`` of the matches of ``text`` in all automata."""
    kind = T.StructType.fromDDL(f"n_words long, n_hit long, longest long, items array<{automata.kind.simpleString()}>, spans {SPAN}")
    result = docs.select(*docs.columns, F.col("text").alias("_leak_text"), F.lit(None).cast(kind).alias(name))
    made = iter(automata)
    automaton = next(made)
    while automaton is not None:
        following = next(made, None)
        # Between automata the text as given is carried along, so that word numbers stay the same.
        columns = list(keep) if following is None else [*docs.columns, "_leak_text"]
        source = result.select(*columns, F.col("_leak_text").alias("_leak_scanned"), name)
        schema = T.StructType([*result.select(*columns).schema.fields, T.StructField(name, kind)])
        result = _scanned(source, columns, automaton, clean, schema)
        if following is not None:
            result = staged(result, "leak-shard")
        automaton = following
    return result


def _cut(frame: DataFrame, name: str) -> DataFrame:
    """``text`` without the spans that ``name`` holds."""

    def run(batches):
        inside = tx.table(SEPARATORS)
        for batch in batches:
            at, info = batch.schema.names.index("text"), batch.column(batch.schema.names.index(name)).to_pylist()
            values = batch.column(at).to_pylist()
            for row, held in enumerate(info):
                if held["spans"]:
                    body = values[row].encode("utf-8", "surrogatepass")
                    data = LOWERED[np.frombuffer(body, np.uint8)]
                    words = tx.find_words(tx.Chunk(0, 1, data, np.array([0, len(data)])), inside)
                    values[row] = _without(body, words, [(x["first"], x["end"]) for x in held["spans"]]).decode("utf-8", "surrogatepass")
            columns = list(batch.columns)
            columns[at] = pa.array(values, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return frame.mapInArrow(run, frame.schema)


def _cleaned(found: DataFrame, automata: Automata) -> DataFrame:
    """Texts cut by the spans of all automata at once, and again until no automaton finds any.

    As with a single automaton, what is cut does not depend on how items are dealt.
    """
    touched = F.size(f"{NOW}.spans") > 0
    now = staged(found.withColumn(NOW, F.col(INFO)), "leaks")
    ready = now.where(~touched).drop(NOW)
    while not (open_ := now.where(touched)).isEmpty():
        cut = staged(_cut(open_, NOW).drop(NOW), "leaks-cut")
        now = staged(_matched(cut, cut.columns, automata, False, NOW), "leaks")
        ready = ready.unionByName(now.where(~touched).drop(NOW))
    return ready


def find_leaks(docs: DataFrame, items: DataFrame, keep: list[str], window: int = WINDOW, clean: bool = False, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The columns ``keep`` of every document and a struct of its matches.

    The struct has n_words, n_hit, longest match, sorted item ids and spans of hit words
    (first and end as word numbers). With ``clean`` the kept text has lost its spans.
    """
    automata = Automata(items, window, shard_words)
    # A single automaton cuts in the same pass.
    found = _matched(docs, keep, automata, clean and automata.count == 1, INFO)
    return _cleaned(found, automata) if clean and automata.count > 1 else found


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, most_covered: float = MOST_COVERED, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Documents without benchmark spans; those that are mostly benchmark go whole."""
    cleaned = find_leaks(docs, items, docs.columns, window, clean=True, shard_words=shard_words)
    covered = F.col(f"{INFO}.n_hit") > most_covered * F.col(f"{INFO}.n_words")
    return cleaned.where(~covered).select(*docs.columns)

