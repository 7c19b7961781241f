"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The vocabulary of a merge-type model is read from a file that the caller names. A text
gets a blank in front, blanks become the model's blank mark, and neighbouring symbols
are merged best score first, leftmost first among equals, as the agenda of such an
encoder does. With dropout, a candidate merge is skipped for good when the keyed hash of
(seed, document, position, unit, place) falls below the rate. Nothing is drawn at random,
so a lost task gives the same pieces again.

A unit is a run of blanks and what follows up to the next blank; line breaks stand
alone. No piece of the vocabulary crosses these bounds (checked when it is read), so
units are encoded apart. Every occurrence of a unit skips by a key of its own, a hash of
seed, document and position, and is merged by itself. All units of a chunk are merged side
by side in arrays; units over ``LONG`` symbols use a heap.

Characters outside the vocabulary, and a blank mark that stands in the text itself,
become bytes, so decoding gives back every text exactly.

Defined results: a null text has null pieces and decodes to null; an empty text has
none; at rate 0 the pieces are those of the sentencepiece library (but for texts with a
literal blank mark).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.llm import text as tx

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE = 0.1
SEED = 17
LONG = 48
#: Bytes of text encoded, and ids decoded, at a time.
ENCODED = 1 << 18
DECODED = 1 << 18
MARK = "▁"
NONE = np.int64(1) << np.int64(62)


@dataclass
class Pieces:
    """Tables of a vocabulary: bytes of each piece, ids of characters, and all merges."""

    body: np.ndarray  # bytes of all pieces, the mark as a blank
    begin: np.ndarray
    size: np.ndarray
    of_char: np.ndarray  # id by code point, -1 where there is none
    of_byte: np.ndarray  # ids of the 256 byte pieces
    keys: np.ndarray  # open-addressing table of pairs (left << 32 | right), 0 where empty
    joined: np.ndarray  # id of the joined piece
    rank: np.ndarray  # by id, smaller merges first
    probes: int

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        scores = np.array([model.get_score(i) for i in range(n)])
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
        ids = {name: i for i, name in enumerate(names) if plain[i]}
        for name in ids:
            if MARK in name.lstrip(MARK) or "\n" in name or " " in name or (name.startswith(MARK * 2) and name.strip(MARK)):
                raise ValueError(f"piece {name!r} crosses the bounds of units")
        bodies = [name.replace(MARK, " ").encode() if plain[i] else b"" for i, name in enumerate(names)]
        of_byte = np.full(256, -1, np.int32)
        for i in range(n):
            if model.is_byte(i):
                of_byte[int(names[i][3:5], 16)] = i
                bodies[i] = bytes([int(names[i][3:5], 16)])
        if (of_byte < 0).any():
            raise ValueError("the vocabulary has no pieces for single bytes")
        of_char = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                of_char[ord(name)] = i
        # The blank stands for the mark; a mark in the text is spelled in bytes.
        of_char[32], of_char[ord(MARK)] = of_char[ord(MARK)], -1
        order = np.empty(n, np.int64)
        order[np.argsort(-scores, kind="stable")] = np.arange(n)
        pairs = {}
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        keys, joined, probes = _addressed(pairs)
        sizes = np.array([len(b) for b in bodies], np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return cls(np.frombuffer(b"".join(bodies), np.uint8), begin, sizes, of_char, of_byte, keys, joined, order, probes)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of joined pieces, -1 where two pieces make none."""
        found = np.full(len(left), -1, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left[open_].astype(np.uint64) << np.uint64(32)) | right[open_].astype(np.uint64)
        slot = (tx.mix(key) & np.uint64(len(self.keys) - 1)).astype(np.int64)
        for _ in range(self.probes):
            held = self.keys[slot]
            same = held == key
            found[open_[same]] = self.joined[slot[same]]
            on = ~same & (held != 0)
            if not on.any():
                break
            open_, key, slot = open_[on], key[on], (slot[on] + 1) & (len(self.keys) - 1)
        return found


def _addressed(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
    size = 1 << (4 * len(pairs)).bit_length()
    keys, joined, longest = np.zeros(size, np.uint64), np.zeros(size, np.int32), 1
    given = np.array(sorted(pairs), np.uint64)
    for key, slot in zip(given.tolist(), (tx.mix(given) & np.uint64(size - 1)).tolist()):
        tried = 1
        while keys[slot]:
            slot, tried = (slot + 1) & (size - 1), tried + 1
        keys[slot], joined[slot], longest = key, pairs[key], max(longest, tried)
    return keys, joined, longest


def _place(left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A scattered number of the candidate that joins [left, middle) and [middle, right)."""
    return tx.mix((left.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ right.astype(np.uint64))


def _skipped(key: np.ndarray, left: np.ndarray, middle: np.ndarray, right: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether the candidate that joins [left, middle) and [middle, right) is skipped."""
    return tx.mix(key ^ _place(left, middle, right)) < limit


def merge_heap(symbols: list[int], key: int, pieces: Pieces, limit: np.uint64) -> list[tuple[int, int]]:
    """One unit by the agenda: (symbol, first character) of what is left."""
    n = len(symbols)
    ids, after, before, alive = list(symbols), [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
    agenda: list[tuple[int, int, int, int, int]] = []

    def offer(at: list[int]) -> None:
        at = [i for i in at if i >= 0 and after[i] < n]
        if not at:
            return
        right = [after[i] for i in at]
        made = pieces.pair(np.array([ids[i] for i in at]), np.array([ids[j] for j in right]))
        ends = [after[j] for j in right]
        keys = np.full(len(at), key, np.uint64)
        skip = _skipped(keys, np.array(at), np.array(right), np.array(ends), limit) if limit else np.zeros(len(at), bool)
        for i, j, end, new, out in zip(at, right, ends, made.tolist(), skip.tolist()):
            if new >= 0 and not out:
                heapq.heappush(agenda, (int(pieces.rank[new]), i, j, end, new))

    offer(list(range(n)))
    while agenda:
        _, i, j, end, new = heapq.heappop(agenda)
        if not alive[i] or after[i] != j or after[j] != end or not alive[j]:
            continue
        ids[i], after[i], alive[j] = new, end, False
        if end < n:
            before[end] = i
        offer([before[i], i])
    return [(ids[i], i) for i in range(n) if alive[i]]


def merge_all(symbols: np.ndarray, of: np.ndarray, key: np.ndarray, pieces: Pieces, limit: np.uint64) -> np.ndarray:
    """Merge many units side by side, in place; a symbol of -2 has become part of the one before.

    ``of`` bounds the units in ``symbols``. In each step every unit makes its best merge.
    """
    total = len(symbols)
    unit = np.repeat(np.arange(len(of) - 1), np.diff(of))
    after = np.arange(1, total + 1)
    before = np.arange(-1, total - 1)
    end = of[1:]
    joined = np.full(total + 1, -1, np.int32)
    value = np.full(total + 1, NONE, np.int64)

    def offer(at: np.ndarray) -> None:
        right = after[at]
        inside = right < end[unit[at]]
        value[at[~inside]] = NONE
        at, right = at[inside], right[inside]
        made = pieces.pair(symbols[at], symbols[right])
        good = made >= 0
        value[at[~good]] = NONE
        at, right, made = at[good], right[good], made[good]
        if limit:
            own = unit[at]
            first = of[own]
            skip = _skipped(key[own], at - first, right - first, after[right] - first, limit)
            value[at[skip]] = NONE
            at, made = at[~skip], made[~skip]
        joined[at] = made
        value[at] = (pieces.rank[made] << 32) | at

    offer(np.arange(total))
    active = np.flatnonzero(np.diff(of) > 1)
    while len(active):
        # Positions of the units still at work, walked as one array.
        lengths = end[active] - of[active]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.arange(bounds[-1]) + np.repeat(of[active] - bounds[:-1], lengths)
        held = value[flat]
        for _ in range(4):
            best = np.minimum.reduceat(held, bounds[:-1])
            some = best < NONE
            if not some.any():
                break
            at = (best[some] & 0xFFFFFFFF).astype(np.int64)
            gone = after[at]
            symbols[at] = joined[at]
            symbols[gone] = -2
            value[gone] = NONE
            after[at] = after[gone]
            follows = after[at]
            inner = follows < end[unit[at]]
            before[follows[inner]] = at[inner]
            previous = before[at]
            touched = np.concatenate([at, previous[previous >= of[unit[at]]]])
            offer(touched)
            held = value[flat]
        active = active[np.minimum.reduceat(held, bounds[:-1]) < NONE]
    return symbols


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and where each begins."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(start, len(data)))
    lead = data[start].astype(np.int64)
    point = np.where(size == 1, lead, np.where(size == 2, lead & 0x1F, np.where(size == 3, lead & 0x0F, lead & 0x07)))
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        point[more] = (point[more] << 6) | (data[start[more] + k] & 0x3F)
    return point, start


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of many runs laid end to end."""
    bounds = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(begin - bounds, size)


def encode_chunk(chunk: tx.Chunk, keys: np.ndarray, pieces: Pieces, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts of a chunk, and the bounds of each text in them.

    Every occurrence of a unit skips by a key of its own and is merged by itself; all of a
    chunk go side by side. Only without skipping are equal units merged once.
    """
    rows = len(chunk.offsets) - 1
    filled = np.diff(chunk.offsets) > 0
    data = np.insert(chunk.data, chunk.offsets[:-1][filled], 32)
    of = chunk.offsets + np.concatenate([[0], np.cumsum(filled)])
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
    blank, line = data == 32, data == 10
    cut = np.zeros(len(data) + 1, bool)
    cut[of] = True
    cut = cut[:-1]
    cut |= line
    cut[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))
    first_unit = np.searchsorted(start, of)
    hashes = tx.hash_spans(data, start, end)
    limit = np.uint64(min(int(rate * 2.0**64), tx.MASK))
    if limit:
        doc = np.repeat(np.arange(rows), np.diff(first_unit))
        turn = (np.arange(len(start)) - first_unit[doc]).astype(np.uint64)
        key = tx.mix(hashes ^ tx.mix(tx.mix(keys[doc] + tx.mix(turn + tx.seeded(seed))) + tx.seeded(seed + 1)))
        where, body = np.arange(len(start)), data
    else:
        key, where, final = np.unique(hashes, return_index=True, return_inverse=True)
        body = data[_ragged(start[where], end[where] - start[where])]
    size = end[where] - start[where]
    point, at = _code_points(body)
    bounds = np.searchsorted(at, np.concatenate([[0], np.cumsum(size)]))
    symbols = pieces.of_char[point]
    short = np.diff(bounds) <= LONG
    if short.all():
        symbols = merge_all(symbols, bounds, key, pieces, limit)
    else:
        chosen = np.flatnonzero(short)
        inside = _ragged(bounds[:-1][chosen], np.diff(bounds)[chosen])
        small = np.concatenate([[0], np.cumsum(np.diff(bounds)[chosen])])
        symbols[inside] = merge_all(symbols[inside], small, key[chosen], pieces, limit)
        for unit in np.flatnonzero(~short).tolist():
            a, b = bounds[unit], bounds[unit + 1]
            left = merge_heap(symbols[a:b].tolist(), int(key[unit]), pieces, limit)
            symbols[a:b] = -2
            for symbol, place in left:
                symbols[a + place] = symbol
    # Characters without a piece are spelled in bytes.
    width = np.diff(np.append(at, len(body)))
    takes = np.where(symbols == -2, 0, np.where(symbols == -1, width, 1))
    out = np.repeat(symbols, takes)
    spelled = np.flatnonzero(symbols == -1)
    places = _ragged((np.cumsum(takes) - takes)[spelled], takes[spelled])
    out[places] = pieces.of_byte[body[_ragged(at[spelled], width[spelled])]]
    sums = np.concatenate([[0], np.cumsum(takes)])
    if limit:  # units are in their places
        return out.astype(np.int32), sums[bounds][first_unit]
    unit_begin, unit_size = sums[bounds[:-1]], np.diff(sums[bounds])
    ids = out[_ragged(unit_begin[final], unit_size[final])]
    ends = np.concatenate([[0], np.cumsum(unit_size[final])])
    return ids.astype(np.int32), ends[first_unit]


def decode_ids(ids: np.ndarray, of: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the bounds of each; the blank in front is taken off."""
    size = pieces.size[ids]
    body = pieces.body[_ragged(pieces.begin[ids], size)]
    bounds = np.concatenate([[0], np.cumsum(size)])[of]
    filled = np.diff(bounds) > 0
    body = np.delete(body, bounds[:-1][filled])
    return body, bounds - np.concatenate([[0], np.cumsum(filled)])


def _text(ids: np.ndarray, of: np.ndarray, missing: pa.Array, pieces: Pieces) -> pa.Array:
    """Decoded texts of lists of ids; missing ones are null."""
    body, bounds = decode_ids(ids, of, pieces)
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(body)]
    text = pa.Array.from_buffers(pa.large_string(), len(of) - 1, buffers).cast(pa.string())
    return pa.compute.if_else(missing, pa.scalar(None, pa.string()), text)


def encode(
    docs: DataFrame,
    keep: list[str],
    path: str = MODEL,
    rate: float = RATE,
    seed: int = SEED,
    decoded: bool = False,
) -> DataFrame:
    """The columns ``keep`` and ``_pieces``, the piece ids of ``text``.

    With ``decoded`` also ``_decoded``, the text that these ids give back, made in the same
    pass so that ids need not travel to be decoded.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(path))
    source = docs.select(*keep, F.col("text").alias("_piece_text"), F.xxhash64(F.col("doc_id")).alias("_piece_key"))
    fields = [*docs.select(*keep).schema.fields, T.StructField("_pieces", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*fields, *([T.StructField("_decoded", T.StringType())] if decoded else [])])
    width = len(keep)

    def run(batches):
        pieces = shared.value
        for batch in batches:
            keys = batch.column(width + 1).to_numpy(zero_copy_only=False).view(np.uint64)
            column = batch.column(width)
            for chunk in tx.chunks(column, ENCODED):
                ids, of = encode_chunk(chunk, keys[chunk.first : chunk.last], pieces, rate, seed)
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                missing = part.column(width).is_null()
                made = [pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(ids, pa.int32()), mask=missing)]
                if decoded:
                    made.append(_text(ids, of, missing, pieces))
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *made], names=schema.names)

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, keep: list[str], path: str = MODEL) -> DataFrame:
    """The columns ``keep`` and ``_decoded``, the text of ``_pieces``."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces.load(path))
    source = encoded.select(*keep, F.col("_pieces").alias("_piece_ids"))
    schema = T.StructType([*encoded.select(*keep).schema.fields, T.StructField("_decoded", T.StringType())])
    width = len(keep)

    def run(batches):
        pieces = shared.value
        for batch in batches:
            sizes = batch.column(width).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            reach, first = np.cumsum(sizes), 0
            while first < len(sizes):
                # Whole rows of about DECODED ids at a time.
                done = reach[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(reach, done + DECODED, "right")))
                part = batch.slice(first, last - first)
                lists = part.column(width)
                of = np.concatenate([[0], reach[first:last] - done])
                text = _text(lists.flatten().to_numpy(zero_copy_only=False), of, lists.is_null(), pieces)
                yield pa.RecordBatch.from_arrays([*part.columns[:width], text], names=schema.names)
                first = last

    return source.mapInArrow(run, schema)
