"""Near-duplicates by DartMinHash signatures, banded joining, and exact similarities.

A document is a weighted set; here the distinct runs of ``SHINGLE`` words, of weight 1
(``weighted=True`` takes how often each occurs). DartMinHash: every element owns a strip
as wide as its weight on a plane of unbounded height. Cells of the plane, fixed for all
documents, hold a Poisson number of darts at hashed places, so two documents see the
same darts where both have weight. A dart below a document's weight is taken; its height
is its rank and a hash names its coordinate. The lowest dart per coordinate, of
``COORDINATES``, is the signature; two documents agree on a coordinate with probability
equal to their (weighted) Jaccard similarity. Heights beyond what a document needs are
never looked at, so a signature costs about coordinates x log(coordinates) darts however
many elements there are. A document whose darts leave a coordinate empty looks higher.

``BANDS`` bands of ``ROWS`` coordinates propose pairs: a pair at 0.8 is missed with
probability under 5e-7. Proposed pairs are confirmed by the exact Jaccard similarity of
their shingle sets. Groups are the connected components of confirmed pairs.

Large groups are never paired out. Equal shingle sets are one class first. Of a bucket
each member is compared with one leader, then with the member that was most like the
leader. Members of a bucket that are still in different components after that are
compared in full, in blocks of bounded size that only emit links. So the components are
those that all pairs of all buckets would give.

Defined results: texts of one to four words are one shingle of all words; texts without
words (null, empty) form one class of equal sets; rows that repeat a doc_id count once,
by any one of their texts; a null doc_id takes no part.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm import text as tx
from creditlens.session import staged

SHINGLE = 5
LEAST_SIMILARITY = 0.8
BANDS = 48
ROWS = 6
COORDINATES = BANDS * ROWS
#: Documents in a block of the comparison in full.
BLOCK = 512
#: Height of the lowest cell; each further cell doubles the height reached.
LOWEST = 1 / 32
SETS_PER_BATCH = 256


def shingles(chunk: tx.Chunk, inside: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in order, their counts, and bounds by text."""
    words = tx.find_words(chunk, inside)
    hashes = tx.hash_spans(chunk.data, words.start, words.end)
    value, first = tx.windows(hashes, words.of, k)
    owner = words.text()[first] if len(first) else np.zeros(0, np.int64)
    counts = np.diff(words.of)
    for row in np.flatnonzero((counts > 0) & (counts < k)).tolist():
        whole = np.array([counts[row]], np.uint64)
        for h in hashes[words.of[row] : words.of[row + 1]]:
            whole = whole * np.uint64(tx.BASE) + h
        value, owner = np.append(value, tx.mix(whole)), np.append(owner, row)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(value)))
    value, owner = value[at], owner[at]
    return value, times, np.searchsorted(owner, np.arange(len(counts) + 1))


@functools.lru_cache(maxsize=256)
def _poisson(mean: float) -> np.ndarray:
    """Upper tail bounds of a Poisson variable on the scale of 2^53, for inversion."""
    values, term, total, i = [], math.exp(-mean), 0.0, 0
    while total < 1 - 1e-15 and i < 40 + 20 * mean:
        total += term
        values.append(total)
        i += 1
        term *= mean / i
    return np.array(values)


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def darts(element: np.ndarray, weight: np.ndarray, top: np.ndarray):
    """Darts under each element's weight and height ``top``: (element index, rank, dart hash)."""
    indices, ranks, names = [], [], []
    widest = float(weight.max()) if len(weight) else 0.0
    column = 0
    while True:
        left, width = (0.0, 1.0) if column == 0 else (2.0 ** (column - 1), 2.0 ** (column - 1))
        if left >= widest:
            break
        row = 0
        while True:
            low, height = (0.0, LOWEST) if row == 0 else (LOWEST * 2.0 ** (row - 1), LOWEST * 2.0 ** (row - 1))
            reach = np.flatnonzero((weight > left) & (top > low))
            if not len(reach):
                break
            cell = tx.mix(element[reach] ^ tx.seeded(1000 * column + row + 1))
            # Wide or high cells are cut into strips of mean at most 64.
            strips = max(1, math.ceil(width * height / 64))
            for strip in range(strips):
                own = tx.mix(cell + np.uint64(strip)) if strips > 1 else cell
                count = np.searchsorted(_poisson(width * height / strips), _uniform(tx.mix(own)), "right")
                have = np.flatnonzero(count)
                times = count[have]
                number = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                name = tx.mix(np.repeat(own[have], times) + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(tx.BASE))
                across = left + width * _uniform(tx.mix(name ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
                rank = low + height * (strip + _uniform(tx.mix(name ^ np.uint64(0x3C3C3C3C3C3C3C3C)))) / strips
                at = np.repeat(reach[have], times)
                taken = (across < weight[at]) & (rank < top[at])
                indices.append(at[taken])
                ranks.append(rank[taken])
                names.append(name[taken])
            row += 1
        column += 1
    if not indices:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)
    return np.concatenate(indices), np.concatenate(ranks), np.concatenate(names)


def signatures(element: np.ndarray, weight: np.ndarray, of: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Signatures of many weighted sets, one row each; a set without weight has zeros.

    A coordinate's value is its lowest dart's rank, 44 bits of it, which tells darts
    apart but for about once in 2^33.
    """
    n = len(of) - 1
    result = np.zeros((n, coordinates), np.uint64)
    running = np.concatenate([[0.0], np.cumsum(weight)])
    mass = running[of[1:]] - running[of[:-1]]
    open_ = np.flatnonzero(mass > 0)
    wanted = coordinates * (math.log(coordinates) + 4)
    while len(open_):
        sizes = (of[1:] - of[:-1])[open_]
        at = np.arange(int(sizes.sum())) + np.repeat(of[:-1][open_] - (np.cumsum(sizes) - sizes), sizes)
        owner = np.repeat(np.arange(len(open_)), sizes)
        top = (wanted / mass[open_])[owner]
        index, rank, name = darts(element[at], weight[at], top)
        place = owner[index].astype(np.uint64) * np.uint64(coordinates) + tx.mix(name + np.uint64(7)) % np.uint64(coordinates)
        packed = (place << np.uint64(44)) | (rank.view(np.uint64) >> np.uint64(20))
        packed.sort()
        place = packed >> np.uint64(44)
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        lowest = np.zeros(len(open_) * coordinates, np.uint64)
        lowest[place[first].astype(np.int64)] = packed[first] & np.uint64((1 << 44) - 1)
        lowest = lowest.reshape(len(open_), coordinates)
        full = (lowest > 0).all(axis=1)
        result[open_[full]] = lowest[full]
        open_, wanted = open_[~full], wanted * 2
    return result


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different bands kept apart."""
    key = np.zeros((len(signature), bands), np.uint64)
    parts = signature.reshape(len(signature), bands, rows)
    for r in range(rows):
        key = tx.mix(key * np.uint64(tx.BASE) + parts[:, :, r])
    return tx.mix(key + tx.mix(np.arange(1, bands + 1, dtype=np.uint64)))


def _sets(docs: DataFrame, weighted: bool, with_sets: bool, bands: int, rows: int) -> DataFrame:
    """By document the digest of its shingle set, and its band keys or the set itself."""
    source = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    schema = "doc_id long, digest binary, content array<long>"

    def run(batches):
        inside = tx.table(tx.SPACES)
        for batch in batches:
            for chunk in tx.chunks(batch.column(1)):
                value, times, of = shingles(chunk, inside)
                weight = times.astype(np.float64) if weighted else np.ones(len(value))
                for a in range(0, chunk.last - chunk.first, SETS_PER_BATCH):
                    b = min(a + SETS_PER_BATCH, chunk.last - chunk.first)
                    part, bounds = slice(of[a], of[b]), of[a : b + 1] - of[a]
                    own, mass = value[part], weight[part]
                    facts = (own, mass) if weighted else (own,)
                    digest = [
                        hashlib.blake2b(b"".join(x[bounds[i] : bounds[i + 1]].tobytes() for x in facts), digest_size=16).digest()
                        for i in range(b - a)
                    ]
                    if with_sets:
                        content, ends = own, bounds
                    else:
                        keys = band_keys(signatures(own, mass, bounds, bands * rows), bands, rows)
                        filled = np.diff(bounds) > 0
                        content = keys[filled].ravel()
                        ends = np.concatenate([[0], np.cumsum(filled * bands)])
                    ids = batch.column(0).slice(chunk.first + a, b - a)
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(content.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(digest, pa.binary()), lists], names=["doc_id", "digest", "content"])

    return source.mapInArrow(run, schema)


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their exact Jaccard similarity; each set travels once per pair side."""
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("content").alias("x")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("content").alias("y")), "b"
    )

    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            xs, ys = x.flatten().to_numpy(), y.flatten().to_numpy()
            sizes_x, sizes_y = x.value_lengths().to_numpy(), y.value_lengths().to_numpy()
            # Sort (pair, element) over both sides: an element that both have shows up twice.
            pair = np.concatenate([np.repeat(np.arange(len(x)), sizes_x), np.repeat(np.arange(len(y)), sizes_y)])
            value = np.concatenate([xs, ys])
            order = np.lexsort((value, pair))
            pair, value = pair[order], value[order]
            same = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
            shared = np.bincount(pair[1:][same], minlength=len(x))
            similarity = shared / np.maximum(sizes_x + sizes_y - shared, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similarity, pa.float64())], names=["a", "b", "similarity"])

    return staged(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, similarity double"), "similar-pairs")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, class) of every document in a link; the class is its component's least id.

    Alternates linking larger neighbours, then smaller ones, to the least neighbour, until
    all that is left are stars. Each step leaves at most as many links as there were, none is
    collected, and a star's centre only gets one row per neighbour.
    """
    current = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    while True:
        # Large star: the larger neighbours of each node point to the least of all neighbours and itself.
        mutual = current.union(current.select("b", "a"))
        least = mutual.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = mutual.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # Small star: a node and its smaller neighbours point to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(low, "a")
        small = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        following = staged(small.union(low.select("a", F.col("least").alias("b"))).distinct(), "links")
        # Stars are stable: every node, a centre being its own, has one centre only.
        centred = following.select(F.col("a").alias("node"), "b").union(following.select("b", "b"))
        if centred.groupBy("node").agg(F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high").isEmpty():
            break
        current = following
    heads = following.select(F.col("b").alias("doc_id")).distinct()
    return following.select(F.col("a").alias("doc_id"), F.col("b").alias("class")).union(heads.select("doc_id", F.col("doc_id").alias("class")))


def _with_class(frame: DataFrame, classes: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the class of a document, itself where it has no link yet."""
    found = classes.select(F.col("doc_id").alias(column), F.col("class").alias("_class"))
    return frame.join(found, column, "left").withColumn(name, F.coalesce("_class", column)).drop("_class")


def _pairs(frame: DataFrame, x: str, y: str) -> DataFrame:
    return frame.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a <> b").distinct()


def _blocks(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links between documents of one group and different classes, compared block by block.

    ``members`` has (group, doc_id, class, outside). Each block of outside documents meets
    each block of the group's documents; a block is about ``BLOCK`` documents, so a group
    of any size is spread over tasks of bounded size, and only links leave a task.
    """
    held = staged(members.join(sets, "doc_id"), "block-members")
    counts = held.groupBy("group").agg(
        F.greatest(F.ceil(F.count_if("outside") / BLOCK), F.lit(1)).cast("int").alias("n_out"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("n_all"),
    )
    # Only the group's counts travel; AQE splits a group that is large.
    sized = held.join(counts, "group")

    def dealt(rows: DataFrame, own: str, other: str, side: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("doc_id"), F.col(f"n_{own}")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)).alias(other)
        return rows.select("group", "doc_id", "class", "content", mine, every, F.lit(side).alias("asks")).select(
            "group", "out", "all", "asks", "doc_id", "class", "content"
        )

    both = dealt(sized.where("outside"), "out", "all", True).union(dealt(sized, "all", "out", False))

    def compare(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        content = table["content"].combine_chunks()
        sizes = content.value_lengths().to_numpy()
        ids, classes = table["doc_id"].to_numpy(), table["class"].to_numpy()
        vocabulary, code = np.unique(content.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(sizes)), sizes)
        # Only shingles that both sides have can be shared.
        mine = asks[row]
        common = np.bincount(code, mine, len(vocabulary)).astype(bool) & np.bincount(code, ~mine, len(vocabulary)).astype(bool)
        row, code = row[common[code]], (np.cumsum(common) - 1)[code[common[code]]]
        width = int(common.sum())
        x, y = np.flatnonzero(asks), np.flatnonzero(~asks)
        at = np.empty(len(sizes), np.int64)
        at[x], at[y] = np.arange(len(x)), np.arange(len(y))
        shared = np.zeros((len(x), len(y)), np.float32)
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        for low in range(0, width, 4096):
            part = slice(np.searchsorted(code, low), np.searchsorted(code, low + 4096))
            mine = asks[row[part]]
            left, right = np.zeros((len(x), 4096), np.float32), np.zeros((len(y), 4096), np.float32)
            left[at[row[part][mine]], code[part][mine] - low] = 1
            right[at[row[part][~mine]], code[part][~mine] - low] = 1
            shared += left @ right.T
        union = sizes[x][:, None] + sizes[y][None] - shared
        similarity = shared / np.maximum(union, 1)
        i, j = np.nonzero((similarity >= least - 1e-6) & (classes[x][:, None] != classes[y][None]))
        exact = shared[i, j].astype(np.float64) / np.maximum(union[i, j].astype(np.float64), 1)
        linked = exact >= least
        one, two = ids[x][i][linked], ids[y][j][linked]
        return pa.table({"a": np.minimum(one, two), "b": np.maximum(one, two), "similarity": exact[linked]})

    links = both.groupBy("group", "out", "all").applyInArrow(compare, "a long, b long, similarity double")
    return staged(links.distinct(), "block-links")


def near_links(buckets: DataFrame, sets: DataFrame, least: float = LEAST_SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Confirmed links (a, b, similarity) among documents of (key, doc_id) buckets, and their components.

    ``sets`` has (doc_id, content), the shingle sets of all documents in buckets.
    The links connect what all pairs of the buckets would connect.
    """
    # Every member with its bucket's first leader, the least by a hash.
    lead = buckets.groupBy("key").agg(F.min(F.struct(F.xxhash64("doc_id"), "doc_id")).alias("head"), F.count("*").alias("members"))
    first = staged(buckets.join(lead.select("key", F.col("head.doc_id").alias("leader"), "members"), "key"), "bucket-leaders")
    compared = _similar(staged(_pairs(first, "doc_id", "leader"), "pairs"), sets)
    classes = staged(components(compared.where(F.col("similarity") >= least)), "classes")

    # Then with the member that is most like that leader, where the bucket is not one class yet.
    # A bucket of two is done: its only pair has been compared.
    rest = _with_class(first.where("members > 2"), classes, "doc_id", "class")
    rest = rest.withColumns({"a": F.least("doc_id", "leader"), "b": F.greatest("doc_id", "leader")})
    rest = rest.join(compared, ["a", "b"], "left").select("key", "doc_id", "class", "leader", F.coalesce("similarity", F.lit(-1.0)).alias("near"))
    best = rest.groupBy("key").agg(
        F.max(F.struct("near", F.xxhash64("doc_id"), "doc_id")).alias("head"), F.min("class").alias("low"), F.max("class").alias("high")
    )
    best = best.where("low <> high").select("key", F.col("head.doc_id").alias("second"))
    second = staged(rest.join(best, "key"), "bucket-seconds")
    pairs = _pairs(second, "doc_id", "second").join(compared.select("a", "b"), ["a", "b"], "left_anti")
    compared = compared.unionByName(_similar(staged(pairs, "pairs"), sets))
    classes = staged(components(compared.where(F.col("similarity") >= least)), "classes")

    # What is still apart within a bucket, in blocks; groups are led by the second leader's class.
    apart = _with_class(_with_class(second.drop("class"), classes, "doc_id", "class"), classes, "second", "group")
    split = apart.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key")
    members = apart.join(split, "key", "left_semi").select("group", "doc_id", "class").distinct()
    blocks = _blocks(members.withColumn("outside", F.col("class") != F.col("group")), sets, least)
    links = staged(compared.where(F.col("similarity") >= least).unionByName(blocks).distinct(), "links")
    return links, staged(components(links), "classes")


def near_duplicates(
    docs: DataFrame, weighted: bool = False, least: float = LEAST_SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class, copies, links) of every document, and the links between different texts.

    ``class`` is the least doc_id of the group, ``copies`` counts documents with the same
    shingle set and ``links`` the confirmed links of that set in the returned links.
    """
    digested = staged(_sets(docs, weighted, False, bands, rows).dropDuplicates(["doc_id"]), "signatures")
    same = digested.groupBy("digest").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies"))
    # Signatures of one document per distinct set; a bucket needs two of them.
    heads = digested.join(same.select(F.col("head").alias("doc_id")), "doc_id", "left_semi")
    # Counting the keys and keeping the shared ones read one and the same exchange.
    banded = heads.select("doc_id", F.explode("content").alias("key")).repartition("key")
    shared_keys = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = staged(banded.join(shared_keys, "key", "left_semi"), "buckets")
    # Only documents in a bucket are read again, once, for their sets.
    known = docs.where("doc_id IS NOT NULL").join(buckets.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = staged(_sets(known, weighted, True, 1, 1).dropDuplicates(["doc_id"]).select("doc_id", "content"), "shingle-sets")
    links, classes = near_links(buckets, sets, least)
    degree = links.select(F.col("a").alias("head")).unionAll(links.select("b")).groupBy("head").agg(F.count("*").alias("links"))
    known = classes.select(F.col("doc_id").alias("head"), "class")
    described = same.join(known, "head", "left").join(degree, "head", "left")
    described = staged(
        described.select(
            "digest", F.coalesce("class", "head").alias("class"), "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links")
        ),
        "classes",
    )
    return digested.select("doc_id", "digest").join(described, "digest").select("doc_id", "class", "copies", "links"), links


def drop_near_duplicates(docs: DataFrame, weighted: bool = False, least: float = LEAST_SIMILARITY) -> DataFrame:
    """One document of each group, the one with the least doc_id, with all its columns.

    Of rows that repeat a doc_id one stays; rows without an id all stay.
    """
    classes, _ = near_duplicates(docs, weighted, least)
    gone = classes.where("doc_id <> class").select(F.col("doc_id").alias("_gone_id"))
    kept = docs.join(gone, F.col("doc_id") == F.col("_gone_id"), "left_anti")
    repeated = staged(docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_again_id")), "repeats")
    if repeated.isEmpty():
        return kept
    again = F.col("doc_id") == F.col("_again_id")
    once = kept.join(repeated, again, "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, again, "left_anti").unionByName(once)
