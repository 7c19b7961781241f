"""Vector codes: a codebook per part of the vectors, by k-means over anchors-hierarchy trees.

Components become integers, floor of 4096 times the value, and vectors are cut into
consecutive parts. A part's codebook starts as that part of the first kept vectors; every
round assigns all parts to their nearest entry (ties to the lower index) and moves each
entry to the componentwise floor of its parts' mean.

Rows are stored in blocks of at most ``BLOCK`` vectors. A block keeps one metric tree per
part, built middle-out: about the root of n anchors share n points, each new anchor at the point
furthest from its owner, taking over only where half the distance between anchors allows;
anchors are then merged pairwise, smallest ball first, up to one root, and each is divided in
the same way down to small leaves. A ball caches the sum and count of its points. A round
walks the trees from the root with a list of candidate entries; a ball inherits
its parent's list and drops each entry that the nearest one beats on all of the ball.
A ball with a single candidate is wholly owned: its cached sums count and nothing beneath
is visited. Leaves compare their points with the candidates left, in whole numbers.
Pruning leaves a margin for rounding, so results equal plain k-means exactly.

Trees are built and stored once; a round reads them and returns one sum per task and
entry component. Nothing grows in the driver: it holds the codebooks.

Defined results: rows with a null or empty vector, a null or non-finite component, or a length
other than that of the first kept vector are dropped; components beyond +-16384 count as that (the integers
then stay in range); a null id comes after all others; rows that repeat an id are rows of
their own, ordered by vector; fewer rows than entries make a smaller codebook; a length that
does not divide leaves parts whose lengths differ by one; no rows give no result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.session import staged

SCALE = 4096
MOST = 1 << 26
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 4096
LEAF = 64

TREE = T.StructType([T.StructField(name, T.BinaryType()) for name in ("order", "links", "pivots", "radii", "sums")])


class Tree:
    """Balls over the rows of one part; children -1 for a leaf, points by ``order[start:end]``."""

    def __init__(self, order, links, pivots, radii, sums):
        self.order, self.links, self.pivots, self.radii, self.sums = order, links, pivots, radii, sums

    def packed(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(value).tobytes() for name, value in vars(self).items()}

    @classmethod
    def unpacked(cls, stored: dict[str, bytes], width: int) -> Tree:
        kinds = {"order": np.int32, "links": np.int32, "pivots": np.float64, "radii": np.float64, "sums": np.int64}
        arrays = {name: np.frombuffer(stored[name], kind) for name, kind in kinds.items()}
        balls = len(arrays["radii"])
        arrays["links"] = arrays["links"].reshape(balls, 4)
        arrays["pivots"], arrays["sums"] = arrays["pivots"].reshape(balls, width), arrays["sums"].reshape(balls, width)
        return cls(**arrays)


def anchors(points: np.ndarray, most: int) -> np.ndarray:
    """The owner of each point among at most ``most`` anchors."""
    owner = np.zeros(len(points), np.int64)
    distance = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    pivots = [0]
    while len(pivots) < most:
        new = int(distance.argmax())
        if distance[new] == 0:
            break
        gaps = np.sqrt(((points[pivots] - points[new]) ** 2).sum(axis=1))
        # A point nearer to its owner than half the gap cannot be nearer to the new anchor.
        open_ = np.flatnonzero(distance >= gaps[owner] / 2)
        own = np.sqrt(((points[open_] - points[new]) ** 2).sum(axis=1))
        won = own < distance[open_]
        owner[open_[won]], distance[open_[won]] = len(pivots), own[won]
        pivots.append(new)
    return owner


class _Builder:
    def __init__(self, points: np.ndarray):
        self.whole = points
        self.points = points.astype(np.float64)
        self.balls: list[tuple] = []  # members, left, right, pivot, radius, sum

    def ball(self, members: np.ndarray, left: int = -1, right: int = -1) -> int:
        total = self.whole[members].sum(axis=0)
        pivot = total / len(members)
        radius = float(np.sqrt(((self.points[members] - pivot) ** 2).sum(axis=1)).max())
        self.balls.append((members, left, right, pivot, radius, total))
        return len(self.balls) - 1

    def divide(self, members: np.ndarray) -> int:
        own = self.points[members]
        if len(members) <= LEAF or (own == own[0]).all():
            return self.ball(members)
        owner = anchors(own, int(np.ceil(np.sqrt(len(members)))))
        return self.merge([self.divide(members[owner == k]) for k in range(owner.max() + 1)])

    def merge(self, roots: list[int]) -> int:
        """Join the two balls whose common ball is smallest until one is left."""
        n = len(roots)
        pivots = np.array([self.balls[b][3] for b in roots])
        radii = np.array([self.balls[b][4] for b in roots])

        def common(k):
            gap = np.sqrt(((pivots - pivots[k]) ** 2).sum(axis=1))
            return np.maximum((gap + radii + radii[k]) / 2, np.maximum(radii, radii[k]))

        size = np.array([common(k) for k in range(n)])
        size[np.tril_indices(n)] = np.inf
        for _ in range(n - 1):
            a, b = divmod(int(size.argmin()), n)
            left, right = roots[a], roots[b]
            roots[a] = self.ball(np.concatenate([self.balls[left][0], self.balls[right][0]]), left, right)
            pivots[a], radii[a] = self.balls[roots[a]][3:5]
            size[b, :] = size[:, b] = np.inf
            fresh, live = common(a), np.isfinite(size)
            size[a] = np.where(live[a], fresh, np.inf)
            size[:, a] = np.where(live[:, a], fresh, np.inf)
        return roots[0]

    def tree(self) -> Tree:
        root = self.divide(np.arange(len(self.points)))
        links, place, order, at = np.empty((len(self.balls), 4), np.int32), {}, [], 0
        kept, stack = [], [root]
        while stack:  # parents first; a ball's points lie together
            b = stack.pop()
            place[b] = len(kept)
            kept.append(b)
            members, left, right = self.balls[b][:3]
            if left < 0:
                order.append(members)
            else:
                stack += [right, left]
        for b in kept:
            members, left, right = self.balls[b][:3]
            start = at
            if left < 0:
                at += len(members)
            links[place[b]] = (start, start + len(members), place.get(left, -1), place.get(right, -1))
        return Tree(
            np.concatenate(order).astype(np.int32),
            links,
            np.array([self.balls[b][3] for b in kept]),
            np.array([self.balls[b][4] for b in kept]),
            np.array([self.balls[b][5] for b in kept], np.int64),
        )


def build(points: np.ndarray) -> Tree:
    return _Builder(points.astype(np.int64)).tree()


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def assign(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sums and counts by entry, the entry of each point, and how many balls were wholly owned.

    The tree is walked level by level, all balls of a level at once; a ball's candidates are a row of flags.
    """
    k = len(book)
    entries = book.astype(np.float64)
    gaps = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(axis=2))
    sums, counts, codes, owned = np.zeros(book.shape, np.int64), np.zeros(k, np.int64), np.zeros(len(points), np.int64), 0
    # An entry equal to an earlier one never wins.
    equal = (book[:, None] == book[None]).all(axis=2)
    balls, candidates = np.zeros(1, np.int64), ~np.tril(equal, -1).any(axis=1)[None]
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(balls):
        start, end, left, right = tree.links[balls].T
        away = ((tree.pivots[balls][:, None] - entries[None]) ** 2).sum(axis=2)
        best = np.where(candidates, away, np.inf).argmin(axis=1)
        least = away[np.arange(len(balls)), best][:, None]
        # A ball reaches as far as its radius beyond the plane between two entries.
        reach = 2 * tree.radii[balls][:, None] * gaps[best]
        candidates = candidates & (away - least <= reach * (1 + 1e-9) + 1e-9 * away + 1e-3)
        whole = candidates.sum(axis=1) == 1
        entry, lengths = best[whole], (end - start)[whole].astype(np.int64)
        np.add.at(sums, entry, tree.sums[balls[whole]])
        np.add.at(counts, entry, lengths)
        codes[tree.order[_ranges(start[whole].astype(np.int64), lengths)]] = np.repeat(entry, lengths)
        owned += int(whole.sum())
        leaf = ~whole & (left < 0)
        leaves.append((balls[leaf], candidates[leaf]))
        inner = ~whole & (left >= 0)
        balls = np.concatenate([left[inner], right[inner]]).astype(np.int64)
        candidates = np.concatenate([candidates[inner]] * 2)
    balls, candidates = np.concatenate([x for x, _ in leaves]), np.concatenate([x for _, x in leaves])
    start, lengths = tree.links[balls, 0].astype(np.int64), (tree.links[balls, 1] - tree.links[balls, 0]).astype(np.int64)
    rows = tree.order[_ranges(start, lengths)]
    own = points[rows].astype(np.int64)
    away = np.stack([((own - row) ** 2).sum(axis=1) for row in book.astype(np.int64)], axis=1)
    chosen = np.where(np.repeat(candidates, lengths, axis=0), away, np.iinfo(np.int64).max).argmin(axis=1)
    codes[rows] = chosen
    np.add.at(sums, chosen, own)
    counts += np.bincount(chosen, minlength=k)
    return sums, counts, codes, owned


def _bounds(width: int) -> list[int]:
    return [i * width // PARTS for i in range(PARTS + 1)]


def whole_numbers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, label and the components as integers, of rows whose components are all finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def whole(x):
        return F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int")

    kept = vectors.where(F.size(vector) > 0).where(~odd)
    return kept.select(F.col(key).alias("key"), F.col(label).alias("label"), F.transform(vector, whole).alias("values"))


def in_blocks(rows: DataFrame, width: int) -> DataFrame:
    """Blocks of rows, each with its points and a tree per part."""
    schema = T.StructType(
        [
            T.StructField("keys", T.ArrayType(rows.schema["key"].dataType)),
            T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
            T.StructField("points", T.BinaryType()),
            T.StructField("trees", T.ArrayType(TREE)),
        ]
    )
    bounds, most = _bounds(width), BLOCK

    def run(batches):
        held, count, kinds = [], 0, None

        def block(batch: pa.RecordBatch) -> pa.RecordBatch:
            points = batch.column(2).flatten().to_numpy().reshape(len(batch), width)
            trees = [build(points[:, a:b]).packed() for a, b in zip(bounds, bounds[1:])]
            whole = pa.array([0, len(batch)], pa.int32())
            tree = pa.struct([(name, pa.binary()) for name in TREE.names])
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(whole, batch.column(0)),
                    pa.ListArray.from_arrays(whole, batch.column(1)),
                    pa.array([np.ascontiguousarray(points, np.int32).tobytes()], pa.binary()),
                    pa.array([trees], pa.list_(tree)),
                ],
                names=schema.names,
            )

        def joined():
            return pa.Table.from_batches(held, kinds).combine_chunks().to_batches()[0]

        for batch in batches:
            kinds = batch.schema
            while len(batch):
                held.append(batch.slice(0, most - count))
                count += len(held[-1])
                batch = batch.slice(len(held[-1]))
                if count == most:
                    yield block(joined())
                    held, count = [], 0
        if count:
            yield block(joined())

    return staged(rows.mapInArrow(run, schema), "blocks")


def _parts(batch: pa.RecordBatch, width: int):
    """Row of a batch of blocks, part, points and tree of each of its trees."""
    bounds = _bounds(width)
    points, trees = batch.column("points"), batch.column("trees")
    for i in range(len(batch)):
        own, stored = np.frombuffer(points[i].as_py(), np.int32).reshape(-1, width), trees[i].as_py()
        for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
            yield i, part, own[:, a:b], Tree.unpacked(stored[part], b - a)


def refined(blocks: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round."""

    def run(batches):
        sums, counts = [np.zeros_like(book) for book in books], [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            for _, part, points, tree in _parts(batch, width):
                own_sums, own_counts, _, _ = assign(tree, points, books[part])
                sums[part] += own_sums
                counts[part] += own_counts
        rows = [
            (part, entry, place, int(sums[part][entry, place]), int(counts[part][entry]))
            for part, book in enumerate(books)
            for entry in np.flatnonzero(counts[part]).tolist()
            for place in range(book.shape[1])
        ]
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "total", "n"])

    found = blocks.select("points", "trees").mapInArrow(run, "part long, entry long, place long, total long, n long")
    # Decimal, since sums over all rows may leave the range of long.
    totals = found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))
    moved = [book.copy() for book in books]
    for row in totals.collect():  # one row per component of the codebooks
        moved[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return moved


def train(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, list[np.ndarray], int]:
    """Blocks, the codebooks after all rounds, and the vectors' length."""
    rows = whole_numbers(vectors, key, vector, label)
    order = [F.asc_nulls_last("key"), "values"]
    lead = rows.orderBy(*order).limit(1).collect()
    width = len(lead[0]["values"]) if lead else 0
    rows = rows.where(F.size("values") == width)
    first = rows.orderBy(*order).limit(ENTRIES).select("values").collect()
    start = np.array([r["values"] for r in first], np.int64).reshape(len(first), width)
    bounds = _bounds(width)
    books = [start[:, a:b].copy() for a, b in zip(bounds, bounds[1:])]
    blocks = in_blocks(rows, width)
    for _ in range(ROUNDS if lead else 0):
        books = refined(blocks, books, width)
    return blocks, books, width


def encode(blocks: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """key, label, codes (an entry per part) and error, the squared distance, of every row."""
    key, label = blocks.schema["keys"].dataType.elementType, blocks.schema["labels"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("key", key),
            T.StructField("label", label),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
            T.StructField("error", T.LongType()),
        ]
    )

    def run(batches):
        for batch in batches:
            codes, errors = {}, {}
            for i, part, points, tree in _parts(batch, width):
                _, _, own, _ = assign(tree, points, books[part])
                codes.setdefault(i, []).append(own)
                errors[i] = errors.get(i, 0) + ((points - books[part][own]) ** 2).sum(axis=1)
            for i in sorted(codes):
                matrix = np.stack(codes[i], axis=1).astype(np.int32)
                ends = pa.array(np.arange(len(matrix) + 1) * PARTS, pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(matrix.ravel()))
                given = [batch.column(c).slice(i, 1).flatten() for c in ("keys", "labels")]
                yield pa.RecordBatch.from_arrays([*given, lists, pa.array(errors[i], pa.int64())], names=schema.names)

    return blocks.mapInArrow(run, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the sum of errors over all rows of the same label; nulls are one label."""
    coded = staged(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components, by part, entry and place, as decimal text."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()
