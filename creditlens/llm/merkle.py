"""Merkle manifest of a dataset by time-forward processing: roots, and a proof for every row.

A row's leaf is the SHA-256 of its fields. Leaves of a group ascend by key and are hashed
eight by eight, level upon level, to the group's subroot; the subroots, by group, likewise
to the root. A proof lists, level by level, what stands left and right of the path.

A node's label is the last leaf beneath it, then its level, so children come before their
parent. Nodes are swept in the order of labels and send their digest to the parent by a
priority queue. The queue is external: labels are cut into intervals of ``BLOCK`` leaves. A
message inside its interval waits in a heap (at most eight a level); one that leaves it is
a row of a stored table, which Spark deals to the recipient's interval and sorts by label
for the next sweep. Intervals of one layer are swept side by side, and every layer has 512
times fewer nodes. The way back sweeps the labels in reverse: a node takes the proof suffix
sent to its label and sends each child its own, down to the leaves.

No task holds more than an interval, whatever the size of a group: positions come from
one sort by range and the sizes of its parts.

Defined results: a null field is ``-``; a null group is a group of its own and the first;
a null key comes first in its group; rows that repeat a key follow their leaf digests, and
rows alike in all fields are interchangeable, each a leaf. A table without rows has no
result. Other columns are not part of a leaf.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.session import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
#: Levels of an interval, and the leaves beneath them.
SPAN = 3
BLOCK = ARITY**SPAN
ROWS = 2048

STEP = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
PROOF = T.ArrayType(STEP)


def leaf_digest(values: dict[str, Column]) -> Column:
    """SHA-256 of fields one after another, each as byte count, colon and value, or ``-``."""
    parts = []
    for value in values.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def depth(n: int) -> int:
    """Levels above ``n`` nodes until one remains, those of an interval at most."""
    level = 0
    while n > 1 and level < SPAN:
        n, level = -(-n // ARITY), level + 1
    return level


def last_leaf(level: int, position: int, n: int) -> int:
    return min((position + 1) * ARITY**level, n) - 1


UP = T.StructType(
    [
        T.StructField("tree", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("time", T.LongType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("position", T.LongType()),
        T.StructField("children", T.ArrayType(T.StringType())),
        T.StructField("digest", T.StringType()),
        T.StructField("leaves", T.BooleanType()),
    ]
)


def _sweep_up(batches):
    """Inner nodes of the intervals, in the order of their labels; ``leaves`` marks an interval's root."""
    arrow = pa.schema(
        [("tree", pa.int64()), ("n", pa.int64()), ("time", pa.int64()), ("level", pa.int32()), ("position", pa.int64())]
        + [("children", pa.list_(pa.string())), ("digest", pa.string()), ("leaves", pa.bool_())]
    )
    queue: list[tuple] = []
    rows: list[tuple] = []

    def written():
        columns = list(zip(*rows)) if rows else [[]] * len(arrow)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
        rows.clear()
        return batch

    for batch in batches:
        for tree, n, now, digest in zip(*[c.to_pylist() for c in batch.columns]):
            top = depth(n)
            if top == 0:
                rows.append((tree, n, now, 0, now, [], digest, True))
            else:
                heappush(queue, (last_leaf(1, now // ARITY, n), 1, now, digest))
            while queue and queue[0][0] == now:
                level, place, children = queue[0][1], queue[0][2], []
                while queue and queue[0][:2] == (now, level):
                    children.append(heappop(queue)[3])
                place //= ARITY
                digest = hashlib.sha256("".join(children).encode()).hexdigest()
                rows.append((tree, n, now, level, place, children, digest, level == top))
                if level < top:
                    heappush(queue, (last_leaf(level + 1, place // ARITY, n), level + 1, place, digest))
            if len(rows) >= ROWS:
                yield written()
    if queue:
        raise ValueError("an interval ended before its nodes")
    yield written()


def _sweep_down(batches):
    """Proofs of the leaves of the intervals; rows come in the reverse order of labels, a message first."""
    queue: list[tuple] = []  # (-time, -level, proof as (left, right, rest), subroot)
    for batch in batches:
        get = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names) if name != "row"}
        taken, proofs, subroots = [], [], []
        for i, (time, level) in enumerate(zip(get["time"], get["level"])):
            if get["proof"][i] is not None:
                rest = None
                for step in reversed(get["proof"][i]):
                    rest = (step["left"], step["right"], rest)
                heappush(queue, (-time, -level, i, rest, get["subroot"][i]))
                continue
            if not queue or queue[0][:2] != (-time, -level):
                raise ValueError("a node got no message")
            _, _, _, rest, subroot = heappop(queue)
            if level == 0:
                taken.append(i)
                proofs.append(rest)
                subroots.append(subroot)
                continue
            children, n, first = get["children"][i], get["n"][i], get["position"][i] * ARITY
            for k in range(len(children)):
                step = ("".join(children[:k]), "".join(children[k + 1 :]), rest)
                heappush(queue, (-last_leaf(level - 1, first + k, n), 1 - level, 0, step, subroot))
        left, right, ends = [], [], [0]
        for rest in proofs:
            while rest is not None:
                left.append(rest[0])
                right.append(rest[1])
                rest = rest[2]
            ends.append(len(left))
        steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
        at = pa.array(taken, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.names.index(name)).take(at) for name in ("tree", "position", "row")]
            + [pa.array(subroots, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)],
            names=["tree", "position", "row", "subroot", "proof"],
        )
    if queue:
        raise ValueError("a message found no node")


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add the place of every row in the order over all rows, counted from 0.

    One sort by range. Only the sizes of its parts, one row per task, are summed in one place.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = staged(dealt.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    # The number of a row is its part, then 33 bits for its place in there.
    ordered = ordered.withColumn("_part", F.shiftright("_id", 33)).withColumn("_id", F.col("_id").bitwiseAND((1 << 33) - 1))
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    running = F.expr("sum(_size) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    starts = sizes.select("_part", F.coalesce(running, F.lit(0)).alias("_start"))
    # One row per task of the sort, so this side may be broadcast.
    joined = ordered.join(F.broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_id") + F.col("_start")).drop("_id", "_part", "_start")


def _interval(position: str) -> Column:
    return F.floor(F.col(position) / BLOCK).cast("long")


def _lift(nodes: DataFrame, most: int) -> list[tuple[DataFrame, DataFrame]]:
    """Layers of (nodes, inner nodes above them) until every tree of at most ``most`` nodes has its root.

    ``nodes`` has tree, n, position, digest and row; whatever is in row reaches the way back.
    """
    layers = []
    while True:
        dealt = nodes.select("tree", "n", "position", "digest").repartition("tree", _interval("position"))
        inner = staged(dealt.sortWithinPartitions("tree", "position").mapInArrow(_sweep_up, UP), "inner-nodes")
        layers.append((nodes, inner))
        if most <= BLOCK:
            return layers
        most = -(-most // BLOCK)
        nodes = inner.where("leaves").where(F.col("n") > BLOCK).select(
            "tree",
            F.ceil(F.col("n") / BLOCK).cast("long").alias("n"),
            _interval("time").alias("position"),
            "digest",
            F.struct(F.col("n").alias("n_below")).alias("row"),
        )


def _roots(layers: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """tree and digest of every tree's root."""
    found = [inner.where("leaves").where(F.col("n") <= BLOCK).select("tree", "digest") for _, inner in layers]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _lower(layers: list[tuple[DataFrame, DataFrame]], suffixes: DataFrame) -> DataFrame:
    """tree, position, row, subroot and proof of every node of the lowest layer.

    ``suffixes`` has tree, subroot and proof, the steps above each tree's root.
    """
    below = None
    for nodes, inner in reversed(layers):
        ended = inner.where("leaves").where(F.col("n") <= BLOCK).select("tree", "n", F.lit(0).cast("long").alias("interval"))
        sent = ended.join(suffixes, "tree")
        if below is not None:
            through = below.select("tree", F.col("row.n_below").alias("n"), F.col("position").alias("interval"), "subroot", "proof")
            sent = sent.unionByName(through)
        levels = F.when(F.col("n") <= 1, 0).when(F.col("n") <= ARITY, 1).when(F.col("n") <= ARITY**2, 2).otherwise(SPAN)
        messages = sent.select(
            "tree",
            "n",
            "interval",
            (F.least(F.col("n"), (F.col("interval") + 1) * BLOCK) - 1).alias("time"),
            levels.cast("int").alias("level"),
            "subroot",
            "proof",
        )
        inner_rows = inner.where("level > 0").select("tree", "n", _interval("time").alias("interval"), "time", "level", "position", "children")
        leaf_rows = nodes.select(
            "tree", "n", _interval("position").alias("interval"), F.col("position").alias("time"), F.lit(0).alias("level"), "position", "row"
        )
        rows = messages.unionByName(inner_rows, True).unionByName(leaf_rows, True)
        order = ["tree", "interval", F.desc("time"), F.desc("level"), F.desc_nulls_last("subroot")]
        schema = T.StructType(
            [rows.schema[c] for c in ("tree", "position", "row", "subroot")] + [T.StructField("proof", PROOF)]
        )
        below = rows.repartition("tree", "interval").sortWithinPartitions(*order).mapInArrow(_sweep_down, schema)
        if nodes is not layers[0][0]:
            below = staged(below, "suffixes")
    return below


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang", keep: dict[str, Column] = {}) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root, proof, and the columns of ``keep``.

    ``proof`` holds the steps from the leaf to the root, each with the digests left and
    right of the path; ``fold`` leads from a leaf along them.
    """
    leaves = staged(
        docs.select(
            F.col(group).alias("group"),
            F.col(key).alias("key"),
            leaf_digest({name: F.col(name) for name in fields}).alias("digest"),
            F.struct(F.lit(0).alias("_none"), *[value.alias(name) for name, value in keep.items()]).alias("kept"),
        ),
        "leaves",
    )
    # Rows alike are told apart by their place in the stored files, so that copies of a row spread.
    copies = leaves.withColumn("_copy", F.xxhash64("_metadata.file_name", "_metadata.row_index"))
    placed = numbered(copies, ["group", "key", "digest", "_copy"], "_place")
    sizes = placed.groupBy("group").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("n"))
    trees = numbered(sizes, ["group"], "tree").withColumnRenamed("group", "_group")
    joined = placed.join(trees, F.col("group").eqNullSafe(F.col("_group")))
    nodes = joined.select(
        "tree", "n", (F.col("_place") - F.col("_first")).alias("position"), "digest", F.struct("key", "digest", "kept").alias("row")
    )
    total = trees.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("trees")).first()
    layers = _lift(nodes, total["most"] or 0)
    subroots = _roots(layers)
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(total["trees"]).cast("long").alias("n"),
        F.col("tree").alias("position"),
        "digest",
        F.struct(F.lit(0).cast("long").alias("n_below"), "digest").alias("row"),
    )
    upper = _lift(tops, total["trees"])
    root = _roots(upper).first()
    start = F.array().cast(PROOF)
    above = subroots.sparkSession.range(1).select(F.col("id").alias("tree"), F.lit("").alias("subroot"), start.alias("proof"))
    suffixes = _lower(upper, above).select(F.col("position").alias("tree"), F.col("row.digest").alias("subroot"), "proof")
    proofs = _lower(layers, staged(suffixes, "suffixes"))
    return proofs.select(
        F.col("row.key").alias(key),
        F.col("row.digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        "proof",
        *[F.col("row.kept")[name].alias(name) for name in keep],
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_leaf(fields: tuple[str, ...] = FIELDS, key: str = "doc_id", text: str = "text") -> Column:
    """The leaf after a trial: rows whose key's crc32 divides by 3 have A-Z of the text in lower case.

    Null where the trial leaves the row as it was; a null key has no crc32 and stays.
    """
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0
    values = {name: F.translate(name, UPPER, LOWER) if name == text else F.col(name) for name in fields}
    return F.when(chosen & (F.col(text) != values[text]), leaf_digest(values))
