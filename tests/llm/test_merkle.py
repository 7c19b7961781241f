"""The Merkle manifest against plain hashing of lists, over several layers of intervals."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(digests):
    """The root, and for each digest its steps."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for own, place in enumerate(at):
            first = place // 8 * 8
            steps[own].append(("".join(level[first:place]), "".join(level[place + 1 : first + 8])))
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        at = [place // 8 for place in at]
    return level[0], steps


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, plain_leaf(row, row[1])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for group in order:
        groups[group].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = [plain_tree([leaf for _, leaf in groups[g]]) for g in order]
    root, tops = plain_tree([subroot for subroot, _ in trees])
    out = []
    for g, (subroot, steps), top in zip(order, trees, tops):
        for (row, leaf), own in zip(groups[g], steps):
            path = own + top
            text, key = row[1], row[0]
            if text is not None and key is not None and zlib.crc32(str(key).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = plain_leaf(row, text)
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((key, leaf, subroot, root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return Counter(out)


def found(frame):
    rows = merkle.manifest(frame, keep={"changed": merkle.tampered_leaf()})
    rows = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")), 256),
        merkle.fold(F.coalesce("changed", "leaf"), F.col("proof")).alias("folded"),
    ).withColumn("ok", F.col("folded") == F.col("root"))
    return Counter(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("sizes", [[1], [1, 8, 9], [600, 65, 64, 1, 2, 513, 7, 8, 512, 3], [5000, 1]])
def test_equals_plain_hashing(spark, sizes):
    rng = random.Random(len(sizes))
    rows, names = [], [None, "", "en", "é", "zz", "a", "b", "c", "d", "e"]
    for name, size in zip(names[-len(sizes) :] if len(sizes) < 10 else names, sizes):
        for _ in range(size):
            text = rng.choice([None, "", "Aa é😀", "no capitals", "X" * rng.randrange(50)])
            rows.append((rng.randrange(10**6) - 1000, text, name, rng.choice([None, "s"]), rng.choice([None, 5]), "clash", "clash"))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(frame) == plain_manifest(rows)


def test_repeats_nulls_and_long_texts(spark):
    rows = [(None, None, None, None, None, None, None)] * 3 + [(7, "Same", "en", "s", 4, "x", "y")] * 700
    rows += [(7, "Other", "en", "s", 4, "x", "y"), (8, "L" * 300_000, "en", None, None, "x", "y"), (None, "", "en", "s", 0, "x", "y")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)


def test_no_rows(spark):
    assert not found(spark.createDataFrame([], SCHEMA))


def test_a_changed_row_is_told(spark):
    rows = [(i, f"Text {i}", "en", "s", i, None, None) for i in range(100)]
    one = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).where("doc_id = 42").first()
    assert plain_fold(one["leaf"], one["proof"]) == one["root"]
    assert plain_fold(sha("other"), one["proof"]) != one["root"]


def plain_fold(leaf, proof):
    for step in proof:
        leaf = sha(step["left"] + leaf + step["right"])
    return leaf
