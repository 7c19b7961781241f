"""The ten operators against brute force, exact round trips and held-out labels."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditlens.llm import decontaminate, line_dedup, masked_lm, near_dedup, pieces, pii, quality_classifier, quality_rules, toxicity, warc
from creditlens.llm import text as tx
from creditlens.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SPACE = re.compile(r"[^\x20\t-\r]+")

ODD_TEXTS = [
    None,
    "",
    " \n\t\n",
    "one",
    "one two three",
    "word " * 30_000,
    "x" * 200_000,
    "1" * 50_000,
    "\n" * 5_000,
    "é😀ñ ▁ mark " * 5,
    "same line\nsame line\nother",
    "same line\nsame line\nother",
    *["a b c d e f g h i j k l m n o p q r s t u v w x y z"] * 3,
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeats, and columns named like the operators' results."""
    rows = [(i if i != 3 else None, t, None if i % 4 == 0 else "en", "s", i, "clash", 1.0, True) for i, t in enumerate(ODD_TEXTS)]
    rows.append(rows[-1])
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score double, kept boolean"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def odd_labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (None, 1, 1), (4, None, None), (99, 0, 1), (5, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


# Words


def test_words_and_hashes():
    column = pa.array(["a bc\n a", None, "", "bc", "é ñ"]).slice(0)
    (chunk,) = tx.chunks(column)
    words = tx.find_words(chunk, tx.table(tx.SPACES))
    assert np.diff(words.of).tolist() == [3, 0, 0, 1, 2]
    h = tx.hash_spans(chunk.data, words.start, words.end)
    assert h[0] == h[2] and h[1] == h[3] and len(set(h.tolist())) == 4
    assert [c.last - c.first for c in tx.chunks(pa.array(["ab"] * 5), 4)] == [2, 2, 1]


# 1 Quality classifier


def test_quality_on_held_out_labels(spark):
    rows = QUERIES["op1_quality_classifier"](spark, MIDDLE)
    assert rows.count() == rows.select("doc_id").distinct().count() == 1000
    known = rows.join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in known]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in known)


def test_prior_and_risk():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, (4000, 2)), rng.normal(-2, 1, (4000, 2))
    unlabelled = np.concatenate([good[:2100], bad[:900]])
    model = quality_classifier.train(good[2100:], unlabelled)
    assert abs(model.prior - 0.7) < 0.07
    assert (model.scores(good[:500]) > 0.5).mean() > 0.95 and (model.scores(bad[:500]) < 0.5).mean() > 0.95
    first, bracket = quality_classifier.risk_parts(np.array([1.0]), np.array([-1.0]), 0.5)
    assert first == pytest.approx(0.5 * math.log1p(math.exp(-1))) and bracket == pytest.approx(math.log1p(math.exp(-1)) - 0.5 * math.log1p(math.e))


def test_quality_edges(spark, odd, none, odd_labels):
    for docs in (odd, none):
        scored, _ = quality_classifier.classify(docs, odd_labels, F.lit(True))
        assert scored.count() == docs.count() and scored.where("score IS NULL OR NOT score BETWEEN 0 AND 1").isEmpty()


# 2 Near-dedup


def brute_classes(texts, least=0.8):
    sets = {}
    for key, value in texts.items():
        w = SPACE.findall(value or "")
        sets[key] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x == y or (x and y and len(x & y) >= least * len(x | y)):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {k: find(k) for k in keys}


def test_near_duplicates_against_all_pairs(spark, documents):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op2_minhash_near_dedup"](spark, SMALL).collect()}
    assert got == brute_classes(documents)


def test_near_duplicates_in_a_chained_group(spark):
    """Edited copies whose ends are unlike, many of them, so that leaders do not settle it."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(8)):
            own[rng.randrange(120)] = f"e{rng.randrange(30)}"
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    classes, links = near_dedup.near_duplicates(docs)
    assert {r["doc_id"]: r["class"] for r in classes.collect()} == brute_classes(texts)
    assert links.where("similarity < 0.8").isEmpty()
    kept = {r["doc_id"] for r in near_dedup.drop_near_duplicates(docs).collect()}
    assert kept == set(brute_classes(texts).values())


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    elements = tx.mix(np.arange(400, dtype=np.uint64))
    a, b = rng.integers(0, 9, 400).astype(float), rng.integers(0, 9, 400).astype(float)
    b[:300] = a[:300]
    parts = [(elements[w > 0], w[w > 0]) for w in (a, b)]
    of = np.concatenate([[0], np.cumsum([len(e) for e, _ in parts])])
    s = near_dedup.signatures(np.concatenate([e for e, _ in parts]), np.concatenate([w for _, w in parts]), of, 2048)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - truth) < 0.04


def test_near_duplicate_edges(spark, odd, none):
    classes, _ = near_dedup.near_duplicates(odd)
    rows = {r["doc_id"]: r["class"] for r in classes.collect()}
    assert None not in rows and len(rows) == len(ODD_TEXTS) - 1
    assert rows[0] == rows[1] == rows[2] == 0 and rows[10] == rows[11] == 10 and rows[12] == rows[13] == rows[14] == 12
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == 1
    assert kept.where("doc_id = 12").count() == 1 and kept.where("doc_id IN (13, 14, 11, 1)").isEmpty()
    assert near_dedup.drop_near_duplicates(none).isEmpty()


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)], "a long, b long")
    got = {r["doc_id"]: r["class"] for r in near_dedup.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_components_of_chains_in_random_order(spark):
    """Small stars may leave a node two parents, which is not the end yet."""
    rng = random.Random(8)
    tables = [[(1, 2), (2, 3), (3, 5), (5, 0)]]
    for length in range(4, 13, 2):
        chain = rng.sample(range(100), length)
        tables.append(list(zip(chain, chain[1:])))
    mixed = []
    for k in range(200):
        chain = [1000 * (k + 1) + i for i in rng.sample(range(1000), rng.randrange(4, 13))]
        mixed += zip(chain, chain[1:])
    for links in [*tables, mixed]:
        least = {x: x for pair in links for x in pair}
        for _ in least:
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        rows = near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert len(rows) == len(least) and {r["doc_id"]: r["class"] for r in rows} == least


# 3 Quality rules


def test_lower_tail_is_exact():
    for k, n, p in ((0, 50, 0.01), (3, 400, 0.02), (1, 1000, 0.004)):
        exact = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
        assert quality_rules.lower_tail(k, n, p) == pytest.approx(float(exact), rel=1e-9)
    assert quality_rules.lower_tail(5, 10, 0.1) == 1.0


def test_cutoffs_need_enough_labels(spark):
    rows = [(i, "en", "fine words here that are not repeated at all in this text number " * 1 + " ".join(f"t{i}x{j}" for j in range(20))) for i in range(3000)]
    rows += [(5000 + i, "en", " ".join(f"#w{i}x{j}&" for j in range(40))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(3000)], "doc_id long, quality int")
    verdict = {r["doc_id"]: r["_kept"] for r in quality_rules.judge(docs, labels).collect()}
    assert all(verdict[i] for i in range(3000)) and not any(verdict[5000 + i] for i in range(20))
    few = {r["doc_id"]: r["_kept"] for r in quality_rules.judge(docs, labels.limit(50)).collect()}
    assert all(few.values())


def test_rule_edges(spark, odd, none, odd_labels):
    judged = {r["n_chars"]: r for r in quality_rules.judge(odd.drop("doc_id").withColumn("doc_id", F.col("n_chars")), odd_labels).withColumn("n_chars", F.col("doc_id")).collect()}
    counts = {i: judged[i][quality_rules.STATS] for i in judged}
    assert counts[0]["n_words"] == counts[1]["n_words"] == counts[2]["n_words"] == 0 and not judged[0]["_kept"]
    assert counts[5]["n_repeat_words"] == counts[5]["n_words"] == 30_000 and judged[5]["_base_failed"]
    assert counts[10]["n_dup_lines"] == 1 and judged[12]["_kept"]
    assert quality_rules.keep_good(odd, odd_labels).columns == odd.columns
    assert quality_rules.keep_good(none, odd_labels).isEmpty()


# 4 Personal data

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(value):
    found = []
    for number, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, value or "", re.A):
            digits = re.sub("[^0-9]", "", m.group())
            odd_sum = sum(int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9) for i, c in enumerate(reversed(digits)))
            sure = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and odd_sum % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if sure:
                found.append((m.start(), number, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def test_personal_data_against_plain_patterns(spark, documents):
    for row in QUERIES["op4_pii"](spark, SMALL).collect():
        assert row["base_sha256"] == hashlib.sha256(plain_spans(documents[row["doc_id"]]).encode()).hexdigest()


def test_odd_personal_data(spark, odd, none):
    texts = [
        "a@b.com_foo@d.org x@y.z%q@r.st @c.d a@b",
        "é😀 a@b.co 4111 1111 1111 1111 +1 (650) 555-4393 1.2.3.4.5.6.7.8 000.0255.1.0 256.1.1.1",
        "a.b@c.d " * 700,
        "1.1.1.1" * 9,
        "4111-1111-1111-1112 4111--1111 +12 34",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_spans(docs, ["doc_id"]).select("doc_id", pii.as_text(F.col("_spans")).alias("spans")).collect():
        assert row["spans"] == plain_spans(texts[row["doc_id"]])
    more = [
        (0, "my iban is GB82 WEST 1234 5698 7654 32 ok"),
        (1, "GB82WEST12345698765433"),
        (2, "ssn 123-45-6789 and call me: 650-555-1234"),
        (3, "order 123-45-6789 part 650-555-1234"),
    ]
    found = pii.find_spans(spark.createDataFrame(more, "doc_id long, text string"), ["doc_id"])
    spans = {r["doc_id"]: r["spans"] for r in found.select("doc_id", pii.as_text(F.col("_spans")).alias("spans")).collect()}
    assert spans == {0: "iban:11:38", 1: "", 2: "ssn:4:15,local_phone:29:41", 3: ""}
    assert pii.find_spans(odd, odd.columns).count() == odd.count() and pii.find_spans(none, ["doc_id"]).isEmpty()


def test_numbers_in_lists(spark):
    """One cue holds for all numbers of its list, before or behind it, however long."""
    many = ", ".join(f"650-555-{1000 + i}" for i in range(300))
    texts = {
        0: ("phone: 650-555-1234, 650-555-9876", {"local_phone": 2}),
        1: ("SSN: 123-45-6789; 234-56-7890 and 345-67-8901", {"ssn": 3}),
        2: (f"phone: {many}", {"local_phone": 300}),
        3: (f"{many} (mobile)", {"local_phone": 300}),
        4: ("call 650-555-1234 (home), 650-555-9876 (work), 650-555-4321 (boat)", {"local_phone": 3}),
        5: ("650-555-9876 is the part of the order that was sent out in spring, so call 650-555-1234", {"local_phone": 1}),
        6: ("123-45-6789, 234-56-7890", {}),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    rows = pii.find_spans(docs, ["doc_id", "text"]).collect()
    for row in rows:
        kinds = [s["kind"] for s in row["_spans"] if s["kind"] in ("ssn", "local_phone")]
        assert {k: kinds.count(k) for k in kinds} == texts[row["doc_id"]][1], row["doc_id"]


# 5 Decontamination


def plain_hits(doc, items, k):
    covered, names = set(), set()
    for name, words in items:
        size = min(k, len(words))
        windows = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()
        for i in range(len(doc) - size + 1):
            if tuple(doc[i : i + size]) in windows:
                covered.update(range(i, i + size))
                names.add(name)
    return covered, names


def test_automaton_against_all_windows():
    rng = random.Random(3)
    for turn in range(300):
        letters = "ab" if turn % 2 else "abcd"
        items = [(i, [rng.choice(letters).encode() for _ in range(rng.randrange(0, 9))]) for i in range(4)]
        doc = [rng.choice(letters).encode() for _ in range(40)]
        hits, names, _ = decontaminate.SuffixAutomaton.build(items, 3).walk(doc)
        covered, expected = plain_hits(doc, items, 3)
        assert {p for a, b in hits for p in range(a, b)} == covered and names == expected


def test_leaks_with_short_items_and_shards(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.choice([0, 1, 2, 5, 14])))) for i in range(12)] + [(3, None), (None, "a b c")]
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for i in range(30)] + [(40, None), (41, "")]
    docs += [(50, "Intro: " + items[4][1].upper().replace(" ", ", ") + "! end")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    plain = [(i, decontaminate.words_of(t)) for i, t in items if i is not None]
    for shard in (100_000, 15):
        for row in decontaminate.find_leaks(left, right, ["doc_id"], 4, shard_words=shard).collect():
            words = decontaminate.words_of(dict(docs)[row["doc_id"]])
            covered, names = plain_hits(words, plain, 4)
            info = row[decontaminate.INFO]
            assert (info["n_words"], info["n_hit"], set(info["items"])) == (len(words), len(covered), names)
            assert {p for s in info["spans"] for p in range(s["first"], s["end"])} == covered


def test_cleaning(spark, odd, none):
    item = "the quick brown fox jumps over the lazy dog again today"
    rest = " ".join(f"w{i}" for i in range(30))
    half = item.split()
    nested = " ".join(half[:5]) + " " + item + " " + " ".join(half[5:])
    docs = spark.createDataFrame([(0, f"{rest}. {item.title()}! {rest}"), (1, item), (2, rest), (3, f"{rest} {nested}")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    cleaned = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert cleaned == {0: f"{rest}. ! {rest}", 2: rest, 3: f"{rest} "}
    assert decontaminate.decontaminate(odd, items).collect() == odd.collect()
    assert decontaminate.decontaminate(none, items).isEmpty()
    assert decontaminate.decontaminate(odd, items.limit(0)).count() == odd.count()


def test_cleaning_is_the_same_for_every_number_of_automata(spark):
    rng = random.Random(9)
    # Cutting one item joins another; items overlap; ids are texts.
    items = [("q2", "a b c d"), ("q10", "p q r s"), ("q1", "c d e f"), ("q3", None), (None, "x y z u"), ("q2", "a b c d")]
    items += [(f"r{i}", " ".join(rng.choice("abcdefpqrs") for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    docs = [(0, "one a b p q r s c d two"), (1, "a b c d e f"), (2, "x y z u"), (3, None), (4, ""), (0, "a b p q r s c d")]
    docs += [(i, " ".join(rng.choice("abcdefpqrstuvwxyz") for _ in range(80))) for i in range(5, 60)]
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id string, text string")
    plain = [(i, decontaminate.words_of(t)) for i, t in items if i is not None]
    several = {}
    for shard in (10**6, 40):
        several[shard] = sorted(decontaminate.decontaminate(left, right, 4, 2.0, shard).collect(), key=str)
        assert all(not plain_hits(decontaminate.words_of(r["text"]), plain, 4)[0] for r in several[shard])
    assert several[10**6] == several[40] and len(several[40]) == len(docs)
    # Some fifty automata.
    assert decontaminate.Automata(right, 4, 4).count >= 40
    for row in decontaminate.find_leaks(left, right, ["doc_id", "text"], 4, shard_words=4).collect():
        covered, names = plain_hits(decontaminate.words_of(row["text"]), plain, 4)
        assert row[decontaminate.INFO]["n_hit"] == len(covered) and row[decontaminate.INFO]["items"] == sorted(names)


# 6 Pieces


def test_pieces_equal_the_library_without_dropout():
    import sentencepiece

    table, library = pieces.Pieces.load(), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [t or "" for t in ODD_TEXTS if "▁" not in (t or "")] + ["  two  blanks ", "a\n\nb\tc", "日本語 ﬁ \x00", "Übergrößen " * 9]
    for chunk in tx.chunks(pa.array(texts)):
        ids, of = pieces.encode_chunk(chunk, np.zeros(chunk.last - chunk.first, np.uint64), table, 0.0, 1)
        for i in range(chunk.first, chunk.last):
            assert ids[of[i - chunk.first] : of[i - chunk.first + 1]].tolist() == library.encode(texts[i])


def test_dropout_is_keyed_and_lossless(spark, odd, none, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    plain, once, again, other = (
        {r["doc_id"]: r["_pieces"] for r in pieces.encode(docs, ["doc_id"], rate=rate, seed=seed).collect()}
        for rate, seed in ((0.0, 1), (0.2, 1), (0.2, 1), (0.2, 2))
    )
    assert once == again and once != other and sum(map(len, once.values())) > sum(map(len, plain.values()))
    for frame in (docs, odd, none):
        decoded = pieces.decode(pieces.encode(frame, ["text"], rate=0.3), ["text"])
        assert decoded.where("NOT _decoded <=> text").isEmpty() and decoded.count() == frame.count()
        assert pieces.encode(frame, ["text"], decoded=True).where("NOT _decoded <=> text").isEmpty()
    # The agenda and the side-by-side merging skip and merge alike.
    table = pieces.Pieces.load()
    (chunk,) = tx.chunks(pa.array(list(dict(docs.limit(20).collect()).values())), 1 << 30)
    keys = np.arange(20, dtype=np.uint64)
    side = pieces.encode_chunk(chunk, keys, table, 0.3, 1)
    monkeypatch.setattr(pieces, "LONG", 0)
    heap = pieces.encode_chunk(chunk, keys, table, 0.3, 1)
    assert np.array_equal(side[0], heap[0]) and np.array_equal(side[1], heap[1])


def test_pieces_of_one_word_vary(spark):
    docs = spark.createDataFrame([(0, "unbelievable " * 200)], "doc_id long, text string")
    ids = pieces.encode(docs, ["doc_id"], rate=0.3).first()["_pieces"]
    words = [w for w in " ".join(map(str, ids)).split("1 ") if w]
    assert len(set(words)) > 1


def test_every_occurrence_skips_for_itself(monkeypatch):
    """A frequent word is split in many ways, and sharing plain units changes no piece."""
    table = pieces.Pieces.load()
    texts = ["unbelievable " * 4000, "the cat and the unbelievable dog, née Übergröße. " * 50, "x" * 60 + " internationalization " * 9]
    (chunk,) = tx.chunks(pa.array(texts), 1 << 30)
    keys = np.arange(3, dtype=np.uint64)
    ids, of = pieces.encode_chunk(chunk, keys, table, 0.1, 1)
    plain = table.of_char[32]
    begins = np.flatnonzero(np.array([table.body[table.begin[i]] == 32 for i in ids[: of[1]].tolist()]))
    ways = {tuple(x.tolist()) for x in np.split(ids[: of[1]], begins) if len(x) and x[0] != plain}
    assert len(ways) > 8
    monkeypatch.setattr(pieces, "LONG", 0)
    alone = pieces.encode_chunk(chunk, keys, table, 0.1, 1)
    assert np.array_equal(ids, alone[0]) and np.array_equal(of, alone[1])


# 7 Line dedup


def plain_lines(texts, least):
    keys = [[line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)}) for line in (t or "").split("\n")] for t in texts]
    count = {}
    for own in keys:
        for k in set(own):
            count[k] = count.get(k, 0) + 1
    return [
        "\n".join(line for line, k in zip((t or "").split("\n"), own) if not k or count[k] < least) for t, own in zip(texts, keys)
    ]


@pytest.mark.parametrize("batches,fan", [(1, 2), (5, 2), (7, 3)])
def test_lines_against_plain_counts(spark, batches, fan):
    rng = random.Random(batches)
    lines = ["Common", " common\t", "COMMON", "rare", "", "  ", "É", "é", "x" * 50, "third line"]
    texts = [None if i == 7 else "\n".join(rng.choice(lines) for _ in range(rng.randrange(6))) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, batches=batches, fan=fan).collect()}
    for i, expected in enumerate(plain_lines(texts, 10)):
        assert (got[i]["text"] or "") == expected
        assert got[i]["_lines"]["kept_sha256"] == hashlib.sha256(expected.encode()).hexdigest()
    assert got[7]["text"] is None


def test_line_edges(odd, none):
    kept = line_dedup.dedup_lines(odd, least_documents=2)
    assert kept.columns == [*odd.columns, "_lines"] and kept.count() == odd.count()
    assert {r["text"] for r in kept.where("doc_id IN (10, 11)").collect()} == {""}
    assert line_dedup.dedup_lines(none).isEmpty()


# 8 Toxicity


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op8_toxicity"](spark, folder)
    known = rows.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").select("predicted", "toxic", "score").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in known)
    assert hits / sum(r["toxic"] for r in known) > 0.7 and hits / sum(r["predicted"] for r in known) > 0.7
    assert all(0 <= r["score"] <= 1 for r in known)


def test_convolution_gradient():
    """The network learns a two-word pattern that no single word tells."""
    rng = np.random.default_rng(2)
    slots, labels = [], []
    for i in range(400):
        words = rng.integers(10, 200, (1, 12)).astype(np.int32)
        words[0, rng.integers(0, 5)], words[0, rng.integers(6, 11)] = 1, 2
        if i % 2:
            at = rng.integers(0, 10)
            words[0, at : at + 2] = (1, 2)
        full = np.full((toxicity.TABLES, 12 + toxicity.PAD), toxicity.NO_WORD, np.int32)
        full[0, :12] = words
        slots.append(full)
        labels.append(i % 2)
    net = toxicity.train(slots, np.array(labels, np.float32), epochs=25)
    z = np.array([net.logits(s, np.array([0, s.shape[1]]))[0] for s in slots])
    assert ((z > 0) == np.array(labels, bool)).mean() > 0.9


def test_toxicity_edges(odd, none, odd_labels):
    for docs in (odd, none):
        net = toxicity.fit(docs, odd_labels, F.lit(True))
        scored = toxicity.score(docs, net)
        assert scored.count() == docs.count() and scored.where("score IS NULL OR NOT score BETWEEN 0 AND 1").isEmpty()


# 9 Language model


def test_probabilities_sum_to_one_and_match_plain():
    known = np.sort(tx.mix(np.arange(50, dtype=np.uint64)))
    model = masked_lm.Window.start(known, np.arange(50, 0, -1), 5)
    around = np.array([[0], [3], [masked_lm.OUTSIDE], [7]])
    every = np.arange(masked_lm.VOCABULARY)
    logs = model.log_probabilities(np.repeat(around, len(every), axis=1), every)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-3)


def test_training_helps_and_every_word_counts(spark, odd, none):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    start = masked_lm.first_model(docs)
    trained = masked_lm.train_round(docs, start, 0)

    def mean(model):
        row = masked_lm.score(docs, model).agg(F.sum("pseudo_log_likelihood"), F.sum("n_words")).first()
        return row[0] / row[1]

    assert mean(trained) > mean(start) + 0.05
    counted = masked_lm.word_counts(docs).agg(F.sum("n")).first()[0]
    assert counted == masked_lm.score(docs, start).agg(F.sum("n_words")).first()[0]
    for frame in (odd, none):
        rows = masked_lm.score(frame, masked_lm.train(frame, 1)).collect()
        assert len(rows) == frame.count()
        assert all((r["n_words"] > 0) == (r["mean_log_probability"] is not None) and r["pseudo_log_likelihood"] <= 0 for r in rows)


def test_every_word_has_a_probability_of_its_own(spark, monkeypatch):
    """Words without an id score by their own counts, once-seen ones by their bytes, and ids follow the corpus."""
    monkeypatch.setattr(masked_lm, "VOCABULARY", 4)
    monkeypatch.setattr(masked_lm, "GROWTH", 0.01)
    common = "one two three " * 50
    texts = [common + "rare " * 6, common + "seldom " * 2, "rare", "seldom", "seldon", "qqqxqq", None, "seldon", "seldon"]
    ids = [*range(7), 4, 4]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    model = masked_lm.first_model(docs)
    got = {r["doc_id"]: r["pseudo_log_likelihood"] for r in masked_lm.score(docs, model).collect()}
    others = model.others
    assert (others, model.once) == (7 + 3 + 3 + 1, 1) and got[2] > got[3] > got[5]
    assert got[2] - got[3] == pytest.approx(math.log(7 / 3), abs=1e-5)
    assert got[3] == pytest.approx(got[4], abs=1e-5) and got[6] == 0
    word = np.frombuffer(b"qqqxqq", np.uint8)
    spelled = masked_lm.spell(model, word, np.array([0]), np.array([6]))[0]
    assert got[5] - got[2] == pytest.approx(spelled + math.log(1 / others) - math.log(7 / others), abs=1e-4)
    monkeypatch.setattr(masked_lm, "GROWTH", 0.35)
    grown = masked_lm.first_model(docs)
    assert len(grown.known) == 6 and grown.classes == 3 and model.classes == 2
    assert np.exp(model.spelling.reshape(257, 257)).sum(axis=1) == pytest.approx(1)


def test_counting_words_holds_little():
    """Memory of a counting task follows a chunk of text, not all that is counted together."""
    texts = [" ".join(f"w{(i * 7919 + j) % 5000}" for j in range(40_000)) for i in range(80)]
    column, expected = pa.array(texts), Counter(" ".join(texts).split())
    saved, tx._POWERS[:] = list(tx._POWERS), [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    tracemalloc.start()
    try:
        found = list(masked_lm.counted_words(iter([pa.RecordBatch.from_arrays([column], names=["text"])])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        tx._POWERS[:] = saved
    assert sum(sum(b["n"].to_pylist()) for b in found) == sum(expected.values())
    assert len({w for b in found for w in b["word"].to_pylist()}) == len(expected)
    assert sum(len(s) for s in texts) > 16 << 20 and len(found) <= 3 and peak < 200 << 20


def test_a_step_equals_classes_one_by_one():
    known = tx.mix(np.arange(60, dtype=np.uint64))
    model = masked_lm.Window.start(known, np.arange(60, 0, -1), 9)
    rng = np.random.default_rng(1)
    words, around = rng.integers(0, 300, 500), rng.integers(-1, 300, (4, 500))
    before = {k: v.copy() for k, v in model.parts.items()}
    h = model.hidden(around)
    masked_lm.Descent(model).step(around, words)
    for c in range(model.classes):
        rows = np.flatnonzero(words // model.classes == c)
        q = np.exp(h[rows] @ before["word"][c].T + before["word_bias"][c])
        q /= q.sum(axis=1, keepdims=True)
        q[np.arange(len(rows)), words[rows] % model.classes] -= 1
        for name, gradient in (("word", q.T @ h[rows] / 500), ("word_bias", q.sum(axis=0) / 500)):
            scale = masked_lm.RATE / np.sqrt(1e-7 + (gradient**2).mean(axis=-1, keepdims=True))
            assert np.allclose(model.parts[name][c], before[name][c] - scale * gradient, atol=1e-5)


def test_training_reads_texts_once_for_counts_and_once_a_round(spark, monkeypatch):
    """Spelling is learned within the first round, and is what a pass of its own finds."""
    texts = [" ".join(f"w{i * j % 7919}" for j in range(1, 400)) + f" once{i}" for i in range(40)] + [None, "", "é " * 9]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3, "doc_id")
    monkeypatch.setattr(masked_lm, "VOCABULARY", 40)
    monkeypatch.setattr(masked_lm, "GROWTH", 0.1)
    expected = masked_lm.first_model(docs)

    def again(*_):
        raise AssertionError("a pass over all texts for the spelling alone")

    monkeypatch.setattr(masked_lm, "spelling", again)
    trained = masked_lm.train(docs, 1)
    assert np.array_equal(trained.spelling, expected.spelling)
    apart = masked_lm.train_round(docs, expected, 0)
    assert all(np.allclose(trained.parts[k], apart.parts[k], atol=1e-6) for k in apart.parts)
    assert not np.allclose(trained.parts["context"], expected.parts["context"], atol=1e-3)
    empty = masked_lm.train(docs.where("doc_id < 0"), 2)
    assert np.exp(empty.spelling.reshape(257, 257)).sum(axis=1) == pytest.approx(1)


def test_known_words_are_found():
    rng = np.random.default_rng(2)
    close = np.arange(300, dtype=np.uint64)
    for known in (np.unique(rng.integers(0, 2**64, 5000, np.uint64)), close, ~close, close[:1], close[:0]):
        model = masked_lm.Window.start(known, np.ones(len(known)), 3)
        asked = np.concatenate([known, known + np.uint64(1), ~known, rng.integers(0, 2**64, 1000, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        ids = dict(zip(known.tolist(), range(len(known))))
        assert model.word_ids(asked).tolist() == [ids.get(x, model.other) for x in asked.tolist()]


def test_large_products_neither_overflow_nor_vanish():
    model = masked_lm.Window.start(tx.mix(np.arange(60, dtype=np.uint64)), np.arange(60, 0, -1), 9)
    rng = np.random.default_rng(3)
    words, around = rng.integers(0, 300, 5000), rng.integers(-1, 300, (4, 5000))
    for add in (0, 200, -200):
        model.parts["class_bias"][::2] += np.float32(add)
        model.parts["word_bias"] += np.float32(add)
        h, expected = model.hidden(around).astype(np.float64), np.zeros(len(words))
        group, inner = words // model.classes, words % model.classes
        for z, at in (
            (h @ model.parts["class"].T + model.parts["class_bias"], group),
            (np.einsum("nk,njk->nj", h, model.parts["word"][group]) + model.parts["word_bias"][group], inner),
        ):
            z = z - z.max(axis=1, keepdims=True)
            expected += z[np.arange(len(z)), at] - np.log(np.exp(z).sum(axis=1))
        assert np.allclose(model.log_probabilities(around, words), expected, atol=2e-4)
    masked_lm.Descent(model).step(around, words)
    assert all(np.isfinite(v).all() for v in model.parts.values())


def test_words_found_in_pieces_equal_those_found_at_once(monkeypatch):
    texts = ["Ab cd", None, "", " x" * 900, "one", "é ü", "y" * 5000, " ", "Tail end"]
    chunk = next(tx.chunks(pa.array(texts, pa.string())))
    inside = tx.table(masked_lm.SEPARATORS)
    whole = masked_lm._spelled_words(chunk, inside)
    monkeypatch.setattr(masked_lm, "PIECE", 7)
    cut = masked_lm._spelled_words(chunk, inside)
    plain = tx.find_words(tx.Chunk(0, 9, masked_lm.LOWERED[chunk.data], chunk.offsets), inside)
    for found in (whole, cut):
        assert np.array_equal(found[0], tx.hash_spans(found[2], plain.start, plain.end))
        assert all(np.array_equal(getattr(found[1], k), getattr(plain, k)) for k in ("start", "end", "of"))


# 10 Archives


def test_loser_tree_merges():
    rng = random.Random(6)
    for k in range(8):
        runs = []
        for r in range(k):
            rows = [{"url_key": rng.choice("ab"), "captured": str(rng.randrange(5)), "page_id": rng.choice([None, 1, 2]), "archive": str(r), "place": i} for i in range(rng.randrange(6))]
            runs.append(sorted(rows, key=warc._order))
        merged = [warc._order(row) for row in warc.LoserTree(runs)]
        assert merged == sorted(warc._order(row) for run in runs for row in run)


def test_url_keys():
    assert warc.url_key("HTTP://u:p@WWW.Example.com:80/a?b#c") == "com,example)/a?b"
    assert warc.url_key("https://a.b") == "b,a)/" and warc.url_key("plain") == "plain"


def test_archive_edges(spark, monkeypatch):
    big = "WARC/1.1\r\n\r\nContent-Length: 5\r\n" + "ü" * 800
    rows = [(1, "http://a.b/x\r\ny", big), (2, None, big), (2, None, big), (None, "http://a.b/", big), (3, "http://a.b/", None), (4, "http://a.b/", ""), (5, "http://a.b/", "s"), (6, "http://a.b/", "s"), (None, None, None)]
    rows += [(100 + i, "http://hot.host/", f"<p>{i}") for i in range(50)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    monkeypatch.setattr(warc, "MERGE_ROWS", 7)  # the hot key runs over many parts
    got = warc.archive_pages(pages).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["page_id"], []).append(r)
    assert by_id[1][0]["record_type"] == "revisit" and by_id[1][0]["refers_to"] == 2
    assert [r["record_type"] for r in by_id[2]] == ["response", "response"]
    assert sorted(r["payload_bytes"] for r in by_id[None]) == [0, len(big.encode())]
    assert all(r["record_type"] == "response" for i in (3, 4, 5, 6) for r in by_id[i])
    assert all(r["payload_digest"] == hashlib.sha1(big.encode()).hexdigest() for r in by_id[1] + by_id[2])
    assert [by_id[100 + i][0]["capture_no"] for i in range(50)] == list(range(1, 51))
    assert warc.archive_pages(pages.limit(0)).isEmpty()
