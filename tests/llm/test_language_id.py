"""Character models against plain counting, and languages of held-out texts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlens.llm import language_id as li
from creditlens.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def plain_units(text):
    out = []
    for c in text.lower():
        if c.isalpha():
            out.append(ord(c) if ord(c) < 65536 else 0xE000 + ord(c) % 6400)
        elif out and out[-1] != 32:
            out.append(32)
    return out


class Plain:
    """Interpolated Kneser-Ney by dictionaries."""

    def __init__(self, texts):
        counts = Counter()
        for t in texts:
            u = [32] * 3 + plain_units(t)
            counts.update(tuple(u[i - 3 : i + 1]) for i in range(3, len(u)))
        self.n = {4: counts}
        for k in (3, 2, 1):
            self.n[k] = Counter(g[1:] for g in self.n[k + 1])
        self.cut = {k: li.discount(sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())) for k, c in self.n.items()}
        self.total, self.kinds = defaultdict(int), defaultdict(int)
        for c in self.n.values():
            for g, v in c.items():
                self.total[len(g), g[:-1]] += v
                self.kinds[len(g), g[:-1]] += 1

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / 65536
        low, total = self.p(gram[1:]), self.total[k, gram[:-1]]
        if not total:
            return low
        cut = self.cut[k]
        return (max(self.n[k][gram] - cut, 0) + cut * self.kinds[k, gram[:-1]] * low) / total

    def bits(self, text):
        u = [32] * 3 + plain_units(text)
        grams = [tuple(u[i - 3 : i + 1]) for i in range(3, len(u))]
        return -sum(math.log2(self.p(g)) for g in grams) / len(grams) if grams else 0


TEXTS = {
    "en": ["The cat sat, on the mat.", "that  is THE hat 12", "a rat ate it", "the hat; the mat"],
    "xx": ["ñandú öl ÅΩ", "öl ñan\n\nöl", "Ωmega 𝒜𝒷 ok", "őőő"],
}


def fitted(spark, texts, **options):
    rows = [(t, lang) for lang, own in texts.items() for t in own]
    return li.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3), F.lit(True), **options)


def test_entropy_equals_plain_counting(spark):
    model = fitted(spark, TEXTS)
    assert model.langs == ["en", "xx"]
    asked = ["the cat", "ñ öl", "zzz", "a", "  the   mat!", "𝒜", "Then ΩÖ 5 hat", "x" * 5000]
    bits, lengths = model.entropies(asked)
    for i, text in enumerate(asked):
        assert lengths[i] == len(plain_units(text))
        for j, lang in enumerate(model.langs):
            assert bits[i, j] == pytest.approx(Plain(TEXTS[lang]).bits(text), rel=1e-5)


@pytest.mark.parametrize("most", [li.MODEL_GRAMS, 80])
def test_probabilities_sum_to_one(spark, most):
    model = fitted(spark, TEXTS, most=most)
    assert most > 80 or sum(map(len, model.grams)) <= 80
    for context in ("the", "   ", "zzz", " öl", "at "):
        a, b, c = (ord(x) for x in context)
        runs = np.arange(65536, dtype=np.uint64) | np.uint64((a << 48) | (b << 32) | (c << 16))
        for lang in range(2):
            assert model.probabilities(lang, runs).sum() == pytest.approx(1, abs=1e-4)


def test_languages_of_held_out_texts(spark):
    rows = QUERIES["op12_language_id"](spark, MIDDLE).collect()
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    assert len(rows) == len(truth) == 1000
    held = [r for r in rows if r["held_out"]]
    assert 250 < len(held) < 420
    lettered = [r for r in held if any(c.isalpha() for c in truth[r["doc_id"]][1] or "")]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in lettered]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["accepted"] for r in rows]) > 0.95


def test_limits_reject_noise(spark):
    rng = random.Random(1)
    words = {"aa": ["casa", "perro", "luna", "sol", "rio"], "bb": ["haus", "hund", "mond", "strasse", "fluss"]}
    rows = [(" ".join(rng.choices(w, k=40)), lang) for lang, w in words.items() for _ in range(400)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = li.fit(docs, F.lit(True))
    assert set(model.limits) == {"aa", "bb"}
    noise = ["".join(rng.choices("qxzjkvw", k=200)), "привет мир это текст", "casa luna sol " * 9, "Haus Mond Fluss " * 9]
    found = li.identify(spark.createDataFrame([(i, t) for i, t in enumerate(noise)], "doc_id long, text string"), model, ["doc_id"])
    rows = sorted(found.collect())
    assert [r["_accepted"] for r in rows] == [False, False, True, True]
    assert [r["_lang"] for r in rows[2:]] == ["aa", "bb"] and all(r["_score"] > 0.99 for r in rows[2:])


def test_edges(spark):
    texts = [None, "", " 12 !?", "😀 --", "é", "word " * 40_000, "x" * 200_000, "same", "same", "İ"]
    rows = [(i, t, None if i % 3 == 0 else "en", "s", "clash", 1.0) for i, t in enumerate(texts)] + [(None, "same", "", "s", "c", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, score double")
    model = li.fit(docs, F.lit(True))
    assert model.langs == ["", "en"]
    found = {r["doc_id"]: r for r in li.identify(docs, model, ["doc_id", "lang", "score"]).collect()}
    assert [found[i]["_lang"] for i in range(4)] == ["und"] * 4 and found[0]["_score"] == 0 and found[0]["_entropy"] is None
    assert all(found[i]["_lang"] in model.langs for i in range(4, 10)) and len(found) == 11
    nothing = li.fit(docs.limit(0), F.lit(True))
    assert nothing.langs == [] and {r["_lang"] for r in li.identify(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert li.identify(docs.limit(0), model, ["doc_id"]).count() == 0
    # Equal entropies: the first language.
    twice = fitted(spark, {"b": ["abc"], "a": ["abc"]})
    same = li.identify(docs.where("doc_id = 8"), twice, ["doc_id"]).first()
    assert same["_lang"] == "a" and same["_score"] == pytest.approx(0.5)
