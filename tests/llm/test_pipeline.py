"""The pipeline against a brute-force version of its stages."""

import pytest

import corpus_pipeline
from compare import compare, connect
from creditlens.llm import decontaminate
from creditlens.llm.queries import CHECKS, QUERIES
from test_operators import SMALL, brute_classes, plain_hits, plain_lines

ORDER = ["quality rules", "line dedup", "MinHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_agrees_with_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SMALL), connection, CHECKS[name]) is None


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER
    assert {int(name[2:].split("_")[0]) for name in QUERIES if name != "pipeline"} == set(range(1, 14))


def test_pipeline_against_brute_force(spark, connection):
    texts = dict(connection.execute("SELECT doc_id, text FROM documents").fetchall())
    kept = {r[0] for r in connection.execute(f"SELECT doc_id FROM ({CHECKS['op3_quality_rules']}) WHERE kept").fetchall()}
    ids = sorted(kept)
    texts = dict(zip(ids, plain_lines([texts[i] for i in ids], 10)))
    classes = brute_classes(texts)
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    items = [(i, decontaminate.words_of(t)) for i, t in connection.execute("SELECT item_id, text FROM benchmark").fetchall()]
    hits = {i: (len(plain_hits(w, items, 10)[0]), len(w)) for i, w in ((i, decontaminate.words_of(t)) for i, t in texts.items())}
    expected = {i for i in texts if hits[i][0] <= decontaminate.MOST_COVERED * hits[i][1]}

    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(rows) == expected
    for i, row in rows.items():
        assert row["n_chars"] == len(row["text"]) and row["n_pieces"] == len(row["pieces"])
        if not hits[i][0]:
            assert row["text"] == texts[i]
        else:
            assert not plain_hits(decontaminate.words_of(row["text"]), items, 10)[0]
            assert len(decontaminate.words_of(row["text"])) <= hits[i][1] - hits[i][0]


def test_every_stage_takes_odd_and_empty_tables(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 20_000, None, "s", 1)], documents.schema
    )
    for docs in (odd, documents.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SMALL)
            assert result.columns[: len(docs.columns)] == docs.columns and result.count() <= docs.count(), name
