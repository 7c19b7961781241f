"""From raw documents to piece ids: rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns a frame; all but the last return the columns of ``docs``. Between stages the
result is written as Parquet to the shared folder and read again, so a lost executor
costs at most the stage at work.

The last stage adds ``pieces`` and ``n_pieces``; its ``text`` is decoded from the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.llm import decontaminate, line_dedup, near_dedup, pieces, quality_rules
from creditlens.llm.frames import read
from creditlens.session import staged


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars says the length of the text that a stage has changed."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.dedup_lines(docs).select(*docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark")))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = [c for c in docs.columns if c != "text"]
    coded = pieces.encode(docs, rest, decoded=True)
    columns = [F.col("_decoded").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    count = F.coalesce(F.size("_pieces"), F.lit(0)).cast("long")
    return coded.select(*columns, F.col("_pieces").alias("pieces"), count.alias("n_pieces"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("SentencePiece encoding and decoding", piece_stage),
]

#: Piece ids depend on a vocabulary file and keyed hashes, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
