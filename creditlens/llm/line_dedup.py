"""Line dedup over levelled sorted runs of line hashes.

A document's lines become keys: stripped, A-Z lowered, hashed to 128 bits. Documents
come in batches. A batch first loses, by anti-join with the full runs, the keys already
known in enough documents; the rest is counted and added as a sorted run of level 0.
``FAN`` runs of a level are merged into one of the next level, and keys that reach the
threshold there move to the full runs. So a common key is written a few times only,
and each key of the corpus passes through at most log(batches) merges.

Lines whose key is full at the end are dropped from every document, earlier ones too.

Defined results: a null or empty text is one empty line; a line without a key (blank)
is never dropped; each row is a document of its own, also when ids repeat; rows with a
null id are treated alike; other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.llm.text import SPACES
from creditlens.session import run_folder

LEAST_DOCUMENTS = 10
LEAST_CHARS = 1
BATCHES = 4
FAN = 2
KEY = ["hi", "lo"]
KEYS = "doc_id long, batch int, hi long, lo long"
RUN = "hi long, lo long, documents long"


def split(text: bytes) -> list[bytes]:
    return text.split(b"\n")


def key_of(line: bytes, least: int = LEAST_CHARS) -> bytes | None:
    """The 128-bit hash of a line's key, None for a key of fewer code points than ``least``."""
    key = line.strip(SPACES).lower()
    if len(key) < least or (least > 1 and len(key.decode("utf-8", "replace")) < least):
        return None
    return xxhash.xxh3_128_digest(key)


def _encoded(value: str | None) -> bytes:
    return (value or "").encode("utf-8", "surrogatepass")


def line_keys(docs: DataFrame, batches: int = BATCHES, least: int = LEAST_CHARS) -> DataFrame:
    """Each document's distinct keys, with the batch that the document belongs to."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
        F.col("text").alias("text"),
    )

    def find(parts):
        for part in parts:
            ids, numbers, high, low = [], [], [], []
            for doc_id, batch, value in zip(part[0].to_pylist(), part[1].to_pylist(), part[2].to_pylist()):
                found = {k for k in (key_of(line, least) for line in split(_encoded(value))) if k}
                ids += [doc_id] * len(found)
                numbers += [batch] * len(found)
                high += [int.from_bytes(k[:8], "big", signed=True) for k in found]
                low += [int.from_bytes(k[8:], "big", signed=True) for k in found]
            arrays = [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "batch", *KEY])

    return source.mapInArrow(find, KEYS)


class LineRuns:
    """The levelled runs, each a folder of sorted Parquet files in the shared folder."""

    def __init__(self, spark: SparkSession, least_documents: int = LEAST_DOCUMENTS, fan: int = FAN):
        self.spark, self.least, self.fan = spark, least_documents, fan
        self.root = run_folder(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.full: list[str] = []
        self.made = 0

    def _write(self, frame: DataFrame, *parts: str) -> str:
        """Sorted by key within each file; the folder names are never used twice."""
        path = f"{self.root}/run-{self.made}"
        self.made += 1
        frame.sortWithinPartitions(*parts, *KEY).write.partitionBy(*parts).parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*paths)

    def add(self, keys: DataFrame) -> None:
        """Add a batch: one row per document and key."""
        if self.full:
            keys = keys.join(self._read(self.full), KEY, "left_anti")
        run = keys.groupBy(*KEY).agg(F.count("*").alias("documents"))
        self.levels[0].append(self._write(run))
        level = 0
        while len(self.levels[level]) >= self.fan:
            merged = self._merge(self.levels[level])
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            level += 1

    def _merge(self, paths: list[str]) -> str:
        """One run from several; what is full goes to the full runs and leaves the levels."""
        summed = self._read(paths).groupBy(*KEY).agg(F.sum("documents").alias("documents"))
        split_by = summed.withColumn("full", (F.col("documents") >= self.least).cast("int"))
        path = self._write(split_by, "full")
        # The empty folders stand for a side without keys.
        for side in (0, 1):
            self._read([]).write.mode("append").parquet(f"{path}/full={side}")
        self.full.append(f"{path}/full=1")
        return f"{path}/full=0"

    def common(self) -> DataFrame:
        """The keys found in enough documents over all batches."""
        open_runs = self._read([p for level in self.levels for p in level])
        late = open_runs.groupBy(*KEY).agg(F.sum("documents").alias("documents"))
        return late.where(F.col("documents") >= self.least).select(*KEY).unionByName(self._read(self.full).select(*KEY))


def common_keys(docs: DataFrame, batches: int, least_documents: int, least: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """All line keys by document, and the keys to drop."""
    spark = docs.sparkSession
    path = run_folder(spark, "line-keys")
    line_keys(docs, batches, least).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(KEYS).parquet(path)
    runs = LineRuns(spark, least_documents, fan)
    for batch in range(batches):
        runs.add(keys.where(F.col("batch") == batch))
    return keys, runs.common()


def dedup_lines(
    docs: DataFrame,
    keep: list[str] | None = None,
    batches: int = BATCHES,
    least_documents: int = LEAST_DOCUMENTS,
    least_chars: int = LEAST_CHARS,
    fan: int = FAN,
    digest_only: bool = False,
) -> DataFrame:
    """Documents without their common lines, and a struct ``_lines`` of the counts and digest.

    ``keep`` lists the columns to return (default all); ``text`` among them is the kept
    text. ``digest_only`` leaves the text itself out.
    """
    keep = list(keep or docs.columns)
    keys, common = common_keys(docs, batches, least_documents, least_chars, fan)
    hits = (
        keys.join(common, KEY, "left_semi")
        .groupBy(F.col("doc_id").alias("_lines_id"))
        .agg(F.collect_set(F.struct(*KEY)).alias("_lines_drop"))
    )
    columns = [c for c in keep if not (digest_only and c == "text")]
    joined = docs.join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col("_lines_id")), "left").select(
        *columns, F.col("text").alias("_lines_text"), F.col("_lines_drop").alias("_lines_drop")
    )
    info = T.StructType(
        [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    )
    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("_lines", info)])
    names, width = [*columns, "_lines"], len(columns)

    def rewrite(parts):
        for part in parts:
            new, lines, dropped, digests = [], [], [], []
            for value, listed in zip(part[width].to_pylist(), part[width + 1].to_pylist()):
                all_lines = split(_encoded(value))
                kept = all_lines
                if listed:
                    drop = {x["hi"].to_bytes(8, "big", signed=True) + x["lo"].to_bytes(8, "big", signed=True) for x in listed}
                    kept = [line for line in all_lines if key_of(line, least_chars) not in drop]
                body = b"\n".join(kept)
                lines.append(len(all_lines))
                dropped.append(len(all_lines) - len(kept))
                digests.append(hashlib.sha256(body).hexdigest())
                if not digest_only:
                    new.append(body.decode("utf-8", "surrogatepass") if value is not None else None)
            arrays = [pa.array(new, pa.string()).cast(part[i].type) if name == "text" else part[i] for i, name in enumerate(columns)]
            arrays.append(
                pa.StructArray.from_arrays(
                    [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests, pa.string())],
                    names=info.names,
                )
            )
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(rewrite, schema)
