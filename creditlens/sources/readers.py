"""Readers: CSV, JSON, Parquet and ARFF text, by path, extension or file time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.schemas import APPLICATION

MISSING_MARK = "?"
FORMATS = ("csv", "json", "parquet")


def read_csv(spark: SparkSession, path: str, schema: str = APPLICATION) -> DataFrame:
    """CSV with a header and ``?`` for a missing value; the schema saves an inference scan."""
    return spark.read.schema(schema).option("nullValue", MISSING_MARK).csv(path, header=True)


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Reader chosen by the extension; Parquet for anything else."""
    kind = next((f for f in FORMATS if path.rstrip("/").endswith(f".{f}")), "parquet")
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    return reader.format(kind).load(path)


def read_modified_between(spark: SparkSession, folder: str, start: str, end: str, schema: str) -> DataFrame:
    """Files of any of the three formats written in a time window, as one frame."""
    frames = []
    for kind in FORMATS:
        reader = (
            spark.read.schema(schema)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*.{kind}")
            .option("modifiedAfter", start)
            .option("modifiedBefore", end)
        )
        if kind == "csv":
            reader = reader.option("header", True)
        frames.append(reader.format(kind).load(folder))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def arff_attributes(spark: SparkSession, path: str) -> list[str]:
    """Attribute names of an ARFF header, in file order.

    One file that has a header is found, and its names, as many as the table is
    wide, are ordered by block and line, which a plain text scan keeps.
    """
    is_attribute = F.col("value").rlike(r"(?i)^\s*@attribute\s")
    found = spark.read.text(path).where(is_attribute).select(F.col("_metadata.file_path").alias("file")).first()
    if found is None:
        raise ValueError("No attributes found in ARFF text")
    header = (
        spark.read.text(found["file"])
        .where(is_attribute)
        .select(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            F.regexp_extract("value", r"(?i)^\s*@attribute\s+(\w+)", 1).alias("name"),
        )
        .orderBy("block", "line")
        .collect()
    )
    return [row["name"] for row in header]


def read_arff(spark: SparkSession, path: str) -> DataFrame:
    """ARFF text as columns of trimmed text; blank lines, comments and the header are left out."""
    names = arff_attributes(spark, path)
    line = F.trim("value")
    directive = line.rlike(r"(?i)^@(relation|attribute|data)(\s|$)")
    data = spark.read.text(path).where((line != "") & ~line.startswith("%") & ~directive)
    parts = F.split(line, ",")
    return data.select(*[F.trim(F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(names)])


def stream_table(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """A given table as a stream of its files; the braces make one path work for
    a single file and for a folder of part files."""
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}.parquet}}")
