"""Writers: cleaned data, results in several formats, features and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_processing_columns(df: DataFrame, as_of: str, job_name: str, quality_score: float) -> DataFrame:
    return df.withColumns(
        {
            "processing_date": F.lit(as_of).cast("date"),
            "job_name": F.lit(job_name),
            "quality_score": F.lit(quality_score),
        }
    )


def save_cleaned(df: DataFrame, path: str, as_of: str, job_name: str, quality_score: float) -> None:
    marked = with_processing_columns(df, as_of, job_name, quality_score)
    marked.write.mode("overwrite").option("compression", "snappy").parquet(path)


def save_bucketed(df: DataFrame, name: str, folder: str, key: str, buckets: int | None = None) -> DataFrame:
    """A table whose rows are placed by key, so that joins and groupings on the key move nothing.

    One shuffle here saves one per later join. The default number of buckets is
    the session's number of shuffle partitions.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{folder}/{name}")
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def save_all_formats(df: DataFrame, path: str) -> dict[str, str]:
    """The same rows as Parquet, CSV and JSON; computed once, copied from Parquet."""
    paths = {kind: f"{path}/{kind}" for kind in ("parquet", "csv", "json")}
    df.write.mode("overwrite").parquet(paths["parquet"])
    written = df.sparkSession.read.schema(df.schema).parquet(paths["parquet"])
    written.write.mode("overwrite").csv(paths["csv"], header=True)
    written.write.mode("overwrite").option("ignoreNullFields", False).json(paths["json"])
    return paths


def save_arff(df: DataFrame, path: str, relation: str) -> None:
    """ARFF text as a folder: one small header file and the data beside it."""
    spark: SparkSession = df.sparkSession
    kinds = {name: "STRING" if kind == "string" else "NUMERIC" for name, kind in df.dtypes}
    header = [f"@RELATION {relation}", ""]
    header += [f"@ATTRIBUTE {name} {kind}" for name, kind in kinds.items()] + ["", "@DATA"]
    spark.createDataFrame([("\n".join(header),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("?")) for name in df.columns]
    df.select(F.concat_ws(", ", *cells).alias("value")).write.mode("append").text(path)


def save_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_features(
    train: DataFrame, test: DataFrame, path: str, as_of: str, job_name: str, models: list[str], share: float = 0.8
) -> DataFrame:
    """Train and test sets with a metadata row; counts are read back from the files."""
    spark = train.sparkSession
    for name, part in (("train", train), ("test", test)):
        part.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/{name}")
    written = {name: spark.read.parquet(f"{path}/{name}") for name in ("train", "test")}
    first = written["train"].select("features").first()
    metadata = spark.createDataFrame(
        [
            (
                as_of,
                job_name,
                written["train"].count(),
                written["test"].count(),
                first["features"].size if first else 0,
                share,
                ",".join(models),
            )
        ],
        "created string, job_name string, train_records bigint, test_records bigint, "
        "feature_dimension int, train_test_split double, models_saved string",
    )
    save_report(metadata, f"{path}/metadata")
    return metadata
