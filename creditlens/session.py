"""Session settings and the shared folder for files that several jobs read."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed stream state lives on disk, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # HotSpot leaves methods above this size to its interpreter.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


#: Folders of local applications that name none, by application id.
OWN_FOLDERS: dict[str, str] = {}


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "creditlens") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in OWN_FOLDERS:
        OWN_FOLDERS[key] = tempfile.mkdtemp(prefix="creditlens-")
    return OWN_FOLDERS[key]


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder, so that no run overwrites another."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Rows of a file of a frame on which much is computed. A file of one row group is one task's work,
#: however little it holds; small ones are dealt evenly over the cores.
FILE_ROWS = 25_000


def staged(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Write a frame that several jobs read to the shared folder and read it back.

    As Parquet, so that later passes read only their columns; the lineage ends
    here and a lost executor costs no recomputation before this point. ``file_rows`` is the most
    rows of a file, 0 for no bound; rows keep their order, and no copies or null keys gather.
    """
    path = run_folder(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Applications whose executors have the package.
SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; functions reach them by name.

    Not needed where the package is installed on every machine.
    """
    key = spark.sparkContext.applicationId
    if key in SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # Read on the driver alone: Spark's own file service hands it to the executors.
    archive = os.path.join(tempfile.mkdtemp(prefix="creditlens-"), "creditlens.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    SHIPPED.add(key)
