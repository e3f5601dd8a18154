"""Spark session for local runs, and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_scratch: dict[str, str] = {}
_shipped: set[str] = set()


# A hot key is split at run time even where the split costs one more shuffle: several joins in a
# row use the loan number, and Spark would otherwise leave the first of them whole.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on what the operators count on; sizes and thresholds stay with the cluster."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="loanlens-"))
        .getOrCreate()
    )
    return prepare(session)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session that names none (a local test) gets a scratch folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return _scratch.setdefault(context.applicationId, tempfile.mkdtemp(prefix="loanlens-"))


def run_path(spark: SparkSession, name: str) -> str:
    """A new path for a table of this run; one folder per application, so that a run is easy to clear."""
    return f"{shared_folder(spark)}/loanlens-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to a fresh path in the shared folder and read it back.

    Later steps then start from files that outlive any executor, not from a long lineage.
    """
    path = run_path(df.sparkSession, name)
    if partition_by:
        # Gather each partition value, splitting large ones, so that not every task writes to every folder.
        df.hint("rebalance", partition_by).write.mode("errorifexists").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("errorifexists").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    table._written_to = path
    return table


def forget(*tables: DataFrame) -> None:
    """Remove the files of tables made by `written`, once every table that was derived from them is written itself."""
    for table in tables:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(table._written_to)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package's Python files, once per application.

    Functions that run inside tasks import it there. Spark sends the archive; the file itself is the driver's.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="loanlens-")), "loanlens.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
