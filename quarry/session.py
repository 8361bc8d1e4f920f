"""Session settings the operators rely on."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# An Arrow batch holds at most this much, however long the texts in it are.
MAX_BATCH_BYTES = 16 * 1024 * 1024


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where the package is installed on the executors or sent with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).parent
    archive = shutil.make_archive(
        tempfile.mkdtemp(prefix="quarry-") + "/quarry", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that may change in a running session, and the package for its workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(MAX_BATCH_BYTES))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, in the splits that the session's settings give."""
    return spark.read.parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session the cluster gives."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    return prepare(spark)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share; only a local session may do without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quarry-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/quarry-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the folder the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster must name one that is shared.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="quarry-checkpoint-"))
    return df.checkpoint(eager=True)
