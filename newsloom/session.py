"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


#: Bytes of a batch that goes to a Python worker, about.
ARROW_BYTES = 4 << 20
ARROW_SETTING, ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def utc_session(spark: SparkSession) -> SparkSession:
    """Pin the session zone: a timestamp without a zone is UTC everywhere here. Batches for Python are small."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return small_batches(spark)


def small_batches(spark: SparkSession) -> SparkSession:
    """Batches for Python end at ``ARROW_BYTES``: a task's worker holds no more of its texts, whatever
    the input. Spark's default is 64 MB; another value is kept.
    """
    if spark.conf.get(ARROW_SETTING) == ARROW_DEFAULT:
        spark.conf.set(ARROW_SETTING, str(ARROW_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session without the setting gets a folder of its own: on a
    cluster a machine-local folder would lose data with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="newsloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and go on from there."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def local_session(cpus: int = 8, app: str = "newsloom") -> SparkSession:
    """Session for tests and the bench on one machine."""
    return utc_session(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
