"""Session helpers: a default session and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "pairclf", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and a fixed time zone.

    On a cluster everything else (memory, executors, ``spark.checkpoint.dir``)
    comes from the submit command; ``conf`` is for local runs and tests.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a temporary
    folder. On a cluster a machine-local folder would lose data, so that raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="pairclf-")
    return _local_dirs[context.applicationId]


_local_dirs: dict[str, str] = {}


def tables_dir(spark: SparkSession) -> str:
    """The folder of the tables that this application writes on its way."""
    return f"{shared_dir(spark)}/pairclf/{spark.sparkContext.applicationId}"


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; paths are never reused."""
    return f"{tables_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> bool:
    """Delete all tables that this application has written on its way, and nothing else.

    For the end of a program: results that were not written elsewhere, and tables such as
    trained models, are gone with them. Returns whether there was anything to delete.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and
    what was written survives the loss of any executor."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
