"""Session helpers: a local builder, table reading and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "roomweave") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows by key in a set number of tasks, where the work on them isn't seen in their bytes."""
    spark = df.sparkSession
    tasks = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    return df.repartition(tasks, key)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors see.

    It is set to a temporary folder only where the session has none and runs in one local process.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="roomweave-")
        spark.conf.set("spark.checkpoint.dir", where)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(where)
    return where


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder's name below the shared folder; what will be there is deleted when the driver ends."""
    where = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return where


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder, so that a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table in the shared folder: what is read back brings no constraints of its plan along.

    For iterations: constraints of checkpointed plans grow with every round, and the planner's time with them.
    """
    where = f"{scratch_dir(df.sparkSession, 'written')}/table"
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)
