"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Into how many parts tables of few files are dealt after reading. Set for the small files of tests
# and of the benchmark only; unset, as on a cluster, tables stay as they are stored.
SPREAD = "spark.tokenloom.spread"
HASH_BYTES = "64m"


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tokenloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Joins whose smaller side has at most so many bytes a partition, as measured while shuffling, hash instead of sorting.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASH_BYTES)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(SPREAD, str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    (a test) gets a temporary folder; on a cluster each executor would write to its own disk.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tokenloom-")
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so that several plans can read it.

    A reliable checkpoint survives lost executors and keeps the partitioning of its plan.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """:func:`materialize` as compressed columns, which are smaller and forget how ``df`` was dealt out.

    Large rows need files of ``file_rows``, as Spark's reader and writer of parquet hold up to 4096 and 100 rows of a file at once.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
