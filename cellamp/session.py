"""Session defaults and the tables a job writes to cut its lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cellamp")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cellamp-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str = "") -> str:
    """An unused path in the shared folder, below the folder of this application."""
    return f"{shared_dir(spark).rstrip('/')}/cellamp/{spark.sparkContext.applicationId}/{name}{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    Used where a result is read more than once: the work is done once, its columns can be pruned by each
    reader, and a lost executor costs a re-read and not a recomputation. All tables of an application lie in
    one folder and can be removed when it has ended.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for a scan with fewer splits than cores; anything larger is left as it is."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def task_number(spark: SparkSession) -> int:
    """Tasks for work that costs far more than its bytes suggest."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def by_cell(df: DataFrame, key: str = "bc") -> DataFrame:
    """Hash partitions per cell for work that costs far more than its bytes suggest.

    The number is given, so that small shuffles are not merged into a few tasks.
    """
    return df.repartition(task_number(df.sparkSession), key)


def by_umi(df: DataFrame) -> DataFrame:
    """The same for cells that are too large for a task."""
    return df.repartition(task_number(df.sparkSession), "bc", "umi")
