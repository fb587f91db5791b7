"""Session settings and the shared folder for tables written between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "parley", cores: str | None = None,
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect (UTC, AQE with skew handling).

    Without `cores` the master and its memory are those that spark-submit was given.
    """
    builder = SparkSession.builder.appName(app)
    if cores:
        builder = builder.master(f"local[{cores}]").config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (builder
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
               # a megabyte of turns is about a second of rule matching, so small
               # partitions are worth keeping
               .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
               .config("spark.sql.files.openCostInBytes", "256k")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.ui.enabled", "false"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in `spark.checkpoint.dir`.  A machine-local folder is
    only used when the master itself is this machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or \
        spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="parley-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table once and read it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A join side that grows with the calls: joined by shuffling, however small its files are.

    Ids and repeated texts take far less room in files and shuffles than in the driver, which would
    otherwise collect them to broadcast them.
    """
    return df.hint("merge")


def at_most(df: DataFrame, bound: int) -> bool:
    """Whether a table has no more than `bound` rows; stops reading at the bound."""
    return df.limit(bound + 1).count() <= bound
