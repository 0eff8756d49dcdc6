"""Session helpers: local session for tests and benches, lineage cuts, table access."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "cauldra", partitions: int = 8) -> SparkSession:
    """A session for one machine. Clusters bring their own configuration instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def any_session(master: str | None = None) -> SparkSession:
    """The session there is; else one on ``master``, on what spark-submit was told, or on this machine."""
    if (there := SparkSession.getActiveSession()) is not None:
        return there
    if master is None and "PYSPARK_GATEWAY_PORT" not in os.environ and "SPARK_REMOTE" not in os.environ:
        return local_session("*")
    builder = SparkSession.builder.appName("cauldra").config("spark.sql.session.timeZone", "UTC")
    return (builder.master(master) if master else builder).getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint folder, lineage cut.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local master
    without that setting gets a temporary folder; elsewhere a missing setting is an error, since a
    folder on one machine would not survive the loss of an executor.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="cauldra-checkpoint-"))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the unit by which operators size their cells."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
