"""Session defaults and the few places where a plan's lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "foliograph", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FOLIOGRAPH_DRIVER_MEMORY", "6g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to the folder the cluster names in spark.checkpoint.dir, which all executors share.

    Only where neither the context nor the configuration names one, and all executors are in this process, is a folder
    made here; it is removed at exit. On a cluster without such a folder it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="foliograph-ckpt-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)


def cut(df: DataFrame, forget: bool = False) -> DataFrame:
    """Materialise df in the shared checkpoint folder; later stages read it from there, whatever executors are lost.

    A checkpoint keeps what the optimizer had inferred about its rows. In long loops such constraints multiply with
    every round; with forget they are left behind.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)
    if not forget:
        return kept
    session = kept.sparkSession
    return DataFrame(session._jsparkSession.internalCreateDataFrame(kept._jdf.queryExecution().toRdd(), kept._jdf.schema(), False), session)
