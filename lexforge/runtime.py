"""Session helpers that every layer shares: table access and durable lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table by name; only Spark's own readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the folder that the cluster names; without one, use a temporary folder in local mode only."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexforge-checkpoint-"))


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and continue from there, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
