"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume (UTC dates, adaptive execution, batches of bounded size for
    long texts), and let Python workers on this machine find the package where the driver did; a cluster has it installed."""
    environment, home = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if home not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, environment.get("PYTHONPATH")]))
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def named_folder(spark: SparkSession) -> str | None:
    """The folder in spark.checkpoint.dir, or the one a caller has set on the context; None if neither is set."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return named.rstrip("/") if named else None


def name_folder(spark: SparkSession, choose) -> None:
    """For entry points: where no shared folder is named and the master is local, use the one ``choose()`` returns."""
    if named_folder(spark) is None and spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        spark.sparkContext.setCheckpointDir(choose())


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; the caller names it in spark.checkpoint.dir."""
    named = named_folder(spark)
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return named


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a step of an iterative job as a table, so that later rounds start from files.

    One pass writes it, executors may come and go, and the planner knows the size of what it reads.
    """
    spark = df.sparkSession
    path = scratch_table(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_steps(*steps: DataFrame) -> None:
    """Delete the tables that ``cut_lineage`` wrote for these steps; nothing may read them any more."""
    for df in steps:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
