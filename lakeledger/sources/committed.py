"""Tables whose readers see whole versions: data folders that a manifest names, written last."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_manifests"


def _files(spark: SparkSession, path: str):
    """Path and file system of a folder, as Spark resolves it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    at, fs = _files(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def versions(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{table}/{MANIFESTS}") if n.endswith(".json") and not n.startswith("_"))


def manifest(spark: SparkSession, table: str, version: int | None = None) -> dict:
    """``version``, ``folders`` (of the data, oldest first) and ``done`` (ids of the batches in it) of the newest version, or a given one."""
    known = versions(spark, table)
    if version is None and not known:
        return {"version": -1, "folders": [], "done": []}
    text = "\n".join(r[0] for r in spark.read.text(f"{table}/{MANIFESTS}/{known[-1] if version is None else version}.json").collect())
    return json.loads(text)


def _commit(spark: SparkSession, table: str, found: dict) -> None:
    """Write a manifest aside and rename it to its version. A version that is there already has been taken by another writer."""
    target, fs = _files(spark, f"{table}/{MANIFESTS}/{found['version']}.json")
    aside, _ = _files(spark, f"{table}/{MANIFESTS}/_{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(found).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise RuntimeError(f"version {found['version']} of {table} has been written meanwhile; read it and try again")


def _write(df: DataFrame, table: str, by: Sequence[str]) -> str:
    folder = f"data/part={uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(f"{table}/{folder}")
    return folder


def append(df: DataFrame, table: str, batch: str | None = None, by: Sequence[str] = ()) -> bool:
    """Add the rows as a new version. A ``batch`` id that the table holds already changes nothing and gives False.

    Data are written first, to a folder of their own; if the writer dies before the manifest, no reader ever sees them.
    """
    spark = df.sparkSession
    now = manifest(spark, table)
    if batch is not None and batch in now["done"]:
        return False
    folder = _write(df, table, by)
    _commit(spark, table, {"version": now["version"] + 1, "folders": [*now["folders"], folder], "done": [*now["done"], *([batch] if batch is not None else [])]})
    return True


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame | None:
    """The rows of one version, the newest by default; None where nothing is committed. What is planned on it stays as it
    is while others append or compact."""
    folders = manifest(spark, table, version)["folders"]
    if not folders:
        return None
    return spark.read.option("basePath", f"{table}/data").parquet(*[f"{table}/{f}" for f in folders]).drop("part")


def compact(spark: SparkSession, table: str, fold: Callable[[DataFrame], DataFrame] | None = None, by: Sequence[str] = ()) -> None:
    """One folder in place of all, as the next version; ``fold`` may reduce the rows. Older versions stay readable until ``vacuum``."""
    now = manifest(spark, table)
    if len(now["folders"]) < 2 and fold is None or not now["folders"]:
        return
    df = read(spark, table, now["version"])
    folder = _write(fold(df) if fold else df, table, by)
    _commit(spark, table, now | {"version": now["version"] + 1, "folders": [folder]})


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Drop all but the newest ``keep`` versions, and the data that only dropped ones name. Data of writers at work are newer
    than any manifest and are left: only what an old manifest names goes."""
    known = versions(spark, table)
    gone, left = known[:-keep], known[-keep:]
    used = {f for v in left for f in manifest(spark, table, v)["folders"]}
    for folder in {f for v in gone for f in manifest(spark, table, v)["folders"]} - used:
        at, fs = _files(spark, f"{table}/{folder}")
        fs.delete(at, True)
    for v in gone:
        at, fs = _files(spark, f"{table}/{MANIFESTS}/{v}.json")
        fs.delete(at, False)


def newest(df: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """The row of the highest version of each key, by a map-side combined maximum."""
    rest = [c for c in df.columns if c not in keys and c != version]
    return df.groupBy(*keys).agg(F.max(version).alias(version), *[F.max_by(c, version).alias(c) for c in rest])
