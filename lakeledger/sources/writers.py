"""Writers: partitioned tables, CSV per reservoir, yearly and per-cell splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.functions.columns import coordinate_text, truncated_key
from lakeledger.operators.series import after_last
from lakeledger.sources import committed


def product(df: DataFrame, path: str, by: Sequence[str] = ("basin_id",), mode: str = "overwrite") -> None:
    """Product table by basin; only the partitions at hand are replaced."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def spread(df: DataFrame, *by) -> DataFrame:
    """Rows with equal ``by`` in one task, over a fixed number of tasks: creating a file costs more than its few rows, so
    that tasks must not be put together by the size of their data, as adaptive execution does without a number."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


def series_csv(df: DataFrame, path: str, ident: str = "reservoir_id", order: str = "date") -> None:
    """CSV folder per reservoir, each in date order.

    Rows are spread by reservoir and year, so that one long series is not written by one task.
    """
    (spread(df.withColumn("_year", F.year(order)), F.col(ident), F.col("_year")).sortWithinPartitions(ident, order)
     .drop("_year").write.mode("overwrite").option("header", True).partitionBy(ident).csv(path))


def yearly(df: DataFrame, path: str, date: str = "date") -> None:
    """One partition per year; a rerun replaces the years it holds."""
    (df.withColumn("year", F.year(date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(path))


def append_after(df: DataFrame, table: str, date: str = "date", keys: Sequence[str] = ()) -> None:
    """Add the rows of every key that are later than its last stored one, and all rows of a key that is new, to a committed table by year.

    The rows become part of the table at once or not at all, so that a run may be repeated: after a failure nothing is
    stored twice, and after success nothing is left to add.
    """
    stored = committed.read(df.sparkSession, table)
    new = df if stored is None else after_last(stored.select(*df.columns), df, keys, date)
    committed.append(new.withColumn("year", F.year(date)), table, by=["year"])


def cell_tables(df: DataFrame, path: str, values: Sequence[str], lat: str = "lat", lon: str = "lon", date: str = "date") -> None:
    """Text of the flux columns per grid cell; the key is the coordinate cut to two decimals."""
    key = lambda c: F.format_string("%.2f", truncated_key(F.col(c)))
    line = F.concat_ws("\t", *[coordinate_text(F.col(v).cast("double")) for v in values])
    (df.select(key(lat).alias("lat_key"), key(lon).alias("lon_key"), F.col(date), line.alias("value"))
     .repartition("lat_key", "lon_key", F.year(date)).sortWithinPartitions("lat_key", "lon_key", date).drop(date)
     .write.mode("overwrite").partitionBy("lat_key", "lon_key").text(path))


def lines(df: DataFrame, path: str, columns: Sequence[str], sep: str = " ", by: str | None = None) -> None:
    """Columns as separated text lines, in one folder per value of ``by``; its rows are brought together first, so that
    there is a file for each folder and not one for each task that holds a row of it."""
    out = df.select(*([by] if by else []), F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value"))
    if by:
        spread(out, F.col(by)).write.mode("overwrite").partitionBy(by).text(path)
    else:
        out.write.mode("overwrite").text(path)
