"""Readers for the file layouts the products and inputs come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions.columns import cfs_to_cms, file_stem, null_if
from lakeledger.operators.products import CURVE_NAMES
from lakeledger.sources import schemas


def _stem() -> Column:
    return file_stem(F.col("_metadata.file_name"))


def _clean(df: DataFrame) -> DataFrame:
    """NaN is missing; Spark would sort it last and keep it in averages."""
    return df.select(*[null_if(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
                       for f in df.schema])


def series(spark: SparkSession, path: str, kind: str, ident: str = "reservoir_id") -> DataFrame:
    """One CSV per reservoir with a header; the id is the file name without its ending."""
    df = spark.read.schema(schemas.SERIES[kind]).option("header", True).option("nanValue", "nan").csv(path)
    return _clean(df.select(_stem().alias(ident), "*"))


def optical(spark: SparkSession, path: str, sat: str, ident: str = "reservoir_id") -> DataFrame:
    """Area observations of one optical sensor in common column names."""
    schema, names = (schemas.SENTINEL2, schemas.SENTINEL2_NAMES) if sat == "s2" else (schemas.LANDSAT, schemas.LANDSAT_NAMES)
    df = spark.read.schema(schema).option("header", True).csv(path).select(_stem().alias(ident), "*").withColumnsRenamed(names)
    images = [F.col("images")] if "images" in df.columns else []
    return _clean(df.select(ident, F.lit(sat).alias("sat"), "date", "water_area", "non_water_area", "cloud_area", "corrected_area", *images))


def with_images(df: DataFrame) -> DataFrame:
    """Composites made from at least one image."""
    return df.where(F.col("images") > 0)


def curve(spark: SparkSession, path: str, ident: str = "reservoir_id") -> DataFrame:
    """Area-elevation curves with comment lines in front, in product column names."""
    df = (spark.read.schema(schemas.CURVE).option("header", True).option("comment", "#").csv(path)
          .select(_stem().alias(ident), "*"))
    return _clean(df.withColumnsRenamed(CURVE_NAMES).withColumnRenamed("storage (mil. m3)", "storage_mcm"))


def routed_flow(spark: SparkSession, path: str, ident: str = "reservoir_id") -> DataFrame:
    """Whitespace lines ``year month day flow`` in cubic feet per second, as m3/s."""
    part = F.split(F.trim("value"), r"\s+")
    df = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(_stem().alias(ident), part.alias("p"))
    at = lambda i, kind: F.get("p", F.lit(i)).cast(kind)
    return df.select(ident, F.make_date(at(0, "int"), at(1, "int"), at(2, "int")).alias("date"), cfs_to_cms(at(3, "double")).alias("streamflow"))


def altimeter_extract(spark: SparkSession, path: str) -> DataFrame:
    """Sixteen whitespace columns per return; short lines are skipped, NaN is missing."""
    part = F.split(F.trim("value"), r"\s+")
    df = spark.read.text(path).select(_stem().alias("source"), part.alias("p")).where(F.size("p") == schemas.EXTRACT_WIDTH)
    cols = [null_if(F.get("p", F.lit(i)).try_cast("double")).alias(n) for i, n in schemas.EXTRACT.items()]
    return df.select("source", *cols).withColumn("cycle", F.col("cycle").cast("int"))


def rule_curve(spark: SparkSession, path: str, ident: str = "curve") -> DataFrame:
    """Monthly stored fractions."""
    df = spark.read.schema(schemas.RULE_CURVE).option("header", True).csv(path).select(_stem().alias(ident), "*")
    return df.select(ident, F.col("Month").alias("month"), F.col("`S/Smax`").alias("s_by_smax"))


def stations(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated stations without header; rows with any missing value are left out."""
    return spark.read.schema(schemas.STATIONS).option("sep", "\t").csv(path).dropna()


def product(spark: SparkSession, path: str) -> DataFrame:
    """A product table written by ``writers.product``."""
    return spark.read.parquet(path)
