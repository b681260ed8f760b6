"""Streams of observations: daily sums, duplicate scenes, composites and late corrections."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeledger.operators.pixels import COMPOSITES
from lakeledger.sources import committed

LATENESS = "3 days"


def observations(spark: SparkSession, folder: str, schema: str, name: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """File stream over a folder of parquet files, optionally one name pattern of it."""
    reader = spark.readStream.schema(schema)
    if name:
        reader = reader.option("pathGlobFilter", name)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _utc(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def daily_totals(stream: DataFrame, keys: Sequence[str], value: str, ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Sum, count and latest value per key and day, accepting rows up to ``lateness`` late."""
    w = _utc(stream, ts).withWatermark(ts, lateness)
    out = w.groupBy(*keys, F.window(ts, "1 day")).agg(
        F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"), F.max_by(value, ts).alias("latest"))
    return out.select(*keys, F.to_date("window.start").alias("date"), "total", "n", "latest")


def drop_duplicate_scenes(stream: DataFrame, ident: Sequence[str], ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Each scene once, however often it is delivered within the lateness."""
    return _utc(stream, ts).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(ident))


def composites(stream: DataFrame, keys: Sequence[str], sensor: str, value: str, first: str, ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Best value per composite window of a sensor; windows begin at ``first`` and repeat."""
    step, used, back = COMPOSITES[sensor]
    # The offset of the tumbling window from the epoch, in whole days.
    import datetime
    shift = ((datetime.date.fromisoformat(first) - datetime.date(1970, 1, 1)).days - back) % step
    w = _utc(stream, ts).withWatermark(ts, lateness)
    win = F.window(ts, f"{step} days", f"{step} days", f"{shift} days")
    out = w.withColumn("_w", win)
    out = out.where(F.datediff(F.to_date(ts), F.to_date("_w.start")) < used)
    return out.groupBy(*keys, "_w").agg(F.max(value).alias("best"), F.count(F.lit(1)).alias("n")).select(
        *keys, F.to_date("_w.start").alias("from_date"), F.date_add(F.to_date("_w.start"), used).alias("to_date"), "best", "n")


def _committed(stream: DataFrame, table: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], mode: str) -> StreamingQuery:
    """Each micro-batch as a version of a committed table; one that is replayed after a failure changes nothing."""
    def write(batch: DataFrame, version: int) -> None:
        committed.append(prepare(batch).withColumn("version", F.lit(version)), table, str(version))

    return (stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_upsert(stream: DataFrame, table: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Commit each micro-batch's changed rows; ``latest`` reads the last of each key."""
    return _committed(stream, table, checkpoint, lambda batch: batch, mode)


def run_partial_totals(stream: DataFrame, keys: Sequence[str], value: str, table: str, checkpoint: str, ts: str = "ts") -> StreamingQuery:
    """History in any order: each micro-batch adds its own sums, counts and latest values per key and day.

    Nothing waits for a watermark, so a file that comes after younger ones loses no day, and the result does not
    depend on how files are cut into batches. ``total_of_parts`` puts the parts together.
    """
    def parts(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys, F.to_date(ts).alias("date")).agg(
            F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"), F.max(F.struct(F.col(ts).alias("ts"), F.col(value).alias("value"))).alias("latest"))

    return _committed(stream, table, checkpoint, parts, "append")


def total_of_parts(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Sum, count and latest value per key and day over all parts."""
    out = committed.read(spark, table).groupBy(*keys, "date").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("latest").alias("latest"))
    return out.withColumn("latest", F.col("latest.value"))


def late_rows(stream_total: DataFrame, complete: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days for which a watermarked stream counted fewer rows than there are: how many came too late."""
    seen = stream_total.select(*keys, "date", F.col("n").alias("_seen"))
    late = F.col("n") - F.coalesce("_seen", F.lit(0))
    return complete.join(seen, [*keys, "date"], "left").select(*keys, "date", late.alias("late")).where("late > 0")


def latest(spark: SparkSession, table: str, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """Newest row of every key of an upsert table, in its newest version or a given one."""
    return committed.newest(committed.read(spark, table, version), keys).drop("version")


def compact(spark: SparkSession, table: str, keys: Sequence[str]) -> None:
    """Fold all batches so far into one state, in the next version; readers of older versions go on undisturbed."""
    committed.compact(spark, table, lambda df: committed.newest(df, keys))


def replace_provisional(provisional: DataFrame, observed: DataFrame, keys: Sequence[str], value: str, ts: str = "ts",
                        lateness: str = LATENESS) -> DataFrame:
    """Two streams of a value per key and time, the second of which displaces the first, whichever comes first.

    A full outer join on keys and time with a watermark on both sides: a pair gives the observed value as soon as both are
    there, and a row that stays alone is given, with its source, when the watermarks have passed it; its state then goes.
    So each key and time has one row, unless the other side is later than ``lateness``. An observed NULL
    leaves the provisional value. ``run_upsert`` in append mode writes the result.
    """
    sides = []
    for df, name in ((provisional, "_p"), (observed, "_o")):
        sides.append(_utc(df, ts).select(*[F.col(k).alias(f"{name}_{k}") for k in (*keys, ts)], F.col(value).alias(f"{name}_value")).withWatermark(f"{name}_{ts}", lateness))
    p, o = sides
    same = F.lit(True)
    for k in (*keys, ts):
        same = same & (F.col(f"_p_{k}") == F.col(f"_o_{k}"))
    joined = p.join(o, same, "full_outer")
    seen = F.col("_o_value").isNotNull()
    return joined.select(*[F.coalesce(f"_p_{k}", f"_o_{k}").alias(k) for k in (*keys, ts)], F.coalesce("_o_value", "_p_value").alias(value),
                         F.when(seen, "observed").otherwise("provisional").alias("source"))
