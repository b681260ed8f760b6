"""Incremental runs: where to resume, and replacing stored rows by newer ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.operators.series import upsert


def resume_from(stored: DataFrame, keys: Sequence[str], resolution: int, end: Column, first: Column, date: str = "date",
                wanted: DataFrame | None = None) -> DataFrame:
    """Start date per key: two revisits before the last stored date, or ``first`` where nothing is stored.

    Keys whose last date is less than one revisit before ``end`` are left out.
    """
    last = stored.groupBy(*keys).agg(F.max(date).alias("last_date"))
    if wanted is not None:
        last = wanted.select(*keys).distinct().join(last, list(keys), "left")
    due = F.col("last_date").isNull() | (F.datediff(end, F.col("last_date")) >= resolution)
    return last.where(due).select(*keys, "last_date", F.coalesce(F.date_sub("last_date", 2 * resolution), first).alias("start_date"))


def due_rows(source: DataFrame, starts: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Source rows a resumed run has to process."""
    return source.join(starts.select(*keys, "start_date"), list(keys)).where(F.col(date) >= F.col("start_date")).drop("start_date")


def new_cycles(available: DataFrame, stored: DataFrame, track: str = "track", cycle: str = "cycle") -> DataFrame:
    """Cycles at or after the last stored one of each track."""
    last = stored.groupBy(track).agg(F.max(cycle).alias("_last"))
    return available.join(last, track, "left").where(F.col("_last").isNull() | (F.col(cycle) >= F.col("_last"))).drop("_last")


def incremental_update(stored: DataFrame, source: DataFrame, keys: Sequence[str], resolution: int, end: Column, first: Column,
                       date: str = "date") -> DataFrame:
    """Stored rows with everything from the overlap on taken from the source again."""
    starts = resume_from(stored, keys, resolution, end, first, date, wanted=source)
    return upsert(stored, due_rows(source, starts, keys, date), [*keys, date])
