"""Water area from image pixels.

A scene may hold any number of pixels, so nothing here gathers a scene: pixels are reduced by
aggregates and by histograms over the 0..100 occurrence scale.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import bit_set, normalized_difference
from lakeledger.session import cut_lineage, drop_steps

# Fixed values.
LANDSAT_SCALE, LANDSAT_OFFSET = 0.0000275, -0.2
LANDSAT_SHADOW_BIT, LANDSAT_CLOUD_BIT = 3, 4
SENTINEL2_SCALE = 0.0001
SENTINEL2_CLOUD_CLASSES = (3, 8, 9, 10)
CLOUD_LIMIT = 90.0
NDWI_LIMIT = 0.3
GAP_SHARE = 0.17
CLUSTERS = (2, 7)
TOLERANCE = 5e-2  # of the spread of a cluster: how little its centre moves at the end
SAR_ANGLES = (31.66, 45.4)
SAR_WATER = (-32.0, -13.0)
SAR_PIXEL_KM2 = 1e-4
TILE = 64  # pixels on a side
BLOCK = 2048  # pixels of a scene in a row
TASK_ROWS = 1 << 16  # rows that a task looks at together
# Sensor: days per step, days used, days before the step date.
COMPOSITES = {"s2": (5, 5, 4), "l8": (16, 15, 0), "l9": (16, 15, 0), "sar": (12, 12, 0)}


# --- rows in order --------------------------------------------------------------------------

def _runs(table, names: Sequence[str]) -> np.ndarray:
    """Where in a table, ordered by these columns, each of their values starts."""
    new = np.arange(table.num_rows) == 0
    for name in names:
        codes = table[name].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _whole_runs(batches: Iterable, names: Sequence[str], least: int = TASK_ROWS) -> Iterator[tuple]:
    """Tables of about ``least`` rows that end where a value of these columns ends, each with the starts of the values."""
    import pyarrow as pa

    held, rows, limit = [], 0, least
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= limit:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _runs(table, names)
            done = int(starts[-1])
            if done:
                yield table.slice(0, done), starts[:-1]
            held, rows = table.slice(done).to_batches(), rows - done
            limit = max(least, 2 * rows)
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _runs(table, names)


# --- masks and indices ----------------------------------------------------------------------

def landsat_cloud(qa: Column) -> Column:
    return bit_set(qa, LANDSAT_CLOUD_BIT) | bit_set(qa, LANDSAT_SHADOW_BIT)


def sentinel2_cloud(scene_class: Column) -> Column:
    return scene_class.isin(*SENTINEL2_CLOUD_CLASSES)


def mask_and_scale(df: DataFrame, bands: Sequence[str], cloud: Column, scale: float, offset: float = 0.0) -> DataFrame:
    """Reflectance of clear pixels; bands of cloudy ones are NULL."""
    out = df.withColumn("cloud", F.coalesce(cloud, F.lit(False)))
    for b in bands:
        out = out.withColumn(b, F.when(~F.col("cloud"), F.col(b) * scale + offset))
    return out


def landsat_indices(df: DataFrame) -> DataFrame:
    c = F.col
    return (df.withColumn("ndwi", normalized_difference(c("b5"), c("b6")))
            .withColumn("mndwi", normalized_difference(c("b3"), c("b6")))
            .withColumn("mbwi", c("b3") * 3 - c("b4") - c("b5") - c("b6") - c("b7")))


def sentinel2_indices(df: DataFrame) -> DataFrame:
    c = F.col
    return (df.withColumn("ndwi", normalized_difference(c("b3"), c("b8")))
            .withColumn("mndwi", normalized_difference(c("b3"), c("b12")))
            .withColumn("mbwi", c("b3") * 3 - c("b4") - c("b8") - c("b11") - c("b12")))


# --- composites -----------------------------------------------------------------------------

def composite_windows(df: DataFrame, sensor: str, first: str, date: str = "image_date") -> DataFrame:
    """Assign each image to its composite by arithmetic; images in the unused days drop out.

    ``first`` is the first step date; ``from_date`` and ``to_date`` bound the window (end exclusive).
    """
    step, used, back = COMPOSITES[sensor]
    begin = F.date_sub(F.lit(first).cast("date"), back)
    off = F.datediff(F.col(date), begin)
    k = F.floor(off / step).cast("int")
    staged = df.withColumn("_k", k).where((off >= 0) & (off - F.col("_k") * step < used))
    return (staged.withColumn("from_date", F.date_add(begin, F.col("_k") * step))
            .withColumn("to_date", F.date_add("from_date", used))
            .withColumn("composite_date", F.date_add(F.lit(first).cast("date"), F.col("_k") * step)).drop("_k"))


def mosaic_end_date(to_date: Column) -> Column:
    return F.date_sub(to_date, 1)


def quality_mosaic(df: DataFrame, keys: Sequence[str], values: Sequence[str], index: str = "ndwi",
                   ties: Sequence[str] = ()) -> DataFrame:
    """Per pixel, the image with the highest index; NULL where every image is masked.

    Reduced by ``max_by`` before the shuffle. ``n_images`` counts the images behind a pixel.
    """
    order = F.when(F.col(index).isNotNull(), F.struct(index, *ties))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_best"), F.count(F.lit(1)).alias("n_images"))
    return best.select(*keys, "n_images", *[F.col("_best")[v].alias(v) for v in values])


# --- areas ----------------------------------------------------------------------------------

def scene_areas(df: DataFrame, keys: Sequence[str], water: Column, area: Column) -> DataFrame:
    """Water, non-water and cloud area in km2 and the cloud percent of a scene; ``water`` is NULL under cloud."""
    km2 = area * 1e-6
    part = lambda c: F.sum(F.when(c, km2).otherwise(F.lit(0.0)))
    out = df.groupBy(*keys).agg(
        F.sum(km2).alias("aoi_area"), part(water).alias("water_area"), part(~water).alias("non_water_area"),
        part(water.isNull()).alias("cloud_area"))
    return out.withColumn("cloud_percent", F.try_divide(F.col("cloud_area") * 100, F.col("aoi_area")))


def ndwi_water(index: Column, limit: float = NDWI_LIMIT) -> Column:
    return index >= limit


def gap_corrected_area(df: DataFrame, keys: Sequence[str], water: Column, area: Column, occurrence: str = "occurrence",
                       share: float = GAP_SHARE, limit: float = CLOUD_LIMIT) -> DataFrame:
    """Water area with cloudy pixels filled from long-term water occurrence.

    The threshold is the first occurrence whose water count exceeds a share of the mean count;
    cloudy pixels at or above it count as water. Scenes that are too cloudy or without water get
    -1. The scene is reduced to one row per occurrence value before anything is ordered.
    """
    km2 = area * 1e-6
    known = F.coalesce(water, F.lit(False))
    hist = df.groupBy(*keys, occurrence).agg(
        F.sum(known.cast("long")).alias("_n"), F.sum(F.when(known, km2).otherwise(0.0)).alias("_water"),
        F.sum(F.when(water.isNull(), km2).otherwise(0.0)).alias("_cloudy"), F.sum(km2).alias("_all"))
    w = Window.partitionBy(*keys)
    filled = F.when(F.col("_n") > 0, F.col("_n"))
    hist = hist.withColumn("_mean", F.avg(filled).over(w))
    hist = hist.withColumn("_from", F.min(F.when(F.col("_n") > F.col("_mean") * share, F.col(occurrence))).over(w))
    out = hist.groupBy(*keys).agg(
        F.sum("_water").alias("raw_area"), F.sum("_cloudy").alias("_cloud"), F.sum("_all").alias("_aoi"),
        F.max("_from").alias("occurrence_threshold"),
        F.sum(F.when(F.col(occurrence) >= F.col("_from"), F.col("_cloudy")).otherwise(0.0)).alias("_gain"))
    usable = (F.col("_cloud") * 100 < F.col("_aoi") * limit) & (F.col("raw_area") > 0)
    return out.withColumn("corrected_area", F.when(usable, F.col("raw_area") + F.col("_gain")).otherwise(F.lit(-1.0))).drop(
        "_cloud", "_aoi", "_gain")


# --- unsupervised water ---------------------------------------------------------------------

def _squared(point: Sequence[Column], centre: Column, features: Sequence[str]) -> Column:
    return sum(((p - centre[f]) * (p - centre[f]) for p, f in zip(point, features, strict=True)), F.lit(0.0))


def _blocks(clear: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``keys, _x``: pixels of a scene, at most ``BLOCK`` in a row, as an array of all values of the first feature, then of the next."""
    keys = list(keys)

    def packed(batches):
        import pyarrow as pa

        for table, starts in _whole_runs(batches, keys):
            ends = np.append(starts[1:], table.num_rows)
            cuts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(starts, ends, strict=True)])
            values = np.array([table[f].to_numpy() for f in features])
            sides = np.append(cuts[1:], table.num_rows)
            lists = pa.array([values[:, a:b].ravel() for a, b in zip(cuts, sides, strict=True)], pa.list_(pa.float64()))
            yield from table.select(keys).take(pa.array(cuts)).append_column("_x", lists).to_batches()

    schema = clear.select(*keys, F.array(F.lit(0.0)).alias("_x")).schema
    # Dealt out evenly, however small or uneven the scenes are: every seed and every round reads all of it.
    dealt = clear.repartition(int(clear.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cut_lineage(dealt.sortWithinPartitions(*keys).mapInArrow(packed, schema))


def _distances(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance of each pixel to its nearest centre and that one's number, the lowest on a tie; NaN is above all."""
    best, number = np.full(x.shape[1], np.nan), np.zeros(x.shape[1], np.int64)
    for j, centre in enumerate(centres):
        d = np.zeros(x.shape[1])
        for values, c in zip(x, centre, strict=True):
            step = values - c
            d += step * step
        closer = (d < best) | (np.isnan(best) & ~np.isnan(d))
        best[closer], number[closer] = d[closer], j
    return best, number


def _extreme(blocks: DataFrame, state: DataFrame, keys: Sequence[str], features: Sequence[str], nearest: bool) -> DataFrame:
    """``keys, _d, _p``: the pixel of each scene nearest to its only, or farthest from all of its ``_seeds``. Of equal distances
    the least or greatest features decide."""
    keys, width = list(keys), len(features)

    def found(batches):
        import pyarrow as pa

        for batch in batches:
            points, far = [], []
            for x, seeds in zip(batch["_x"], batch["_s"], strict=True):
                x = x.values.to_numpy().reshape(width, -1)
                d = _distances(x, seeds.values.to_numpy().reshape(-1, width))[0]
                rank = np.where(np.isnan(d), np.inf, d)
                ties = np.flatnonzero(rank == (rank.min() if nearest else rank.max()))
                at = ties[np.lexsort(x[::-1, ties])[0 if nearest else -1]]
                points.append(x[:, at])
                far.append(d[at])
            out = pa.table([*(batch[k] for k in keys), pa.array(far, pa.float64()), pa.array(points, pa.list_(pa.float64()))], [*keys, "_d", "_p"])
            yield from out.to_batches()

    schema = blocks.select(*keys, F.lit(0.0).alias("_d"), F.col("_x").alias("_p")).schema
    flat = state.select(*keys, F.flatten(F.transform("_seeds", lambda s: F.array(*[s[f] for f in features]))).alias("_s"))
    best = F.struct("_d", F.struct(*[F.col("_p")[i].alias(f) for i, f in enumerate(features)]).alias("p"))
    one = blocks.join(flat, keys).mapInArrow(found, schema).groupBy(*keys).agg((F.min if nearest else F.max)(best).alias("_b"))
    return one.select(*keys, F.col("_b._d").alias("_d"), F.col("_b.p").alias("_next"))


def _sums(blocks: DataFrame, fits: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``keys, _k, _j, _m, _d, _c``: how many pixels of a scene are nearest to centre ``_j`` of fit ``_k``, the sum of their
    squared distances, and their mean. A pass over the pixels for all fits, from ``fits(keys, _k, _centres)``."""
    keys, width = list(keys), len(features)
    names = [f"_s{i}" for i in range(width)]

    def added(batches):
        import pyarrow as pa

        for batch in batches:
            at, parts = [], []
            for row, (x, ks, cs) in enumerate(zip(batch["_x"], batch["_ks"], batch["_cs"], strict=True)):
                x, ks, cs = x.values.to_numpy().reshape(width, -1), ks.values.to_numpy(), cs.values.to_numpy().reshape(-1, width)
                for k, end in zip(ks, np.cumsum(ks), strict=True):
                    d, j = _distances(x, cs[end - k:end])
                    m = np.bincount(j, minlength=k)
                    part = np.array([np.full(k, k), np.arange(k), m, *(np.bincount(j, w, k) for w in (d, *x))])[:, m > 0]
                    parts.append(part)
                    at.append(np.full(part.shape[1], row))
            if at:
                values = np.concatenate(parts, axis=1)
                rows = pa.array(np.concatenate(at))
                out = pa.table([*(batch[k].take(rows) for k in keys), *(pa.array(v.astype(np.int64)) for v in values[:3]), *map(pa.array, values[3:])],
                               [*keys, "_k", "_j", "_m", "_d", *names])
                yield from out.to_batches()

    whole, real = F.lit(0).cast("long"), F.lit(0.0)
    schema = blocks.select(*keys, *[whole.alias(c) for c in ("_k", "_j", "_m")], *[real.alias(c) for c in ("_d", *names)]).schema
    flat = F.flatten(F.transform("_centres", lambda c: F.array(*[c[f] for f in features])))
    packed = (fits.groupBy(*keys).agg(F.collect_list(F.struct(F.size("_centres").cast("long").alias("k"), flat.alias("c"))).alias("_fits"))
              .select(*keys, F.col("_fits.k").alias("_ks"), F.flatten("_fits.c").alias("_cs")))
    return (blocks.join(packed, keys).mapInArrow(added, schema).groupBy(*keys, F.col("_k").cast("int").alias("_k"), F.col("_j").cast("int").alias("_j"))
            .agg(F.sum("_m").alias("_m"), F.sum("_d").alias("_d"), F.struct(*[(F.sum(n) / F.sum("_m")).alias(f) for n, f in zip(names, features, strict=True)]).alias("_c")))


def _starts(blocks: DataFrame, keys: Sequence[str], features: Sequence[str], most: int) -> DataFrame:
    """``_mean``, ``_n`` and ``_seeds`` of every scene: the pixel nearest the mean, then always one farthest from all seeds before.

    A pass over the pixels for each seed; of equal distances the greatest features decide, so that no order of rows does.
    """
    keys = list(keys)
    nought = F.array(F.struct(*[F.lit(0.0).alias(f) for f in features]))
    mean = cut_lineage(_sums(blocks, blocks.select(*keys).distinct().select(*keys, nought.alias("_centres")), keys, features)
                       .select(*keys, F.col("_c").alias("_mean"), F.col("_m").alias("_n"), F.array("_c").alias("_seeds")))
    first = _extreme(blocks, mean, keys, features, nearest=True)
    state = cut_lineage(mean.join(first, keys).select(*keys, "_mean", "_n", F.array("_next").alias("_seeds")))
    for _ in range(1, most):
        grown = state.join(_extreme(blocks, state, keys, features, nearest=False), keys).withColumn(
            "_seeds", F.when(F.col("_d") > 0, F.array_append("_seeds", F.col("_next"))).otherwise(F.col("_seeds")))
        before, state = state, cut_lineage(grown.drop("_next", "_d"))
        drop_steps(before)
    drop_steps(mean)
    return state


def cluster_centres(df: DataFrame, keys: Sequence[str], features: Sequence[str], clusters: tuple[int, int] = CLUSTERS,
                    tolerance: float = TOLERANCE) -> DataFrame:
    """Cluster centres per scene, from all of its clear pixels: ``keys, cluster, _c_<feature>``.

    For every number of clusters in the range, Lloyd rounds start from the first so many of the scene's farthest pixels.
    One pass over the pixels is a round of all scenes and all numbers of clusters that still move: each pixel goes to its
    nearest centre, next to the data, and only the sums for each (scene, number, centre) are shuffled. A fit ends when no
    centre has moved by more than ``tolerance`` of how far its pixels lie from it (root mean square); every round lowers
    the squared error, so that this comes. The number of clusters with the best variance ratio wins, the lower on a tie.
    """
    keys, (lowest, highest) = list(keys), clusters
    clear = df.dropna(subset=list(features)).select(*keys, *[F.col(f).cast("double").alias(f) for f in features])
    clear = clear.where(~sum((F.isnan(f).cast("int") for f in features), F.lit(0)).cast("boolean"))
    blocks = _blocks(clear, keys, features)
    starts = _starts(blocks, keys, features, highest)
    spread = F.array_max(F.transform("_seeds", lambda s: _squared([s[f] for f in features], F.col("_seeds")[0], features)))
    wanted = F.filter(F.sequence(F.lit(lowest), F.lit(highest)), lambda k: k <= F.size("_seeds"))
    fits = (starts.withColumn("_span", spread).withColumn("_k", F.explode(F.when(F.size(wanted) > 0, wanted).otherwise(F.array(F.lit(1)))))
            .select(*keys, "_mean", "_n", "_span", "_k", F.slice("_seeds", F.lit(1), F.col("_k")).alias("_centres")))
    moving, done = cut_lineage(fits.withColumn("_score", F.lit(None).cast("double"))), []
    while not moving.isEmpty():
        sums = _sums(blocks, moving, keys, features)
        # A row for each centre: where it goes, how far, and what it adds to the spread within and between.
        old = moving.select(*keys, "_mean", "_n", "_span", "_k", F.posexplode("_centres").alias("_j", "_old")).join(sums, [*keys, "_k", "_j"], "left")
        fields = lambda c: [F.col(f"{c}.{f}") for f in features]
        shift = F.coalesce(_squared(fields("_c"), F.col("_old"), features), F.lit(0.0))
        ratio = (old.withColumn("_shift", shift).withColumn("_between", F.col("_m") * _squared(fields("_c"), F.col("_mean"), features))
                 .groupBy(*keys, "_k").agg(
                     F.first("_mean").alias("_mean"), F.first("_n").alias("_n"), F.first("_span").alias("_span"),
                     F.transform(F.sort_array(F.collect_list(F.struct("_j", F.coalesce("_c", "_old").alias("c")))), lambda r: r["c"]).alias("_centres"),
                     F.sum("_between").alias("_between"), F.sum(F.col("_d") - F.col("_m") * F.col("_shift")).alias("_within"),
                     F.max(F.coalesce(F.col("_shift") * F.col("_m") > F.col("_d") * tolerance * tolerance, F.lit(False))).alias("_moves")))
        score = F.when(F.col("_k") == 1, F.lit(0.0)).when(F.col("_within") <= F.col("_span") * F.col("_n") * 1e-24, F.lit(float("inf"))).otherwise(
            (F.col("_between") / (F.col("_k") - 1)) / (F.col("_within") / F.greatest(F.col("_n") - F.col("_k"), F.lit(1))))
        step = cut_lineage(ratio.select(*keys, "_mean", "_n", "_span", "_k", "_centres", score.alias("_score"), "_moves"))
        moving = step.where("_moves").drop("_moves")
        done.append(step.where("NOT _moves").select(*keys, "_k", "_score", "_centres"))
    if not done:
        done = [fits.select(*keys, "_k", F.lit(0.0).alias("_score"), "_centres")]
    fitted = done[0]
    for part in done[1:]:
        fitted = fitted.unionByName(part)
    best = fitted.groupBy(*keys).agg(F.max_by("_centres", F.struct("_score", -F.col("_k"))).alias("_centres"))
    return best.select(*keys, F.posexplode("_centres").alias("cluster", "_c")).select(*keys, "cluster", *[F.col("_c")[f].alias(f"_c_{f}") for f in features])


def assign_clusters(df: DataFrame, centres: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Nearest centre of every clear pixel; the handful of centres of a scene travels as one array."""
    packed = centres.groupBy(*keys).agg(F.collect_list(F.struct("cluster", *[f"_c_{f}" for f in features])).alias("_centres"))
    def far(c):
        return sum(((F.col(f) - c[f"_c_{f}"]) * (F.col(f) - c[f"_c_{f}"]) for f in features), F.lit(0.0))
    nearest = F.array_min(F.transform("_centres", lambda c: F.struct(far(c).alias("d"), c["cluster"].alias("cluster"))))
    clear = F.lit(True)
    for f in features:
        clear = clear & F.col(f).isNotNull()
    return df.join(packed, list(keys), "left").withColumn("cluster", F.when(clear, nearest["cluster"])).drop("_centres")


def water_cluster(df: DataFrame, keys: Sequence[str], index: str = "mbwi") -> DataFrame:
    """Per scene, the cluster with the highest mean index (the lowest number on a tie)."""
    means = df.where(F.col("cluster").isNotNull()).groupBy(*keys, "cluster").agg(F.avg(index).alias("_mean"))
    return means.groupBy(*keys).agg(F.max_by("cluster", F.struct("_mean", -F.col("cluster"))).alias("water_cluster"))


def classify_water(df: DataFrame, keys: Sequence[str], features: Sequence[str], area: Column) -> DataFrame:
    """``water`` per pixel from unsupervised clusters, for scenes below the cloud limit; NULL elsewhere.

    The few centres of each scene are written once, because they are used more than once; the pixels are read again.
    """
    clear = F.col(features[0]).isNotNull()
    share = df.groupBy(*keys).agg((F.sum(F.when(~clear, area).otherwise(0.0)) * 100 / F.sum(area)).alias("_cp"))
    usable = df.join(share.where(F.col("_cp") < CLOUD_LIMIT).select(*keys), list(keys), "left_semi")
    centres = cut_lineage(cluster_centres(usable, keys, features))
    # A scene has centres only when it is usable, so the others stay unlabelled.
    labelled = assign_clusters(df, centres, keys, features)
    top = water_cluster(labelled, keys)
    return labelled.join(top, list(keys), "left").withColumn("water", F.col("cluster") == F.col("water_cluster"))


# --- radar ----------------------------------------------------------------------------------

def _tiles(df: DataFrame, keys: Sequence[str], radius: int) -> DataFrame:
    """Each pixel in the tile (``_tx``, ``_ty``) that holds it and in those that its disc reaches, tile after tile in a task."""
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - radius) / TILE), F.floor((F.col(c) + radius) / TILE)))
    places = [*keys, "_tx", "_ty"]
    return df.withColumn("_tx", span("x")).withColumn("_ty", span("y")).repartition(*places).sortWithinPartitions(*places)


def _places(table, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For the pixels of some tiles: a number for tile, row and x, whether the tile holds the pixel, and how far rows lie apart.

    Rows and tiles are far enough apart that a disc meets its own tile only.
    """
    column = lambda name: table[name].to_numpy().astype(np.int64)
    tile = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
    x, y = column("x") - column("_tx") * TILE, column("y") - column("_ty") * TILE
    wide = TILE + 4 * radius
    return (tile * wide + y + 2 * radius) * wide + x + 2 * radius, (x >= 0) & (x < TILE) & (y >= 0) & (y < TILE), wide


def _disc_best(place: np.ndarray, value: np.ndarray, wide: int, radius: int) -> np.ndarray:
    """Highest value (NaN above all) within ``radius`` of each place; NULL, which counts for nothing, is masked."""
    order = np.flatnonzero(~np.ma.getmaskarray(value))
    order = order[np.argsort(place[order], kind="stable")]
    source, high = place[order], np.ma.getdata(value)[order]
    best, seen = np.full(len(place), -np.inf), np.zeros(len(place), bool)
    for dy in range(-radius, radius + 1):
        half = int((radius * radius - dy * dy) ** 0.5)
        at, last = (np.searchsorted(source, place + dy * wide + side * half, "left" if side < 0 else "right") for side in (-1, 1))
        rows = np.flatnonzero(at < last)
        while len(rows):
            best[rows] = np.maximum(best[rows], high[at[rows]])
            seen[rows] = True
            at[rows] += 1
            rows = rows[at[rows] < last[rows]]
    return np.ma.array(best, mask=~seen)


def _masked(column) -> np.ma.MaskedArray:
    return np.ma.array(column.fill_null(0.0).to_numpy(), mask=column.is_null().to_numpy())


def disc_max(df: DataFrame, keys: Sequence[str], value: str, radius: int, out: str) -> DataFrame:
    """Highest value within ``radius`` pixels of each pixel (a disc), as a double. Pixels without a place are left out.

    Pixels meet in tiles, with a rim as wide as the radius; a task takes whole tiles one after another.
    """
    names, schema = df.columns, df.withColumn(out, F.lit(None).cast("double")).schema

    def largest(batches):
        import pyarrow as pa

        for table, starts in _whole_runs(batches, [*keys, "_tx", "_ty"]):
            place, own, wide = _places(table, starts, radius)
            best = pa.array(_disc_best(place, _masked(table["_v"]), wide, radius))
            yield from table.select(names).append_column(out, best).filter(pa.array(own)).to_batches()

    placed = df.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("_v", F.col(value).cast("double"))
    return _tiles(placed, keys, radius).mapInArrow(largest, schema)


def sar_water_area(images: DataFrame, keys: Sequence[str], image: str, radius: int = 3) -> DataFrame:
    """Water area per composite from radar images with vv and angle per pixel.

    Angle screen, disc maximum per image, median over the images of the composite, and the count
    of pixels in the water range. Composites without usable pixels keep a row with NULL. A tile
    meets in one place with all images of the composite; only its count of water leaves it.
    """
    low, high = SAR_ANGLES
    usable = images.where((F.col("angle") > low) & (F.col("angle") < high) & F.col("vv").isNotNull())
    pix = usable.where(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy(*keys, image, "x", "y").agg(F.max("vv").cast("double").alias("_v"))
    places = [*keys, "_tx", "_ty"]

    def water(batches):
        import pyarrow as pa

        for table, starts in _whole_runs(batches, places):
            place, own, wide = _places(table, starts, radius)
            codes = table[image].combine_chunks().dictionary_encode("encode").indices.to_numpy().astype(np.int64)
            smooth = np.ma.getdata(_disc_best(codes * (place.max() + wide * wide) + place, _masked(table["_v"]), wide, radius))[own]
            order = np.lexsort((smooth, place[own]))
            pixel, smooth = place[own][order], smooth[order]
            first = np.flatnonzero(np.r_[True, pixel[1:] != pixel[:-1]][:len(pixel)])
            n = np.diff(np.append(first, len(pixel)))
            low, high = smooth[first + (n - 1) // 2], smooth[first + n // 2]
            median = np.where(low == high, low, 0.5 * low + 0.5 * high)
            tile, held = np.unique(pixel[first] // (wide * wide), return_inverse=True)
            counts = np.bincount(held, (median > SAR_WATER[0]) & (median < SAR_WATER[1]), len(tile)).astype(np.int64)
            yield from table.select(list(keys)).take(pa.array(starts[tile])).append_column("_n", pa.array(counts)).to_batches()

    schema = pix.select(*keys, F.lit(0).cast("long").alias("_n")).schema
    counted = _tiles(pix, keys, radius).mapInArrow(water, schema)
    area = counted.groupBy(*keys).agg((F.sum("_n") * F.lit(SAR_PIXEL_KM2)).alias("sarea"))
    return images.select(*keys).distinct().join(area, list(keys), "left")
