"""Grid and geometry joins. Every range or distance join goes through an equi-join on a tile."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import half_up_count, haversine_m, round_away
from lakeledger.operators.scale import block_join
from lakeledger.session import cut_lineage, drop_steps

METRES_PER_DEGREE = 111195.0


# --- grids ----------------------------------------------------------------------------------

def grid_cells(bounds: DataFrame, keys: Sequence[str], resolution: float = 0.0625) -> DataFrame:
    """Cell centres of each key's bounding box (xmin, ymin, xmax, ymax), rows from the top.

    The columns of a grid are dealt out before their rows are made, so that one large box is not one task."""
    nx = half_up_count((F.col("xmax") - F.col("xmin")) / resolution).cast("int")
    ny = half_up_count((F.col("ymax") - F.col("ymin")) / resolution).cast("int")
    cols = (bounds.withColumn("_nx", nx).withColumn("_ny", ny).where((F.col("_nx") > 0) & (F.col("_ny") > 0))
            .withColumn("col", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1))))
    rows = cols.repartition(*keys, "col").withColumn("row", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1)))
    return rows.select(*keys, "row", "col",
                       F.round(F.col("xmin") + (F.col("col") + 0.5) * resolution, 5).alias("lon"),
                       F.round(F.col("ymax") - (F.col("row") + 0.5) * resolution, 5).alias("lat"))


def row_col(lon: Column, lat: Column, west: float, north: float, size: float, rows: int) -> tuple[Column, Column]:
    """Grid row counted from the bottom and column counted from one."""
    top = F.floor((F.lit(north) - lat) / size).cast("int")
    return F.lit(rows) - top, F.floor((lon - F.lit(west)) / size).cast("int") + 1


#: A tile is cut into four by four until it holds at most LEAF places, at most DEPTH times.
LEAF, DEPTH = 32, 12
FEW_TILES = 1 << 16  # of one step; so many travel to the tasks
ROUNDING = 1e-11  # of squared distances: what is nearer by less is settled by the rounded distances of the places


def _tile_id(kx: Column, ky: Column, level: Column | int) -> Column:
    """One number for a tile, from the places of its cells at the greatest depth."""
    shift = (F.lit(DEPTH) - level) * 2
    step = F.pow(F.lit(2.0), shift).cast("long")
    return (F.lit(level) if isinstance(level, int) else level).cast("long") * (1 << 48) + F.floor(kx / step) * (1 << 24) + F.floor(ky / step)


def _tile_tree(centres: DataFrame, leaf: int) -> tuple[DataFrame, DataFrame, list[tuple[int, int, int]]]:
    """``centres(_cx, _cy, ...)``, one row a place, as (places with ``_kx, _ky``; tiles; levels).

    A tile ``_id`` of ``_level`` carries its ``_parent``, the box of its places and whether it is a ``_leaf``. Levels are
    (level, tiles that have been reached by then, leaves of that level): a few numbers, by which joins are planned."""
    box = centres.agg(F.min("_cx"), F.max("_cx"), F.min("_cy"), F.max("_cy")).first()
    span = max(box[1] - box[0], box[3] - box[2]) or 1.0
    width = 1 << 2 * DEPTH
    place = lambda c, low: F.least(F.floor((F.col(c) - low) / span * width), F.lit(width - 1)).cast("long")
    places = cut_lineage(centres.withColumn("_kx", place("_cx", box[0])).withColumn("_ky", place("_cy", box[2])))
    counted = (places.select("_cx", "_cy", "_kx", "_ky", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("_level"))
               .select("_level", "_cx", "_cy", _tile_id(F.col("_kx"), F.col("_ky"), F.col("_level")).alias("_id"),
                       F.when(F.col("_level") > 0, _tile_id(F.col("_kx"), F.col("_ky"), F.greatest(F.col("_level") - 1, F.lit(0)))).alias("_parent"))
               .groupBy("_level", "_id", "_parent").agg(F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"_{n}{c[2]}") for c in ("_cx", "_cy") for n, f in (("low", F.min), ("high", F.max))]))
    counted = cut_lineage(counted)
    cut = counted.where((F.col("_n") > leaf) & (F.col("_level") < DEPTH)).select(F.col("_id").alias("_parent"))
    kept = counted.where("_level = 0").unionByName(counted.where("_level > 0").join(cut, "_parent", "left_semi").select(counted.columns))
    tiles = cut_lineage(kept.withColumn("_leaf", (F.col("_n") <= leaf) | (F.col("_level") == DEPTH)))
    drop_steps(counted)
    levels, before = [], 0
    for r in tiles.groupBy("_level").agg(F.count(F.lit(1)).alias("n"), F.count_if("_leaf").alias("leaves")).orderBy("_level").collect():
        levels.append((r["_level"], before + r["n"], r["leaves"]))
        before += r["leaves"]
    return places, tiles, levels


def _bounds(x: Column, y: Column, side: Callable[[str], Column]) -> tuple[Column, Column]:
    """Least squared distance to a tile's box, and one that some place of the tile does not exceed: each side of the box
    holds a place, so that the nearer side in one direction and the farther corner in the other bound it."""
    low = lambda c, n: F.greatest(side(f"_low{n}") - c, c - side(f"_high{n}"), F.lit(0.0))
    near = lambda c, n: F.least(F.abs(c - side(f"_low{n}")), F.abs(c - side(f"_high{n}")))
    far = lambda c, n: F.greatest(F.abs(c - side(f"_low{n}")), F.abs(c - side(f"_high{n}")))
    square = lambda c: c * c
    least = square(low(x, "x")) + square(low(y, "y"))
    return least, F.least(square(near(x, "x")) + square(far(y, "y")), square(far(x, "x")) + square(near(y, "y")))


def opened_tiles(tiles: DataFrame, level: int) -> DataFrame:
    """``_from, _tiles``: what a tile is opened to at that level, as one row; a leaf above it stays what it is."""
    tile = F.struct("_id", "_lowx", "_highx", "_lowy", "_highy")
    inner = tiles.where(F.col("_level") == level).groupBy(F.col("_parent").alias("_from")).agg(F.collect_list(tile).alias("_tiles"))
    return inner.unionByName(tiles.where((F.col("_level") < level) & F.col("_leaf")).select(F.col("_id").alias("_from"), F.array(tile).alias("_tiles")))


def candidate_tiles(points: DataFrame, tiles: DataFrame, levels: list[tuple[int, int, int]], ident: Sequence[str]) -> DataFrame:
    """The leaves that may hold the place nearest to each of ``points(ident, _x, _y)``, as rows (ident, _x, _y, _id).

    All points go down the tree together. A step opens the tiles that are left and keeps, for each point, those whose
    least distance does not exceed what some tile is sure to hold. So a point opens a handful of tiles a step, and steps
    grow with the logarithm of the places. What a tile is opened to is sifted in its row, by itself and by the bound the point
    brings along, before the rows of a point are put side by side. The top of the tree travels to the tasks: all points ask
    for it. Below it, points meet tiles in blocks (``block_join``), because very many may lie in one tile.
    """
    frontier = points.withColumn("_id", F.lit(0).cast("long")).withColumn("_best", F.lit(float("inf")))
    near = lambda t, best: F.filter(t, lambda v: v["least"] <= best * (1 + 1e-9) + ROUNDING)
    for level, reached, _ in levels[1:]:
        opened, few = opened_tiles(tiles, level), reached <= FEW_TILES
        here = frontier.withColumnRenamed("_id", "_from")
        step = here.join(F.broadcast(opened), "_from") if few else block_join(cut_lineage(here), cut_lineage(opened), ["_from"])
        bound = lambda t: F.struct(t["_id"].alias("_id"), *[c.alias(n) for n, c in zip(("least", "sure"), _bounds(F.col("_x"), F.col("_y"), lambda n: t[n]), strict=True)])
        step = step.select(*ident, "_x", "_y", "_best", F.transform("_tiles", bound).alias("_tiles"))
        step = step.withColumn("_best", F.least("_best", F.array_min(F.transform("_tiles", lambda v: v["sure"]))))
        step = step.withColumn("_tiles", F.transform(near(F.col("_tiles"), F.col("_best")), lambda v: F.struct(v["_id"].alias("_id"), v["least"].alias("least"))))
        step = step.withColumn("_best", F.min("_best").over(Window.partitionBy(*ident)))
        frontier = step.select(*ident, "_x", "_y", "_best", F.explode(near(F.col("_tiles"), F.col("_best"))["_id"]).alias("_id"))
    return frontier.select(*ident, "_x", "_y", "_id")


def nearest_cell(points: DataFrame, cells: DataFrame, ident: Sequence[str], x: str, y: str, cell_x: str, cell_y: str,
                 leaf: int = LEAF) -> DataFrame:
    """Every point with the columns of the cell whose centre is nearest; ties go to the lower x, then the lower y, and of
    cells with the same centre to the lowest in its other columns.

    ``ident`` tells points apart. Cells are put into a tree of tiles, each with the box of its cells, and points go down
    it by bounds (``candidate_tiles``), wherever they lie and however the cells are spread; only the cells of the leaves
    that are left are compared, in the row of their leaf, so that a leaf gives a point one row. Points with a NULL or NaN coordinate get no cell, and there is none in an empty table.
    """
    known = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull() & ~F.isnan(F.col(a).cast("double")) & ~F.isnan(F.col(b).cast("double"))
    ident, values = list(ident), [c for c in cells.columns if c not in (cell_x, cell_y)]
    centres = (cells.where(known(cell_x, cell_y)).select(F.col(cell_x).cast("double").alias("_cx"), F.col(cell_y).cast("double").alias("_cy"), F.struct(*cells.columns).alias("_cell"))
               .groupBy("_cx", "_cy").agg(F.min("_cell").alias("_cell")))
    left = points.where(known(x, y)).select(*ident, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).distinct()
    if cells.where(known(cell_x, cell_y)).isEmpty():
        found = left.select(*ident, F.lit(None).cast(centres.schema["_cell"].dataType).alias("_cell"))
    else:
        places, tiles, levels = _tile_tree(centres, leaf)
        ends = [level for level, _, leaves in levels if leaves]
        # A leaf of the least width may hold more than its share: it is several rows.
        leaves = tiles.where("_leaf").select("_id", F.ceil(F.col("_n") / leaf).alias("_pieces"))
        held = (places.select("_cx", "_cy", "_cell", F.explode(F.array(*[_tile_id(F.col("_kx"), F.col("_ky"), level) for level in ends])).alias("_id"))
                .join(leaves, "_id").groupBy("_id", F.pmod(F.xxhash64("_cx", "_cy"), F.col("_pieces")).alias("_piece")).agg(F.collect_list(F.struct("_cx", "_cy", "_cell")).alias("_places"))
                .drop("_piece"))
        square = lambda c: (c["_cx"] - F.col("_x")) * (c["_cx"] - F.col("_x")) + (c["_cy"] - F.col("_y")) * (c["_cy"] - F.col("_y"))
        first = F.array_min(F.transform("_places", lambda c: F.struct(F.round(square(c), 12).alias("d"), c["_cx"].alias("_cx"), c["_cy"].alias("_cy"), c["_cell"].alias("_cell"))))
        asked = candidate_tiles(left, tiles, levels, ident)
        few = levels[-1][1] * leaf <= FEW_TILES
        met = asked.join(F.broadcast(held), "_id") if few else block_join(cut_lineage(asked), cut_lineage(held), ["_id"])
        found = met.select(*ident, first.alias("_first")).groupBy(*ident).agg(F.min("_first")["_cell"].alias("_cell"))
    return points.join(found, ident, "left").select(*points.columns, *[F.col("_cell")[c].alias(c) for c in (cell_x, cell_y, *values)])


def regrid(cells: DataFrame, keys: Sequence[str], values: Sequence[str], lon: str, lat: str, resolution: float,
           bounds: tuple[float, float, float, float]) -> DataFrame:
    """Nearest source cell of every target cell of a finer or coarser grid inside the bounds, for all ``keys``.

    The source whose centre is nearest to the target's wins; ties go to the lower longitude, then latitude. The
    search is made once for the distinct source places, and sources outside the bounds take part. ``cell_x`` and ``cell_y`` count target cells from the lower left.
    """
    spark = cells.sparkSession
    xmin, ymin, xmax, ymax = map(float, bounds)
    box = spark.createDataFrame([(xmin, ymin, xmax, ymax)], "xmin double, ymin double, xmax double, ymax double")
    ny = half_up_count((F.lit(ymax) - ymin) / resolution).cast("int")
    targets = grid_cells(box, [], resolution).select(F.col("col").alias("cell_x"), (ny - 1 - F.col("row")).cast("int").alias("cell_y"))
    targets = targets.withColumn("_tx", xmin + (F.col("cell_x") + 0.5) * resolution).withColumn("_ty", ymin + (F.col("cell_y") + 0.5) * resolution)
    places = cells.select(lon, lat).distinct()
    near = nearest_cell(targets, places, ["cell_x", "cell_y"], "_tx", "_ty", lon, lat)
    return cells.join(near.select("cell_x", "cell_y", lon, lat), [lon, lat]).select(*keys, "cell_x", "cell_y", *values)


def bilinear(points: DataFrame, grid: DataFrame, x: str, y: str, i: str, j: str, value: str, out: str,
             origin: tuple[float, float], size: tuple[float, float], shape: tuple[int, int]) -> DataFrame:
    """Bilinear value of a regular grid; points outside take the value at the edge.

    Grid points are first turned into cells that carry their four corners, so that each point
    needs one equi-join.
    """
    corners = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    spread = grid.withColumn("_s", corners).select(
        (F.col(i) - F.col("_s.a")).alias("_i"), (F.col(j) - F.col("_s.b")).alias("_j"),
        (F.col("_s.a") * 2 + F.col("_s.b")).alias("_k"), F.col(value).cast("double").alias("_v"))
    cells = spread.groupBy("_i", "_j").agg(*[F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(f"_c{k}") for k in range(4)])
    clamp = lambda c, n: F.least(F.greatest(c, F.lit(0.0)), F.lit(float(n - 1)))
    at = (points.withColumn("_gx", clamp((F.col(x) - origin[0]) / size[0], shape[0]))
          .withColumn("_gy", clamp((F.col(y) - origin[1]) / size[1], shape[1])))
    at = (at.withColumn("_i", F.least(F.floor("_gx"), F.lit(shape[0] - 2)).cast("int"))
          .withColumn("_j", F.least(F.floor("_gy"), F.lit(shape[1] - 2)).cast("int")))
    u, v = F.col("_gx") - F.col("_i"), F.col("_gy") - F.col("_j")
    joined = at.join(cells, ["_i", "_j"], "left")
    value_ = ((1 - u) * (1 - v) * F.col("_c0") + (1 - u) * v * F.col("_c1") + u * (1 - v) * F.col("_c2") + u * v * F.col("_c3"))
    return joined.select(*points.columns, value_.alias(out))


# --- polygons -------------------------------------------------------------------------------

def _tiles(low: Column, high: Column, size: float) -> Column:
    return F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))


def polygon_boxes(edges: DataFrame, ident: str = "id") -> DataFrame:
    return edges.groupBy(ident).agg(
        F.least(F.min("x1"), F.min("x2")).alias("xmin"), F.least(F.min("y1"), F.min("y2")).alias("ymin"),
        F.greatest(F.max("x1"), F.max("x2")).alias("xmax"), F.greatest(F.max("y1"), F.max("y2")).alias("ymax"))


def _box_rows(edges: DataFrame, ident: str) -> DataFrame:
    """The box of each polygon, the number of rows it is cut into, about the square root of its edges, and their height."""
    many = edges.groupBy(ident).agg(F.ceil(F.sqrt(F.count(F.lit(1)))).alias("_rows"))
    return polygon_boxes(edges, ident).join(many, ident).withColumn("_high", (F.col("ymax") - F.col("ymin")) / F.col("_rows"))


def _row_of(y: Column) -> Column:
    """The row of a polygon that a height lies in; those outside its box belong to the first and the last."""
    row = F.least(F.floor((y - F.col("ymin")) / F.col("_high")), F.col("_rows") - 1)
    return F.when(F.col("_high") > 0, F.greatest(row, F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))


def _edge_rows(edges: DataFrame, boxes: DataFrame, ident: str) -> DataFrame:
    """Each edge in the rows of its polygon that it touches."""
    return (edges.join(boxes.select(ident, "ymin", "_high", "_rows"), ident)
            .select(ident, "x1", "y1", "x2", "y2", F.explode(F.sequence(_row_of(F.least("y1", "y2")), _row_of(F.greatest("y1", "y2")))).alias("_row")))


def _tiled_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes in the tiles they touch, of the least power of two that is as wide as they are: four tiles at most, however
    large a box is, and as many boxes in a tile as lie one above the other, but for a few."""
    wide = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(1e-9))
    width = F.pow(F.lit(2.0), F.ceil(F.log2(wide)))
    tiles = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / F.col("_width")), F.floor(F.col(high) / F.col("_width"))))
    return boxes.withColumn("_width", width).withColumn("_tx", tiles("xmin", "xmax")).withColumn("_ty", tiles("ymin", "ymax"))


def _widths(boxes: DataFrame) -> Column:
    """The widths of tiles that are in use: powers of two, so that there are few."""
    return F.array(*[F.lit(r[0]) for r in boxes.select("_width").distinct().collect()]).cast("array<double>")


def points_in_polygons(points: DataFrame, edges: DataFrame, point: str, x: str = "x", y: str = "y", ident: str = "id") -> DataFrame:
    """Pairs (point, polygon) with the point inside, by counting edge crossings of a ray to the right.

    Points first meet the boxes of polygons, in tiles as wide as the boxes, so that a point meets about as many boxes as it
    lies in, however many polygons there are in one place. A polygon of n edges is cut into about the square root of n rows of its
    own, and a point only meets the edges in its row of that polygon. A horizontal edge never crosses.
    """
    boxes = _box_rows(edges, ident).where(F.col("_high") > 0)
    rows = _edge_rows(edges.where(F.col("y1") != F.col("y2")), boxes, ident)
    tiled = _tiled_boxes(boxes)
    pts = (points.select(point, F.col(x).alias("_x"), F.col(y).alias("_y")).withColumn("_width", F.explode(_widths(tiled)))
           .withColumn("_tx", F.floor(F.col("_x") / F.col("_width"))).withColumn("_ty", F.floor(F.col("_y") / F.col("_width"))))
    inside = F.col("_x").between(F.col("xmin"), F.col("xmax")) & F.col("_y").between(F.col("ymin"), F.col("ymax"))
    near = pts.join(tiled, ["_width", "_tx", "_ty"]).where(inside).select(point, ident, "_x", "_y", _row_of(F.col("_y")).alias("_row"))
    spans = (F.col("y1") > F.col("_y")) != (F.col("y2") > F.col("_y"))
    at = F.col("x1") + (F.col("_y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    hits = near.join(rows, [ident, "_row"]).where(spans & (F.col("_x") < at)).groupBy(point, ident).agg(F.count(F.lit(1)).alias("_n"))
    return hits.where(F.col("_n") % 2 == 1).select(point, ident)


def centroids(edges: DataFrame, ident: str = "id") -> DataFrame:
    """Area centroid from the signed areas of the edges."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    s = edges.groupBy(ident).agg(F.sum(cross).alias("_a"), F.sum((F.col("x1") + F.col("x2")) * cross).alias("_x"),
                                 F.sum((F.col("y1") + F.col("y2")) * cross).alias("_y"))
    return s.select(ident, F.try_divide(F.col("_x"), F.col("_a") * 3).alias("cx"), F.try_divide(F.col("_y"), F.col("_a") * 3).alias("cy"))


def cells_of_polygons(cells: DataFrame, edges: DataFrame, cell: str, x: str, y: str, ident: str = "id") -> DataFrame:
    """Cells whose centre lies in a polygon; a polygon without any takes the cell nearest its centroid, wherever that is."""
    inside = points_in_polygons(cells, edges, cell, x, y, ident)
    empty = centroids(edges, ident).join(inside.select(ident).distinct(), ident, "left_anti")
    near = nearest_cell(empty, cells.select(x, y, cell), [ident], "cx", "cy", x, y).select(cell, ident)
    return inside.withColumn("method", F.lit("inside")).unionByName(near.withColumn("method", F.lit("nearest")))


def _path_tiles(segments: DataFrame, widths: Column) -> DataFrame:
    """Segments in the tiles of every width that they run through: column by column, the tiles of the part in it."""
    s = segments.withColumn("_width", F.explode(widths))
    column = lambda c: F.floor(F.col(c) / F.col("_width"))
    s = s.withColumn("_tx", F.explode(F.sequence(F.least(column("ax1"), column("ax2")), F.greatest(column("ax1"), column("ax2")))))
    rise = F.try_divide(F.col("ay2") - F.col("ay1"), F.col("ax2") - F.col("ax1"))
    # The part in the column, a little wider, so that rounding loses no tile.
    ends = [F.least(F.greatest((F.col("_tx") + k) * F.col("_width"), F.least("ax1", "ax2")), F.greatest("ax1", "ax2")) for k in (-1e-9, 1 + 1e-9)]
    at = [F.coalesce(F.col("ay1") + (e - F.col("ax1")) * rise, y) for e, y in zip(ends, (F.col("ay1"), F.col("ay2")), strict=True)]
    slack = F.col("_width") * 1e-6
    within = lambda v: F.least(F.greatest(v, F.least("ay1", "ay2")), F.greatest("ay1", "ay2"))
    low, high = within(F.least(*at) - slack), within(F.greatest(*at) + slack)
    return s.withColumn("_ty", F.explode(F.sequence(F.floor(low / F.col("_width")), F.floor(high / F.col("_width")))))


def track_crossings(tracks: DataFrame, edges: DataFrame, track: str = "track", ident: str = "id",
                    overrides: DataFrame | None = None) -> DataFrame:
    """Tracks that cross a polygon and the latitude range of the part inside it.

    ``tracks`` holds segments (x1, y1, x2, y2). The inside part is bounded by edge crossings and by
    segment ends inside the polygon. ``overrides`` (id, min_lat, max_lat) win where given. A segment meets the boxes of
    polygons in the tiles it runs through, which are as wide as the boxes, and then only the edges in the rows of a polygon
    that it passes.
    """
    boxes = _box_rows(edges, ident)
    tiled = _tiled_boxes(boxes)
    a = tracks.select(track, *[F.col(n).cast("double").alias(f"a{n}") for n in ("x1", "y1", "x2", "y2")]).distinct()
    low, high = F.least("ay1", "ay2"), F.greatest("ay1", "ay2")
    overlap = (F.least("ax1", "ax2") <= F.col("xmax")) & (F.greatest("ax1", "ax2") >= F.col("xmin")) & (low <= F.col("ymax")) & (high >= F.col("ymin"))
    near = (_path_tiles(a, _widths(tiled)).join(tiled, ["_width", "_tx", "_ty"]).where(overlap)
            .select(track, ident, "ax1", "ay1", "ax2", "ay2", "ymin", "_high", "_rows").distinct()
            .withColumn("_row", F.explode(F.sequence(_row_of(low), _row_of(high)))))
    named = {n: f"b{n}" for n in ("x1", "y1", "x2", "y2")}
    j = near.join(_edge_rows(edges, boxes, ident).withColumnsRenamed(named), [ident, "_row"])
    ax, ay = F.col("ax2") - F.col("ax1"), F.col("ay2") - F.col("ay1")
    bx, by = F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1")
    det = ax * by - ay * bx
    ox, oy = F.col("bx1") - F.col("ax1"), F.col("by1") - F.col("ay1")
    s, t = F.try_divide(ox * by - oy * bx, det), F.try_divide(ox * ay - oy * ax, det)
    cross = j.withColumn("_s", s).withColumn("_t", t).where(F.col("_s").between(0, 1) & F.col("_t").between(0, 1))
    at_cross = cross.select(track, ident, (F.col("ay1") + F.col("_s") * ay).alias("lat"))
    ends = tracks.select(track, F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")),
                                                  F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p"))
    ends = ends.select(track, F.col("p.x").alias("x"), F.col("p.y").alias("y")).distinct().withColumn("_end", F.struct(track, "x", "y"))
    within = points_in_polygons(ends, edges, "_end", "x", "y", ident)
    at_end = within.select(F.col("_end")[track].alias(track), ident, F.col("_end.y").alias("lat"))
    out = at_cross.unionByName(at_end).groupBy(track, ident).agg(
        round_away(F.min("lat"), 6).alias("min_lat"), round_away(F.max("lat"), 6).alias("max_lat"))
    if overrides is None:
        return out
    o = overrides.select(ident, F.col("min_lat").alias("_lo"), F.col("max_lat").alias("_hi"))
    return out.join(o, ident, "left").select(track, ident, F.coalesce("_lo", "min_lat").alias("min_lat"), F.coalesce("_hi", "max_lat").alias("max_lat"))


def within_distance(points: DataFrame, centres: DataFrame, centre: str, metres: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Pairs of points and centres at most ``metres`` apart on the sphere, also across the line of 180 degrees.

    Both sides meet in latitude-longitude tiles as wide as the distance at the highest latitude of
    the centre; the exact distance decides. Points and centres of a tile meet in blocks (``block_join``), because very
    many of both may lie in one place.
    """
    size = metres / METRES_PER_DEGREE
    c = centres.select(F.col(centre), F.col(lat).alias("_clat"), F.col(lon).alias("_clon"))
    reach = F.lit(size) / F.greatest(F.cos(F.radians(F.least(F.abs("_clat") + size, F.lit(89.0)))), F.lit(0.02))
    # A centre near the line also stands on its other side.
    c = c.withColumn("_reach", reach).withColumn("_at", F.explode(F.filter(F.array(F.col("_clon"), F.col("_clon") - 360, F.col("_clon") + 360),
                                                                            lambda v: (v >= -180 - F.col("_reach")) & (v <= 180 + F.col("_reach")))))
    c = (c.withColumn("_ty", F.explode(F.sequence(F.floor((F.col("_clat") - size) / size), F.floor((F.col("_clat") + size) / size))))
         .withColumn("_tx", F.explode(F.sequence(F.floor((F.col("_at") - F.col("_reach")) / size), F.floor((F.col("_at") + F.col("_reach")) / size)))))
    p = points.withColumn("_ty", F.floor(F.col(lat) / size)).withColumn("_tx", F.floor(F.col(lon) / size))
    d = haversine_m(F.col(lat), F.col(lon), F.col("_clat"), F.col("_clon"))
    return block_join(p, c, ["_ty", "_tx"]).withColumn("distance", d).where(F.col("distance") <= metres).drop("_ty", "_tx", "_clat", "_clon", "_at", "_reach")


def within_box(points: DataFrame, boxes: DataFrame, ident: str, margin: float = 0.1, lat: str = "lat", lon: str = "lon",
               tile: float = 1.0) -> DataFrame:
    """Pairs of points and boxes widened by ``margin`` degrees."""
    b = boxes.select(ident, (F.col("xmin") - margin).alias("_x0"), (F.col("xmax") + margin).alias("_x1"),
                     (F.col("ymin") - margin).alias("_y0"), (F.col("ymax") + margin).alias("_y1"))
    b = b.withColumn("_tx", _tiles(F.col("_x0"), F.col("_x1"), tile)).withColumn("_ty", _tiles(F.col("_y0"), F.col("_y1"), tile))
    p = points.withColumn("_tx", F.floor(F.col(lon) / tile)).withColumn("_ty", F.floor(F.col(lat) / tile))
    inside = F.col(lon).between(F.col("_x0"), F.col("_x1")) & F.col(lat).between(F.col("_y0"), F.col("_y1"))
    return p.join(b, ["_tx", "_ty"]).where(inside).select(*points.columns, ident)
