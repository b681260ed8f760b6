"""River networks of reservoirs: tracing, levels, and water balances along the flow."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import haversine_m
from lakeledger.operators.series import period_means, spread_totals, volumes
from lakeledger.operators.spatial import nearest_cell
from lakeledger.session import cut_lineage, scratch_table

# Flow-direction code -> (row step, column step), 1 = north, then clockwise.
STEPS = {1: (-1, 0), 2: (-1, 1), 3: (0, 1), 4: (1, 1), 5: (1, 0), 6: (1, -1), 7: (0, -1), 8: (-1, -1)}
ROUNDS_PER_TABLE = 4


# --- tracing --------------------------------------------------------------------------------

def trace_flow(cells: DataFrame, x: str = "x", y: str = "y", code: str = "code", is_dam: str = "is_dam",
               node: str = "node") -> DataFrame:
    """Edges from each dam to the first dam downstream.

    A walk ends at the next dam; it yields nothing when it leaves the grid, meets a cell without a
    direction or runs in a loop. Every cell first points to its neighbour; each round then replaces a
    pointer by the pointer it leads to, so that walks of any length need only the logarithm of the
    number of cells in rounds.
    """
    step = lambda i: F.coalesce(*[F.when(F.col(code) == c, F.lit(s[i])) for c, s in STEPS.items()])
    base = cells.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(is_dam).alias("dam"), F.col(node).alias("node"),
                        F.struct(F.col(x).alias("x"), F.col(y).alias("y")).alias("cell"),
                        F.struct((F.col(x) + step(1)).cast(cells.schema[x].dataType).alias("x"),
                                 (F.col(y) + step(0)).cast(cells.schema[y].dataType).alias("y")).alias("to"),
                        F.col(code).isNotNull().alias("flows"))
    known = base.select(F.col("cell").alias("to"), F.lit(True).alias("exists"), F.col("flows").alias("to_flows"), F.col("dam").alias("to_dam"))
    first = base.join(known, "to", "left")
    # A neighbour without a direction ends the walk there, even below a dam.
    alive = F.coalesce(F.col("flows") & F.col("exists") & F.col("to_flows"), F.lit(False))
    first = first.select("cell", "node", "dam", F.when(alive, F.col("to")).otherwise(F.lit(None)).alias("to"), "to_dam")
    walkers = first.where(F.col("dam") & F.col("to").isNotNull()).select(F.col("node").alias("src"), F.col("to"))
    # A pointer to a dam is settled. In each round an open pointer settles with its target, or leaps to where that
    # points; one whose target does neither has met a dead end. Settled cells are written once and leave, so that
    # later rounds only hold what is still open: after the logarithm of the cells, loops.
    firsts = first.select("cell", (F.col("dam") | F.coalesce("to_dam", F.lit(False))).alias("settled"), F.when(F.col("dam"), F.col("cell")).otherwise(F.col("to")).alias("to"))
    firsts = cut_lineage(firsts.where(F.col("to").isNotNull()))
    settled, jump = firsts.where("settled").drop("settled"), firsts.where("not settled").drop("settled")
    for _ in range(max(1, math.ceil(math.log2(max(cells.count(), 2))))):
        if jump.isEmpty():
            break
        known_ends = settled.select(F.col("cell").alias("to"), F.col("to").alias("_end"))
        onward = jump.select(F.col("cell").alias("to"), F.col("to").alias("_next"))
        step_ = jump.join(known_ends, "to", "left").join(onward, "to", "left")
        moved = cut_lineage(step_.select("cell", F.col("_end").isNotNull().alias("settled"), F.coalesce("_end", "_next").alias("to")).where(F.col("to").isNotNull()))
        settled = settled.unionByName(moved.where("settled").drop("settled"))
        jump = moved.where("not settled").drop("settled")
    dams = base.where("dam").select(F.col("cell").alias("_end"), F.col("node").alias("dst"))
    ended = walkers.join(settled.select(F.col("cell").alias("to"), F.col("to").alias("_end")), "to").select("src", "_end")
    return ended.join(dams, "_end").where(F.col("src") != F.col("dst")).select("src", "dst")


def edge_lengths(edges: DataFrame, nodes: DataFrame, node: str = "node", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Distance in metres between the two dams of every edge."""
    a = nodes.select(F.col(node).alias("src"), F.col(lat).alias("_la"), F.col(lon).alias("_oa"))
    b = nodes.select(F.col(node).alias("dst"), F.col(lat).alias("_lb"), F.col(lon).alias("_ob"))
    d = haversine_m(F.col("_la"), F.col("_oa"), F.col("_lb"), F.col("_ob"))
    return edges.join(a, "src").join(b, "dst").withColumn("length", d).drop("_la", "_oa", "_lb", "_ob")


def node_elevation(nodes: DataFrame, terrain: DataFrame, node: str = "node", x: str = "lon", y: str = "lat",
                   terrain_x: str = "x", terrain_y: str = "y", elevation: str = "elevation") -> DataFrame:
    """Nodes with the elevation of the terrain point nearest to each."""
    return nearest_cell(nodes, terrain.select(terrain_x, terrain_y, elevation), [node], x, y, terrain_x, terrain_y).drop(terrain_x, terrain_y)


def connected_nodes(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """Nodes that touch an edge."""
    ends = edges.select(F.col("src").alias(node)).unionByName(edges.select(F.col("dst").alias(node))).distinct()
    return nodes.join(ends, node, "left_semi")


def levels(nodes: DataFrame, edges: DataFrame, node: str = "node") -> tuple[DataFrame, int]:
    """Longest number of edges above each node, and the highest level.

    Nodes are peeled off from the headwaters: a node is placed when its last upstream node is placed, and a placed
    node is written once and leaves. A few rounds make one table. If nodes are left and none of them can be placed,
    the network holds a cycle and is rejected, however deep it is. Ends of edges that are no nodes are taken as nodes.
    """
    spark = nodes.sparkSession
    links = cut_lineage(edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct())
    ids = nodes.select(F.col(node).alias("node")).unionByName(links.select(F.explode(F.array("src", "dst")).alias("node"))).distinct()
    above = links.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("open"))
    state = ids.join(above, "node", "left").select("node", F.coalesce("open", F.lit(0)).alias("open"), F.lit(None).cast("int").alias("level"))
    root = scratch_table(spark, "levels")
    done_rounds, depth = 0, 0
    for batch in itertools.count():
        for k in range(done_rounds, done_rounds + ROUNDS_PER_TABLE):
            ready = F.col("level").isNull() & (F.col("open") == 0)
            state = state.withColumn("level", F.when(ready, F.lit(k)).otherwise(F.col("level")))
            below = links.join(state.where(F.col("level") == k).select(F.col("node").alias("src")), "src").groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("_n"))
            state = state.join(below, "node", "left").select("node", (F.col("open") - F.coalesce("_n", F.lit(0))).alias("open"), "level")
        done_rounds += ROUNDS_PER_TABLE
        state.withColumn("placed", F.col("level").isNotNull()).write.partitionBy("placed").parquet(f"{root}/batch={batch}")
        written = spark.read.schema(state.withColumn("placed", F.lit(True)).schema).parquet(f"{root}/batch={batch}")
        top, left = written.agg(F.max("level"), F.count_if(~F.col("placed"))).first()
        depth = depth if top is None else top
        if not left:
            break
        if top is None:
            raise ValueError("the network holds a cycle")
        state = written.where(~F.col("placed")).drop("placed")
    placed = spark.read.schema(written.schema).parquet(root).where("placed")
    return placed.select("node", "level"), depth


# --- forcings -------------------------------------------------------------------------------

def node_forcings(inflow: DataFrame, storage: DataFrame, nodes: DataFrame, frequency: str = "daily", date: str = "date") -> DataFrame:
    """Natural runoff and storage change per node and period, as volumes.

    Inflow is in m3 per day; storage changes are spread over the days they cover. The series name
    of a node links it to its tables.
    """
    i = inflow.join(nodes.select("node", "name"), "name").select("node", date, F.col("inflow").alias("natural"))
    s = spread_totals(storage.join(nodes.select("node", "name"), "name").select("node", date, F.col("ds").alias("storage_change")),
                      ["node"], "storage_change", date)
    both = i.join(s, ["node", date], "full")
    if frequency == "daily":
        return both.withColumn("dt", F.lit(1))
    return volumes(period_means(both, ["node"], ["natural", "storage_change"], frequency, date), ["natural", "storage_change"])


# --- balances -------------------------------------------------------------------------------

def _floor0(c: Column) -> Column:
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def upstream_sums(edges: DataFrame, state: DataFrame, values: Sequence[str], date: str = "date", lagged: bool = False) -> DataFrame:
    """Sums of upstream values per downstream node and date; NULL where any of them is NULL.

    ``lagged`` moves each value forward by the rounded travel time of its edge.
    """
    j = state.join(edges, state["node"] == edges["src"])
    when = F.date_add(F.col(date), F.expr("cast(bround(travel_time) as int)")) if lagged else F.col(date)
    n = F.count(F.lit(1))
    sums = [F.when(F.count(v) == n, F.sum(v)).alias(f"up_{v}") for v in values]
    return j.groupBy(F.col("dst").alias("node"), when.alias(date)).agg(n.alias("n_up"), *sums)


def observed_balance(edges: DataFrame, state: DataFrame, date: str = "date") -> DataFrame:
    """Balance of every node with observed outflow above it: one join, no iteration."""
    up = upstream_sums(edges, state.select("node", date, F.col("obs_outflow").alias("outflow"), "natural"), ["outflow", "natural"], date)
    j = state.join(up, ["node", date], "left")
    return _balance(j, date)


def _balance(j: DataFrame, date: str) -> DataFrame:
    has = F.col("n_up").isNotNull()
    regulated = F.when(has, F.col("up_outflow")).otherwise(F.lit(0.0))
    own = F.when(has, F.col("natural") - F.col("up_natural")).otherwise(F.col("natural"))
    out = j.withColumn("natural_runoff", own).withColumn("regulated_runoff", regulated)
    out = out.withColumn("inflow", _floor0(F.col("natural_runoff") + F.col("regulated_runoff")))
    out = out.withColumn("outflow", _floor0(F.col("inflow") - F.col("storage_change")))
    return out.withColumn("regulation", F.col("natural") - F.col("inflow")).drop("n_up", "up_outflow", "up_natural")


def _head_from(source: str):
    """Rule for dams without a dam above them."""
    def head(df: DataFrame) -> DataFrame:
        guess = _floor0(F.col("natural") - F.col("storage_change"))
        seen = _floor0(F.col("obs_inflow") - F.col("storage_change"))
        if source == "outflow":
            out = F.coalesce(F.col("obs_outflow"), seen, guess)
            inflow = out + F.col("storage_change")
        else:
            out = seen
            inflow = _floor0(out + F.col("storage_change"))
        df = df.withColumn("outflow", out).withColumn("inflow", inflow)
        return (df.withColumn("natural_runoff", F.col("natural")).withColumn("regulated_runoff", F.lit(0.0))
                .withColumn("regulation", F.col("natural") - F.col("inflow")))
    return head


def _null_max(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def contract(links: DataFrame, rules: DataFrame, known: DataFrame, date: str = "date", lagged: bool = True) -> DataFrame:
    """``node, date, x`` of every node of a network without cycles, where ``x = max(a, b + sum of x upstream)``.

    ``links(src, dst, lag)``: upstream values count ``lag`` days later, if ``lagged``. ``rules(node, date, a, b)`` are the nodes with links
    into them, ``known(node, date, x)`` the others. A NULL, or a row missing on a date that counts, makes ``x`` NULL.

    Such rules stay of this form when one is put into another, so the network is contracted: in each round the links from
    nodes that are known are added up into the rules they lead to, and a node with one link left from another such node
    takes over that one's rule, link and lag, which halves all chains at once. A node without a link left is known. So
    rounds grow with the logarithm of a chain, and of the nodes where each has one link down. Each round
    is a table of links and one of rules; every round of a network without a cycle makes some node known.
    """
    later = F.date_add if lagged else lambda when, days: when
    rules = cut_lineage(rules.select("node", date, "a", "b"))
    new, found = known.select("node", date, "x"), [known.select("node", date, "x")]
    while True:
        open_ = links.select(F.col("dst").alias("src")).distinct()
        ripe, rest = links.join(open_, "src", "left_anti"), links.join(open_, "src", "left_semi")
        single = rest.groupBy("dst").agg(F.count(F.lit(1)).alias("_n"), F.min("src").alias("src"), F.min("lag").alias("lag")).where("_n = 1").drop("_n")
        upper = single.select(F.col("dst").alias("via"), F.col("src").alias("_src"), F.col("lag").alias("_lag"))
        leaps = single.select("dst", F.col("src").alias("via"), "lag").join(upper, "via")
        counts = [df.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("n")) for k, df in enumerate((links, ripe, leaps))]
        size = dict(map(tuple, counts[0].unionByName(counts[1]).unionByName(counts[2]).collect()))
        if not size[0]:
            break
        if not size[1]:
            raise ValueError("the network holds a cycle")
        used = ripe.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("_used"))
        got = (ripe.join(new.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node"), later(F.col(date), F.col("lag")).alias(date))
               .agg(F.count("x").alias("_got"), F.sum("x").alias("_x")))
        step = rules.join(used, "node", "left").join(got, ["node", date], "left").select(
            "node", date, "a", F.when(F.col("_used").isNull(), F.col("b")).when(F.col("_got") == F.col("_used"), F.col("b") + F.col("_x")).alias("b"))
        after = rest.select("src", "dst", "lag")
        if size[2]:
            leaps = cut_lineage(leaps)
            after = after.join(leaps.select("dst", "_src", F.col("lag").alias("_own"), "_lag"), "dst", "left").select(
                F.coalesce("_src", "src").alias("src"), "dst", F.coalesce(F.col("_own") + F.col("_lag"), F.col("lag")).alias("lag"))
            above = step.select(F.col("node").alias("via"), F.col(date).alias("_when"), F.col("a").alias("_a"), F.col("b").alias("_b"))
            step = (step.join(leaps.select(F.col("dst").alias("node"), "via", "lag"), "node", "left").withColumn("_when", later(F.col(date), -F.col("lag")))
                    .join(above, ["via", "_when"], "left"))
            far = F.col("via").isNotNull()
            step = step.select("node", date, F.when(far, _null_max(F.col("a"), F.col("_a") + F.col("b"))).otherwise(F.col("a")).alias("a"),
                               F.when(far, F.col("_b") + F.col("b")).otherwise(F.col("b")).alias("b"))
        links = cut_lineage(after)
        step = cut_lineage(step.join(links.select(F.col("dst").alias("node")).distinct().withColumn("_open", F.lit(True)), "node", "left"))
        new = step.where(F.col("_open").isNull()).select("node", date, _null_max(F.col("a"), F.col("b")).alias("x"))
        found.append(new)
        rules = step.where("_open").drop("_open")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def balance(edges: DataFrame, state: DataFrame, algorithm: str = "wb", date: str = "date") -> DataFrame:
    """Water balance of every node and date from the headwaters down.

    state: node, date, natural (unregulated runoff), storage_change, and obs_outflow / obs_inflow
    where the algorithm needs them. Algorithms: ``wb``; ``wb_travel_time`` with upstream values
    taken a travel time earlier; ``wb_obs_outflow`` with observed outflow above each node;
    ``wb_obs_outflow_upstream`` and ``wb_obs_inflow_upstream`` with observations at head dams.

    Outflow is ``max(0, max(0, own + upstream) - storage change)``, which is ``max(a, b + upstream)`` with a = max(0, -storage
    change) and b = own - storage change; all outflows are found by ``contract``. One join of them along the edges then gives the balance.
    """
    known = ("wb", "wb_travel_time", "wb_obs_outflow", "wb_obs_outflow_upstream", "wb_obs_inflow_upstream")
    if algorithm not in known:
        raise ValueError(f"unknown algorithm {algorithm!r}; use one of {', '.join(known)}")
    if algorithm == "wb_obs_outflow":
        return observed_balance(edges, state, date)
    lagged = algorithm == "wb_travel_time"
    lag = F.expr("cast(bround(travel_time) as int)") if lagged else F.lit(0)
    links = cut_lineage(edges.where(F.col("src") != F.col("dst")).select("src", "dst", lag.alias("lag")))
    above = links.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n_edges"))

    def sums(values: DataFrame, name: str) -> DataFrame:
        """Upstream sums; NULL where a value is missing on a date."""
        got = (values.withColumnRenamed("node", "src").join(links, "src").groupBy(F.col("dst").alias("node"), (F.date_add(F.col(date), F.col("lag")) if lagged else F.col(date)).alias(date))
               .agg(F.count(name).alias("_got"), F.sum(name).cast("double").alias("_sum")).join(above, "node"))
        return got.select("node", date, F.when(F.col("_got") == F.col("n_edges"), F.col("_sum")).alias(f"up_{name}"))

    rows = state.join(above.withColumnRenamed("n_edges", "n_up"), "node", "left")
    rows = cut_lineage(rows.join(sums(state.select("node", date, "natural"), "natural"), ["node", date], "left"))
    heads = rows.where(F.col("n_up").isNull())
    rule = {"wb_obs_outflow_upstream": _head_from("outflow"), "wb_obs_inflow_upstream": _head_from("inflow")}.get(algorithm)
    heads = rule(heads) if rule else _balance(heads.withColumn("up_outflow", F.lit(None).cast("double")), date)
    change = F.col("storage_change")
    inner = rows.where(F.col("n_up").isNotNull())
    rules = inner.select("node", date, F.when(change.isNotNull(), F.greatest(-change, F.lit(0.0))).alias("a"), (F.col("natural") - F.col("up_natural") - change).alias("b"))
    outflow = contract(links, rules, heads.select("node", date, F.col("outflow").alias("x")), date, lagged)
    below = _balance(inner.join(sums(outflow.withColumnRenamed("x", "outflow"), "outflow"), ["node", date], "left"), date)
    keep = ["node", date, "natural", "storage_change", "natural_runoff", "regulated_runoff", "inflow", "outflow", "regulation"]
    return heads.select(*keep).unionByName(below.select(*keep))


def regulated_outputs(results: DataFrame, edges: DataFrame) -> DataFrame:
    """Results of the nodes that take part in the network."""
    return connected_nodes(results, edges)
