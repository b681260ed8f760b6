"""Near copies for a corpus: documents that share 0.8 of their five-word shingles, found by an exact similarity join
among the texts that SimHash fingerprints bring together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.components import connected_components
from lakeledger.llm.memory import released
from lakeledger.llm.simhash import join_labels
from lakeledger.session import cut_lineage, drop_steps

SHINGLE_WORDS = 5
SIMILARITY = (4, 5)  # shared shingles of all that two texts have: 0.8, as whole numbers
DISTANCE = 44  # of 128 bits; texts of similarity 0.8 differ in about 20, give or take 4, and exact similarity decides
TABLES, BITS = 64, 9  # each of its own bits of a fingerprint; texts of similarity 0.8 agree in 0.85 of them: in none of 64 tables with 7e-8
TILE = 1 << 16  # fingerprints of a bucket that are compared in one place
HELD = 1 << 16  # fingerprints that are compared at once
CROWD, LEADERS = 512, 16  # a bucket of more gets so many leaders first
GROWTH = 1.04  # of the edges between size classes
BROADCAST_BYTES = 32 << 20  # ids of at most this size travel to the tasks


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # of ASCII, as in simhash.fingerprint


def shingles(words: list[bytes], size: int = SHINGLE_WORDS) -> set[bytes]:
    if len(words) < size:
        return {b" ".join(words)}
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def similarity(a: set[bytes], b: set[bytes]) -> float:
    return len(a & b) / len(a | b)


def node_of(words: list[bytes]) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(b" ".join(words))


WORDS = 2 + TABLES * BITS // 64  # of a fingerprint: two are compared, those after them are cut into the tables' bits
DRAWS = np.random.default_rng(5).integers(1 << 63, size=WORDS, dtype=np.uint64) | np.uint64(1)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of ``WORDS`` times 64 bits over 128-bit hashes, (n, 2) numbers: bits that are set in over half of them."""
    ones = np.zeros(WORDS * 64, np.int64)
    for at in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
        x = hashes[at:at + 255]
        x = x[:, :1] * DRAWS + x[:, 1:]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)


def digest(text: str | None) -> tuple[int, int, int, int, np.ndarray]:
    """Hash of the words, number of shingles, the two numbers of the fingerprint that are compared, and a bucket for each table."""
    from xxhash import xxh3_128_digest

    words = words_of(text)
    hashes = np.frombuffer(b"".join(map(xxh3_128_digest, shingles(words))), np.uint64).reshape(-1, 2)
    print_ = fingerprint(hashes)
    bits = np.unpackbits(print_[2:].view(np.uint8), bitorder="little").reshape(TABLES, BITS)
    buckets = (bits @ (1 << np.arange(BITS))) + (np.arange(TABLES) << BITS)
    node, x, y = np.array([node_of(words), *print_[:2]], np.uint64).view(np.int64).tolist()
    return node, len(hashes), x, y, buckets.astype(np.int32)


def met(group: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For every row the first row of those it is connected with by links: to rows of its group whose sizes allow
    similarity, within ``DISTANCE`` bits. Rows are in order of group and size, so that a row meets the next ones only.

    Of a large group, a few leaders meet all others first; a row near one of them is linked. Only rows that are
    near none meet everything, so that copies of one text, however many, do not meet each other. Each row with a
    link in the group has one in the result.
    """
    p, q = SIMILARITY
    n = len(group)
    label, rows = np.arange(n), np.arange(n)
    if not n:
        return label
    number = np.cumsum(np.r_[False, group[1:] != group[:-1]])
    place = (number << 32) + size
    last = np.searchsorted(place, (number << 32) + size * q // p, "right")  # sizes from here on are too large
    heads = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    links, held = [], 0

    def near(a: np.ndarray, b: np.ndarray | slice) -> np.ndarray:
        return np.bitwise_count(x[a] ^ x[b]) + np.bitwise_count(y[a] ^ y[b]) <= DISTANCE

    def link(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal held
        links.append((a, b))
        held += len(a)
        if held > 2_000_000:
            close()

    def close() -> None:
        nonlocal held
        if links:
            join_labels(label, *(np.concatenate(side) for side in zip(*links, strict=True)))
        links.clear()
        held = 0

    small = np.ones(n, bool)
    for head, end in zip(heads, np.r_[heads[1:], n], strict=True):
        if end - head <= CROWD:
            continue
        small[head:end] = False
        # Rows below that a row may be similar to begin where its size is within their reach.
        first = head + np.searchsorted(last[head:end], rows[head:end], "right")
        open_ = rows[head:end]
        for k in range(LEADERS + 1):
            if not len(open_):
                break
            for lead in ([open_[len(open_) * k // LEADERS]] if k < LEADERS else open_):
                a = first[lead - head]
                found = a + np.flatnonzero(near(lead, slice(a, last[lead])))
                found = found[found != lead]
                if k == LEADERS:
                    found = found[:1]
                if len(found):
                    link(np.full(len(found), lead), found)
            if k < LEADERS:
                open_ = open_[~np.isin(open_, np.r_[found, lead])]
    rows, shift = rows[small], 1
    while True:
        rows = rows[rows + shift < last[rows]]
        if not len(rows):
            close()
            return label
        hit = rows[near(rows, rows + shift)]
        if len(hit):
            link(hit, hit + shift)
        shift += 1


def crowds(nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """``key, node``: texts that fingerprints bring together, from ``nodes(node, size, x, y, buckets)``. Texts that agree in a
    table's bits, and then within ``DISTANCE`` bits of the compared ones, are linked; what links connect in a bucket has one key.

    A bucket of more than ``tile`` fingerprints is cut into parts, each pair of which meets in a place of its own.
    """
    keyed = nodes.select("node", "size", "x", "y", F.explode("buckets").alias("key"))
    parts = F.ceil(F.col("n") / tile)
    hot = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile).select("key", parts.alias("parts"))
    one = F.lit(1).cast("long")
    tiled = (keyed.join(F.broadcast(hot), "key", "left").withColumn("parts", F.coalesce("parts", one))  # at most a row for each of the tables' buckets
             .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select("node", "size", "x", "y", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("g")))

    def solve(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        g, size, x, y, node = (rows[c].to_numpy() for c in ("g", "size", "x", "y", "node"))
        label = met(g, size, x.view(np.uint64), y.view(np.uint64))
        at = np.flatnonzero(np.bincount(label, minlength=len(label))[label] > 1)
        return pd.DataFrame({"g": g[at], "first": node[label[at]], "node": node[at]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            g = batch["g"].to_numpy()
            cut = int(np.searchsorted(g, g[-1])) if len(g) else 0
            if held and len(g) and n + cut >= HELD and (cut or g[0] != held[-1]["g"].iloc[-1]):
                yield solve([*held, batch.iloc[:cut]])
                held, n, batch = [], 0, batch.iloc[cut:]
            held.append(batch)
            n += len(batch)
        if held:
            yield solve(held)

    return (tiled.repartition("g").sortWithinPartitions("g", "size", "node").mapInPandas(released(compare), "g long, first long, node long")
            .select(F.xxhash64("g", "first").alias("key"), "node"))


def size_edges() -> list[int]:
    """Least sizes of the size classes."""
    edges = [1]
    while edges[-1] < 1 << 30:
        edges.append(max(edges[-1] + 1, int(edges[-1] * GROWTH)))
    return edges


EDGES = size_edges()


def size_class(size: Column) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, EDGES)), lambda e: e <= size)) - 1


def enough(shared: Column, a: Column, b: Column) -> Column:
    """Whether that many shared shingles make texts with a and b shingles similar."""
    p, q = SIMILARITY
    return shared * (p + q) >= (a + b) * p


def least_partner(size: Column) -> Column:
    """The fewest shingles that a similar text has."""
    p, q = SIMILARITY
    return F.ceil(size * p / F.lit(q)).cast("long")


def prefix(size: Column, partner: Column) -> Column:
    """Of a text's shingles in an order common to all texts, how many first ones hold one that it shares with a similar
    text of at least ``partner`` shingles: all but the least overlap, and one more."""
    p, q = SIMILARITY
    return size - F.ceil((size + partner) * p / F.lit(p + q)).cast("long") + 1


def shingle_sets(rows: DataFrame, ids: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``node, shingles`` (hashes, distinct) of the rows with one of those ids."""
    from xxhash import xxh3_64_intdigest

    @F.pandas_udf("node long, shingles array<long>")
    def sets(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words = words_of(text)
            node = np.uint64(node_of(words)).astype(np.int64)
            out.append((node, np.unique(np.fromiter(map(xxh3_64_intdigest, shingles(words)), np.uint64).view(np.int64))))
        return pd.DataFrame(out, columns=["node", "shingles"])

    few = ids.count() * 8 <= broadcast_bytes
    return rows.join(F.broadcast(ids) if few else ids, "id", "left_semi").select(sets("text").alias("s")).select("s.*")


def profiles(sets: DataFrame) -> DataFrame:
    """``node, size, unique, first``: how many shingles a text has, how many of them no other text here has, and those of
    the others, rarest first, that stand in its longest prefix. Texts that share too few to be similar to any are left out.

    In the order of rarity the unshared shingles come first, so that they need not be moved to know where the others stand.
    """
    tokens = sets.select("node", F.size("shingles").cast("long").alias("size"), F.explode("shingles").alias("token"))
    shared = cut_lineage(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    own = tokens.join(shared, "token").groupBy("node", "size").agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("own"))
    placed = own.withColumn("unique", F.col("size") - F.size("own")).withColumn("reach", prefix(F.col("size"), least_partner(F.col("size"))) - F.col("unique"))
    return (placed.where("reach > 0")
            .select("node", "size", "unique", F.transform(F.slice("own", F.lit(1), F.col("reach").cast("int")), lambda t: t["token"]).alias("first")))


def possible(a: str, b: str) -> Column:
    """Whether two texts may be similar by their sizes, by how much they share with any text, and by their fingerprints."""
    col = lambda side, name: F.col(f"{side}.{name}")
    most = F.least(col(a, "size") - col(a, "unique"), col(b, "size") - col(b, "unique"))
    bits = sum(F.bit_count(col(a, c).bitwiseXOR(col(b, c))) for c in ("x", "y"))
    return enough(most, col(a, "size"), col(b, "size")) & (bits <= DISTANCE)


def to_centres(crowd: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) of each text of a bucket with the bucket's centre: the one whose shingles most are shared by others,
    which is the text that copies were edited from rather than one of them; then the one with the most copies."""
    members = crowd.join(known, "node").withColumn("rank", F.struct(F.col("unique") / F.col("size"), -F.col("copies"), F.col("node")))
    slim = ["node", "size", "unique", "x", "y"]
    centres = members.groupBy("key").agg(F.min(F.struct("rank", *[F.col(c) for c in slim])).alias("c")).select("key", *[F.col(f"c.{c}").alias(c) for c in slim])
    return (members.alias("m").join(centres.alias("c"), "key").where((F.col("m.node") != F.col("c.node")) & possible("m", "c"))
            .select(F.col("m.node").alias("a"), F.col("c.node").alias("b")).distinct())


def across(known: DataFrame) -> DataFrame:
    """All pairs (a, b) of texts in different parts that may be similar, from ``known(node, size, unique, first, x, y, part)``.

    Two similar texts share one of the shingles of both prefixes, which are shorter the larger the other text is: a text
    puts its prefix under the size classes of either, for each class a similar text can have. A shingle under which all
    texts are in one part gives nothing; else the texts outside its largest part meet the others.
    """
    n, class_of = F.col("size"), size_class
    edges = F.array(*map(F.lit, EDGES))
    p, q = SIMILARITY
    spread = (known.withColumn("class", class_of(n))
              .withColumn("other", F.explode(F.sequence(class_of(least_partner(n)), class_of(F.floor(n * q / F.lit(p))))))
              .withColumn("reach", prefix(n, F.greatest(F.element_at(edges, F.col("other") + 1).cast("long"), least_partner(n))) - F.col("unique"))
              .where("reach > 0")
              .select("node", "part", "size", "unique", F.least("class", "other").alias("low"), F.greatest("class", "other").alias("high"),
                      F.posexplode(F.slice("first", F.lit(1), F.col("reach").cast("int"))).alias("at", "token")))
    # What is left of a text from the shingle on bounds what two texts share, where it is the first that they do.
    rows = cut_lineage(spread.select("node", "part", F.col("size").cast("int").alias("size"), (F.col("size") - F.col("unique") - F.col("at")).cast("int").alias("left"),
                                     F.xxhash64("token", "low", "high").alias("g")))
    main = (rows.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("g")
            .agg(F.max(F.struct("n", "part"))["part"].alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts"))
    held = cut_lineage(rows.join(main, "g"))
    a, b = held.where("part != main").alias("a"), held.alias("b")
    fits = enough(F.least("a.left", "b.left"), F.col("a.size"), F.col("b.size"))
    met = (a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.part") != F.col("b.part")) & fits & ((F.col("b.part") == F.col("b.main")) | (F.col("a.node") < F.col("b.node"))))
           .select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct())
    slim = known.select("node", "size", "unique", "x", "y")
    pairs = cut_lineage(met.join(slim.alias("s"), F.col("a") == F.col("s.node")).join(slim.alias("t"), F.col("b") == F.col("t.node")).where(possible("s", "t")).select("a", "b"))
    drop_steps(rows, held)
    return pairs


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose texts have that similarity, by the shingles themselves."""
    left, right = (sets.select(F.col("node").alias(side), F.col("shingles").alias(name)) for side, name in (("a", "s"), ("b", "t")))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(enough(F.size(F.array_intersect("s", "t")), F.size("s"), F.size("t"))).select("a", "b").distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``node, id, component``: each distinct sequence of words, its least id and its class.

    Two texts are linked where at least ``SIMILARITY`` of their five-word shingles are shared. Texts take part that agree
    in the bits of one of ``TABLES`` tables of their SimHash fingerprints with a text within ``DISTANCE`` of 128 others
    (``crowds``). Their links to the centres of these crowds, verified, give first
    classes, which take in what a large group shares at once; links between classes are then found by an exact
    prefix-filtered join, verified, and close them. No pair within a class is looked for, so that the pairs
    do not grow with the square of a group. A null text counts as empty; an id that repeats ties its texts. Rows
    without an id are left out. Very long texts are arrays of their shingles' hashes; other columns do not matter.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    @F.pandas_udf("node long, size long, x long, y long, buckets array<int>")
    def digests(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([digest(t) for t in texts], columns=["node", "size", "x", "y", "buckets"])

    prints = cut_lineage(rows.select("id", digests("text").alias("d")).select("id", "d.*"))
    nodes = cut_lineage(prints.groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), *[F.min(c).alias(c) for c in ("size", "x", "y", "buckets")]))
    ends = prints.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a != z").select("id", "a")
    ties = cut_lineage(prints.join(ends, "id").select("a", F.col("node").alias("b")).distinct())
    crowd = cut_lineage(crowds(nodes))
    ids = cut_lineage(nodes.join(crowd.select("node").distinct(), "node", "left_semi").select("id").distinct())
    sets = cut_lineage(shingle_sets(rows, ids))
    known = cut_lineage(profiles(sets).join(nodes.select("node", "copies", "x", "y"), "node"))
    edges = cut_lineage(ties.unionByName(verified(to_centres(crowd, known), sets)))
    joined = lambda found, of: of.join(connected_components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = cut_lineage(joined(edges, known).withColumnRenamed("component", "part"))
    more = cut_lineage(verified(across(parts), sets))
    out = cut_lineage(joined(edges.unionByName(more), nodes.select("node", "id")))
    drop_steps(prints, nodes, ties, crowd, ids, sets, known, edges, parts, more)
    return out


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that are the first of their class, with all their columns; rows without an id stay, and of rows that
    repeat an id all stay if the id is the first of its class. An empty table gives an empty one."""
    firsts = classes(docs).groupBy("component").agg(F.min("id").alias("doc_id")).select("doc_id").distinct()
    return docs.join(firsts, "doc_id", "left_semi").unionByName(docs.where(F.col("doc_id").isNull()))
