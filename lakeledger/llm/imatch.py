"""I-Match fingerprints: hashes of the terms of a text that lie in a band of inverse document frequency, over several
random parts of that lexicon. Built-in functions only."""

from __future__ import annotations

import json
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import let
from lakeledger.session import cut_lineage

RAREST, COMMONEST = 2000, 50  # a term of the band is in at least one of 2000 documents and at most in one of 50
FAMILIES, LEVELS = 4, 8  # the subsets: the whole lexicon, then four times a random half of it, a half of that, and so on
SUBSETS = 1 + FAMILIES * LEVELS
HEX = 8  # digits of the hash of each subset
NOTHING = "0" * HEX  # for a subset without a term of the text
BROADCAST_BYTES = 32 << 20  # a lexicon of at most this size travels to the tasks; a larger one is joined by shuffles
BUCKET_CHARS = 8 << 20  # text of one bucket of neighbouring ids, about
MOST_BUCKETS = 1 << 16
GROUPS = ("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "16384")  # documents of a partition, gathered without a sort


def terms(text: Column) -> Column:
    """The distinct words of a text, as ASCII white space separates them."""
    return F.array_distinct(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))


def lexicon(docs: DataFrame, n: int, text: str = "text", rarest: int = RAREST, commonest: int = COMMONEST) -> DataFrame:
    """``term, mask`` of the terms that at least one of ``rarest`` and at most one of ``commonest`` of the ``n`` documents
    have. The mask is a hash of the term, with a byte for each family of subsets: a term is in the subset of a level if so
    many low bits of the byte are zero.

    All documents are counted, combined in each partition. A document has so many terms, and a term of the lexicon is in
    n / rarest documents at least, so there are at most ``rarest`` times as many terms as a document has on average."""
    counted = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return (counted.where((F.col("df") * rarest >= n) & (F.col("df") * commonest <= n))
            .select("term", F.conv(F.substring(F.md5("term"), 1, 2 * FAMILIES), 16, 10).cast("long").alias("mask")))


def pieces(found: Column, whole: Column) -> Column:
    """A hash for each subset of the lexicon from ``found``, the sorted (term, mask) of a text; without any term in the
    band, the hash ``whole`` of the text in every place. A subset is sifted from the one before it in its family."""
    hashed = lambda held: F.when(F.size(held) == 0, NOTHING).otherwise(F.substring(F.md5(F.array_join(F.transform(held, lambda t: t["term"]), " ")), 1, HEX))

    def family(f: int) -> Column:
        bits = F.array(*[F.lit(((1 << level) - 1) << 8 * f).cast("long") for level in range(1, LEVELS + 1)])
        start = F.struct(found.alias("held"), F.array().cast("array<string>").alias("out"))
        sift = lambda s, low: let(F.filter(s["held"], lambda t: t["mask"].bitwiseAND(low) == 0),
                                  lambda held: F.struct(held.alias("held"), F.array_append(s["out"], hashed(held)).alias("out")))
        return F.aggregate(bits, start, sift)["out"]

    return F.when(F.size(found) == 0, F.array_repeat(F.substring(whole, 1, HEX), SUBSETS)).otherwise(F.concat(F.array(hashed(found)), *map(family, range(FAMILIES))))


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets with a term of either text whose hashes agree, 0 to 1."""
    both = F.zip_with(a, b, lambda x, y: F.when((x == NOTHING) & (y == NOTHING), None).otherwise(F.when(x == y, 1).otherwise(0)))
    held = F.filter(both, lambda x: x.isNotNull())
    return F.aggregate(held, F.lit(0), lambda s, x: s + x).cast("double") / F.size(held)


def first_ids(rows: DataFrame, buckets: int) -> list[int]:
    """Ids at which buckets of neighbouring ids begin; a number of quantiles, the least id among them."""
    shares = [k / buckets for k in range(1, buckets)]
    at = rows.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares or [0.5], max(10_000, 20 * buckets)).alias("q")).first()
    return sorted({at["least"], *(at["q"] if buckets > 1 else [])}) if at["least"] is not None else []


def in_buckets(rows: DataFrame, firsts: list[int]) -> DataFrame:
    """Adds ``bucket``, and sends the first row of each bucket also to the one before it, as its ``guard``; the first
    bucket comes after the last one. The bucket is looked up among heads first, then in the part that begins there."""
    width = isqrt(len(firsts) - 1) + 1
    ids = lambda values: F.from_json(F.lit(json.dumps(values)), "array<bigint>")
    count = lambda values: F.size(F.filter(values, lambda f: f <= F.col("doc_id")))
    start = (count(ids(firsts[::width])) - 1) * width
    placed = rows.withColumn("part", start).withColumn("at", F.col("part") + count(F.slice(ids(firsts), F.col("part") + 1, width)) - 1)
    here = F.struct(F.col("at").alias("bucket"), F.lit(0).alias("guard"))
    before = F.struct(F.pmod(F.col("at") - 1, F.lit(len(firsts))).alias("bucket"), F.lit(1).alias("guard"))
    return (placed.withColumn("to", F.explode(F.when(F.get(ids(firsts), F.col("at")) == F.col("doc_id"), F.array(here, before)).otherwise(F.array(here))))
            .select("to.bucket", "to.guard", *rows.columns))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rarest: int = RAREST, commonest: int = COMMONEST,
                 broadcast_bytes: int = BROADCAST_BYTES, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Fingerprint of every text, and how like it are those of an edited text and of the next document.

    Terms are distinct words; those of the band (``lexicon``) are sorted, joined and hashed for each of 33 subsets of the
    lexicon. A fingerprint is the 33 hashes in hex, zeros for a subset without a term of the text; a text without any term
    of the band has the hash of its whole text in all places. Two fingerprints are like each other by the share of equal
    hashes among the subsets that one of them has a term in. In the edited text the last ``floor(n_chars / 2)``
    characters have been replaced by as many first ones of the next document by id (after the last, the first), or by all.

    Gives ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. A null text counts as
    empty. Rows without an id are left out; rows that repeat an id stand by the hash of their text, each with a row of the
    result, and the next one may be a copy. Other columns do not matter; an empty table gives an empty one.

    Texts are shuffled once, to buckets of neighbouring ids with about ``bucket_chars`` of text each, where the next
    document, the terms of a text and the next fingerprint are found without another exchange. The lexicon is a written
    table; it is broadcast up to ``broadcast_bytes``, else joined by shuffles.
    """
    spark = docs.sparkSession
    spark.conf.set(*GROUPS)
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    firsts = first_ids(rows, min(MOST_BUCKETS, ceil((size["chars"] or 0) / bucket_chars) + 1)) or [0]
    lex = cut_lineage(lexicon(rows, size["n"], rarest=rarest, commonest=commonest))
    lex_bytes = lex.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    lex = F.broadcast(lex) if lex_bytes <= broadcast_bytes else lex

    # A row's number tells copies apart; with its bucket and guard it stands for one text.
    keys, told = ["bucket", "guard", "row"], ["doc_id", "whole", "n_chars", "edited_sha256"]
    order = Window.partitionBy("bucket").orderBy("guard", "doc_id", "whole", "row")
    placed = in_buckets(rows.withColumns({"whole": F.sha2("text", 256), "row": F.monotonically_increasing_id()}), firsts)
    near = placed.repartition(len(firsts), "bucket").withColumn("next", F.lead("text").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = near.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)))
    # What is said once a text is computed before its terms are spread.
    both = F.array(*[F.struct(F.lit(k).alias("which"), terms(F.col(c)).alias("terms")) for k, c in enumerate(("text", "edited"))])
    spread = (edited.select(*keys, "doc_id", "whole", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.explode(both).alias("t"))
              .select(*keys, *told, "t.which", F.explode_outer("t.terms").alias("term")).join(lex, "term", "left"))
    kept = lambda which: F.sort_array(F.collect_list(F.when((F.col("which") == which) & F.col("mask").isNotNull(), F.struct("term", "mask"))))
    grouped = spread.groupBy(*keys).agg(*[F.first(c).alias(c) for c in told], kept(0).alias("own"), kept(1).alias("changed"))
    printed = grouped.select(*keys, *told, pieces(F.col("own"), F.col("whole")).alias("a"), pieces(F.col("changed"), F.col("edited_sha256")).alias("b"))
    return (printed.withColumn("c", F.lead("a").over(order)).where("guard = 0")
            .select(F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", F.array_join("a", "").alias("fingerprint"), F.array_join("b", "").alias("edited_fingerprint"),
                    likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next")))
