"""The queries on this subpackage's operators, and the SQL to check them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import bpe, checks, collisions, imatch, language, onebit, packing, periodic, phrases, pseudo_likelihood, simhash, suffixes, turn_repair, warc
from lakeledger.session import configure

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {
    "op2_phrase_automata": checks.PASSAGES, "op6_merged_transforms": checks.STRINGS,
    "op7_collision_counting": checks.LINKS, "op9_monolithic_warc": checks.RECORDS,
    "op11_run_length_repair": checks.REPAIRS, "op12_frequency_splitting": checks.RUNS,
    "op13_imatch_bands": checks.PRINTS,
}


def query(fn):
    """Register ``fn(table)``; ``table(name)`` reads a whole table."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_rotated_one_bit(table) -> DataFrame:
    """The five nearest of every fiftieth vector among all others."""
    return onebit.search(table("embeddings"), F.col("id") % 50 == 0, k=5)


@query
def op2_phrase_automata(table) -> DataFrame:
    """What is left of every document without passages of 50 words that an earlier one has."""
    return phrases.remove_repeats(table("documents"), digests=True)


@query
def op3_best_two_fit(table) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return packing.pack_documents(table("documents"), BYTE_VOCABULARY)


@query
def op4_tree_bpe(table) -> DataFrame:
    """Ids of every text, and what they decode to, as digests."""
    return bpe.encode_documents(table("documents"), WORD_VOCABULARY, digests=True)


@query
def op5_kneser_ney_language(table) -> DataFrame:
    """The language of every document."""
    return language.identify(table("documents"))


@query
def op6_merged_transforms(table) -> DataFrame:
    """What is left of every document without strings of 100 bytes that start earlier."""
    return suffixes.remove_repeats(table("documents"), digests=True)


@query
def op7_collision_counting(table) -> DataFrame:
    """Links, class and first of class of every vector, at a cosine of 0.9."""
    return collisions.near_duplicates(table("embeddings"))


@query
def op8_simhash_blocks(table) -> DataFrame:
    """Fingerprint and class of every document."""
    return simhash.near_duplicates(table("documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_monolithic_warc(table) -> DataFrame:
    """Every page through a monolithic archive, its normalised form and the index of that."""
    return warc.read_back(warc.archive(table("pages")))


@query
def op10_masked_pseudo_likelihood(table) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them."""
    return pseudo_likelihood.score_documents(table("documents"))


@query
def op11_run_length_repair(table) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation, a quarter of whose rows are damaged first."""
    return turn_repair.repair(turn_repair.damage(table("conversations")), copies="copies", digests=True)


@query
def op12_frequency_splitting(table) -> DataFrame:
    """Periodic runs of every document, a tenth of them with a looped tail, and what is left without the repeats."""
    return periodic.collapse_runs(table("documents"), alter=periodic.loop_tail, digests=True)


@query
def op13_imatch_bands(table) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness to each other and to the next one's."""
    return imatch.fingerprints(table("documents"))
