"""The pipeline's stages against plain versions, on the small documents."""

import brute

import corpus_pipeline
from lakeledger.llm import language

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs = documents
    columns = documents.columns
    rejected = {r["doc_id"] for r in language.identify(documents).where("rejected").collect()}
    after = corpus_pipeline.identify_language(spark, docs, FOLDER)
    rows = {r["doc_id"]: r for r in after.collect()}
    assert after.columns == columns and rows.keys() == {r["doc_id"] for r in documents.collect()} - rejected
    firsts = brute.first_of_similar([(d, r["text"]) for d, r in rows.items()])
    after = corpus_pipeline.drop_near_copies(spark, after, FOLDER)
    rows = {r["doc_id"]: r for r in after.collect()}
    assert after.columns == columns and rows.keys() == firsts
    plain = brute.strings([(d, r["text"]) for d, r in rows.items()])
    after = corpus_pipeline.drop_repeats(spark, after, FOLDER)
    left = {r["doc_id"]: r for r in after.collect()}
    assert after.columns == columns and left.keys() == {d for d, (n, gone, _, _) in plain.items() if gone < n or n == 0}
    for d, r in left.items():
        if plain[d][2] == 0:
            assert r["text"] == rows[d]["text"] and r["n_chars"] == rows[d]["n_chars"]
        elif all(len(c.encode()) == 1 for c in rows[d]["text"]):
            assert brute.sha(r["text"].encode()) == plain[d][3] and r["n_chars"] == len(r["text"])
    packed = corpus_pipeline.pack(spark, after, FOLDER).collect()
    want = brute.pieces([(d, r["text"]) for d, r in left.items()], __import__("public_tokenizers").path("byte_bpe_50k.json"))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packed} == want


def test_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert corpus_pipeline.run(spark, FOLDER).count() > 100
