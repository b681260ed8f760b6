"""The operators against plain versions of their contracts."""

import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeledger.llm import bpe, collisions, components, language, onebit, packing, phrases, simhash, suffixes, vocabulary, warc
from lakeledger.llm import pseudo_likelihood as pl

DOC = "doc_id long, text string"


def words(n, seed=0, size=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rng.integers(0, size, n))


SHARED, OTHER = words(60, 1), words(75, 2)
#: Shared and overlapping passages, copies, nulls, empty and long texts, texts of a single character, and a repeat inside one text.
PLANTED = [
    (1, words(80, 3) + " " + SHARED + " " + words(30, 4)), (2, words(10, 5) + "\t" + SHARED + "\n" + words(20, 6)),
    (3, SHARED), (4, SHARED), (5, None), (6, ""), (7, "one"), (8, OTHER + " " + OTHER), (9, " ".join(OTHER.split()[13:70])),
    (10, words(3000, 7)), (11, words(3000, 7)), (12, "z" * 500), (13, "z" * 130), (14, "é" * 90), (15, "x" + "é" * 90), (16, " \t\n"),
    (17, words(3000, 7).replace("w7 ", "W7 ")), (18, SHARED + " " + " ".join(OTHER.split()[:49])), (19, "ab" * 400),
]


def frame(spark, rows, schema=DOC):
    """With a column whose name is also one inside the operators."""
    return spark.createDataFrame(rows, schema).withColumn("ranges", F.lit("x")).withColumn("owner", F.lit(1)).withColumn("id", F.lit(7))


@pytest.mark.parametrize("options", [{}, {"part": 500, "chunk": 4000}])
def test_repeated_passages(spark, doc_rows, options):
    for rows in (PLANTED, doc_rows):
        out = phrases.remove_repeats(frame(spark, rows), digests=True, **options).collect()
        assert {r[0]: tuple(r)[1:] for r in out} == brute.passages(rows)


@pytest.mark.parametrize("options", [{}, {"part": 500, "chunk": 4000, "shard": 700}])
def test_repeated_strings(spark, doc_rows, options):
    for rows in (PLANTED, doc_rows):
        out = suffixes.remove_repeats(frame(spark, rows), digests=True, **options).collect()
        assert {r[0]: tuple(r)[1:] for r in out} == brute.strings(rows)


def covered(out, docs, size):
    gone = {d: np.zeros(size(t), bool) for d, t in docs}
    for r in out.itertuples():
        gone[r.doc][r.start:r.end] = True
    return {d: int(g.sum()) for d, g in gone.items()}


@given(st.lists(st.text("ab", max_size=25), min_size=1, max_size=7), st.integers(2, 4))
@settings(max_examples=300, deadline=None)
def test_any_passages(texts, window):
    """Few words, so that passages overlap themselves and each other in every way."""
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    rows = pd.DataFrame([(k, 0, 0, t.encode(), 1) for k, t in docs if t], columns=["doc", "ver", "start", "data", "parts"])
    if len(rows):
        out = covered(phrases.locate(rows, window)[0], docs, lambda t: len(t.split()))
        assert out == {d: x[1] for d, x in brute.passages(docs, window).items()}


@given(st.lists(st.text("ab", max_size=30), min_size=1, max_size=7), st.sampled_from([(4, 2), (4, 1), (6, 3), (4, 4)]), st.integers(1, 60))
@settings(max_examples=300, deadline=None)
def test_any_strings(texts, sizes, shard):
    window, letter = sizes
    docs = list(enumerate(texts))
    rows = pd.DataFrame([(k, 0, 0, t.encode(), 1) for k, t in docs if len(t) >= window], columns=["doc", "ver", "start", "data", "parts"])
    if len(rows):
        out = covered(suffixes.repeats(rows, window, letter, shard)[0], docs, len)
        assert out == {d: x[1] for d, x in brute.strings(docs, window).items()}


def test_substring_texts_and_odd_ids(spark):
    rows = [(None, SHARED), (1, SHARED), (1, SHARED), (2, "a " + SHARED), (2, "b " + SHARED), (3, words(70, 9))]
    kept = sorted((r["doc_id"], r["kept"]) for r in phrases.remove_repeats(frame(spark, rows)).collect())
    assert kept == [(1, SHARED), (1, SHARED), (2, "a"), (2, "b"), (3, words(70, 9))]
    kept = sorted((r["doc_id"], bytes(r["kept"])) for r in suffixes.remove_repeats(frame(spark, rows)).collect())
    assert kept == sorted([(1, SHARED.encode()), (1, SHARED.encode()), (2, b"a "), (2, b"b "), (3, words(70, 9).encode())])
    left = suffixes.keep_rest(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == sorted([(0, SHARED), (1, SHARED), (1, SHARED), (2, "a "), (2, "b "), (3, words(70, 9))])
    for empty in (phrases.remove_repeats(frame(spark, [])), suffixes.remove_repeats(frame(spark, [])), suffixes.keep_rest(frame(spark, []))):
        assert empty.collect() == []


def test_merged_transforms_are_sorted():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 99, rng.integers(8, 40), dtype=np.uint8)) for _ in range(9)]
    step, depth = 2, 4
    shards, suffix = [], []
    for t in texts:
        m = len(t)
        room = m - np.arange(m + 1)
        letters = np.where(room >= step, [int.from_bytes(t[i:i + step], "big") for i in range(m + 1)], 0)
        before = np.r_[np.zeros(step, int), letters[:-step]]
        order, bwt = suffixes.transform(letters, before, depth, step, room)
        shards.append(bwt)
        suffix.append([(t[i:i + step * depth][:(m - i) // step * step]) for i in order])
    interleave, block = suffixes.merge(shards, depth)
    nexts = [iter(s) for s in suffix]
    merged = [next(nexts[s]) for s in interleave]
    assert merged == sorted(merged)
    for a, b, same in zip(merged, merged[1:], block[1:] == block[:-1], strict=False):
        assert same == (a == b and len(a) == step * depth)


def test_simhash(spark, doc_rows):
    near = [(1000 + k, "alpha beta gamma delta " * 40 + f"tail {k}") for k in range(40)]
    rows = [*doc_rows, *PLANTED[4:7], *near, (2000, "ÀB c\x0bd"), (2001, "Àb C d")]
    rows = [(d, t) for d, t in dict(rows).items()]
    for tile in (simhash.TILE, 5):
        out = {r[0]: (f"{r[1] & (1 << 64) - 1:016x}", r[2]) for r in simhash.near_duplicates(frame(spark, rows), tile=tile).collect()}
        assert out == brute.simhash_classes(rows)


def test_simhash_odd_rows(spark):
    rows = [(None, "a b c"), (4, "a b c"), (2, "a b c"), (4, "quite another text altogether here"), (9, "quite another text altogether here"), (8, "and a third one, unlike both of them")]
    out = sorted((r[0], r[2]) for r in simhash.near_duplicates(frame(spark, rows)).collect())
    assert out == [(2, 2), (4, 2), (4, 2), (8, 8), (9, 2)]
    kept = simhash.keep_first(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 2, 8] and kept[0].asDict().keys() >= {"ranges", "owner", "id"}
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(k, k + 1) for k in range(100, 180)] + [(0, k) for k in range(1, 50)] + [tuple(map(int, x)) for x in rng.integers(200, 400, (120, 2))]
    rng.shuffle(links)
    want = brute.components({n for x in links for n in x if x[0] != x[1]}, links)
    got = components.connected_components(spark.createDataFrame([tuple(map(int, x)) for x in links] + [(5, 5), (None, 3)], "a long, b long"))
    out = {r[0]: r[1] for r in got.collect()}
    assert out == {n: c for n, c in want.items() if n != c}


VECTOR = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    rng = np.random.default_rng(2)
    base = rng.standard_normal((4, 64))
    for k in range(300):  # near copies in a ring of noise, and groups of equal vectors
        rows.append((5000 + k, [float(x) for x in (base[k % 4] + 0.33 * rng.standard_normal(64)).astype(np.float32)]))
    rows += [(6000 + k, [float(x) for x in base[0].astype(np.float32)]) for k in range(60)]
    return rows + [(7000, None), (7050, []), (7100, [0.0] * 64), (7150, [float("nan")] * 64), (7200, [None] + [1.0] * 63), (7250, [float("inf")] * 64)]


def test_one_bit_search(spark, vectors):
    out = defaultdict(dict)
    for r in onebit.search(frame(spark, vectors, VECTOR), F.col("id") % 50 == 0).collect():
        out[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    want = brute.nearest(vectors, lambda i: i % 50 == 0)
    assert out.keys() == want.keys()
    hits = total = 0
    for q, rows in want.items():
        assert sorted(out[q]) == list(range(1, len(rows) + 1))
        hits += len({i for i, _ in rows} & {i for i, _ in out[q].values()})
        total += len(rows)
        for (i, s), (j, t) in zip(rows, [out[q][k] for k in sorted(out[q])], strict=True):
            assert i != j or abs(s - t) < 1e-12
    assert hits >= 0.98 * total


def test_one_bit_small(spark):
    rows = [(50, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (100, [1.0]), (None, [1.0, 0.0])]
    out = sorted(tuple(r) for r in onebit.search(frame(spark, rows, VECTOR), F.col("id") % 50 == 0).collect())
    assert [(a, b, c) for a, b, c, _ in out] == [(50, 1, 3), (50, 2, 2)]
    assert onebit.search(frame(spark, [], VECTOR), F.col("id") % 50 == 0).collect() == []


@pytest.mark.parametrize("block", [collisions.BLOCK, 100])
def test_collisions(spark, vectors, block):
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in collisions.near_duplicates(frame(spark, vectors, VECTOR), block=block).collect()}
    want = brute.embedding_links(vectors)
    assert out.keys() == want.keys() and all(k == (c == i) for i, (_, c, k) in out.items())
    assert sum(abs(out[i][0] - n) for i, (n, _) in want.items()) <= 0.001 * sum(n for n, _ in want.values())
    assert all(out[i][0] <= n for i, (n, _) in want.items())
    assert sum(out[i][1] != c for i, (_, c) in want.items()) == 0


def test_collision_counts():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((130, 9)), rng.standard_normal((77, 9))
    pairs = {(int(x), int(y)) for p in collisions.colliding(a, b, 0.8, 5) for x, y in zip(*p, strict=True)}
    assert pairs == {(int(x), int(y)) for x, y in zip(*np.nonzero((np.abs(a[:, None] - b) <= 0.8).sum(axis=2) >= 5), strict=True)}


def test_collisions_odd(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (2, [0.0, 2.0]), (None, [1.0, 0.0]), (3, None)]
    out = sorted(tuple(r) for r in collisions.near_duplicates(frame(spark, rows, VECTOR)).collect())
    assert [(r[0], r[2], r[3]) for r in out] == [(1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True)]
    assert collisions.near_duplicates(frame(spark, [], VECTOR)).collect() == []


PATH = vocabulary.located("byte_bpe_50k.json")


def test_packing(spark, doc_rows):
    rows = [*doc_rows, (None, "a"), (9999, None), (10000, ""), (10001, "word " * 5000)]
    out = packing.pack_documents(frame(spark, rows), "byte_bpe_50k.json").collect()
    want = brute.pieces(rows, PATH)
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == want and len(out) == len(want)
    filled = defaultdict(list)
    for r in out:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(filled) <= -(-sum(n for _, n, _ in want.values()) // 1024) + 1
    assert packing.pack_documents(frame(spark, []), "byte_bpe_50k.json").collect() == []


def test_pieces_hold_the_ids(spark):
    rows = [(1, "some text " * 600)]
    got = sorted(packing.pieces(frame(spark, rows), "byte_bpe_50k.json").collect(), key=lambda r: r["piece"])
    ids = [i for r in got for i in r["ids"]]
    assert ids == [*vocabulary.tokenizer("byte_bpe_50k.json").encode(rows[0][1], add_special_tokens=False).ids, 2]
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)


@given(st.dictionaries(st.integers(1, 100), st.integers(1, 40), min_size=1, max_size=40))
@settings(max_examples=150, deadline=None)
def test_best_two_fit(counts):
    bins = packing.best_two_fit(counts, 100)
    total = Counter()
    for times, lengths in bins:
        assert times > 0 and 0 < sum(lengths) <= 100
        for n in lengths:
            total[n] += times
    assert dict(total) == counts


def test_two_fit_beats_greedy():
    # Greedy fills 10 with 6 + 3; one swap of the 3 for 2 + 2 fills it.
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])


ODD = st.lists(st.sampled_from([*"abcdeéÉ'strevml.,!?0123 \u0331\u0301İKſ한각😀漢字\x85", "<|endoftext|>", "'re", "thing"]), max_size=60).map("".join)


@given(ODD, st.sampled_from([1, 2, 5, 16]))
@settings(max_examples=400, deadline=None)
def test_tree_encoding(text, leaf):
    encoder = bpe.TreeEncoder("word_bpe_49k.json", leaf)
    want = encoder.lib.encode(text, add_special_tokens=False).ids
    assert encoder.ids(text) == want
    assert encoder.decoded(next(encoder.entries([text]))) == encoder.lib.decode(want, skip_special_tokens=False)


def test_pre_tokens_of_plain_characters():
    encoder = bpe.TreeEncoder("word_bpe_49k.json")
    assert encoder.parts is not None
    rng = np.random.default_rng(3)
    texts = ["".join(bpe.PLAIN), *(a + b for a in bpe.PLAIN for b in "a1.' "), *("".join(rng.choice(bpe.PLAIN, 40)) for _ in range(300)),
             "DON'T we'LL 'S ..'s x\x1cy \xa0a\x85b Ünïcödé ßß 12½ <|endoftext|>'re<|startoftext|>"]
    for text in texts:
        want = encoder.lib.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == want, repr(text)
        assert encoder.decoded(next(encoder.entries([text]))) == encoder.lib.decode(want, skip_special_tokens=False)


def test_bpe(spark, doc_rows):
    rows = [*doc_rows, (None, "a"), (9999, None), (10000, ""), (10001, "longword" * 9000), (10002, "Ünïcode😀" * 3000)]
    lib = vocabulary.tokenizer("word_bpe_49k.json")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for d, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))
    docs = frame(spark, rows)
    assert {r[0]: tuple(r)[1:] for r in bpe.encode_documents(docs, "word_bpe_49k.json", digests=True).collect()} == want
    full = bpe.decode_documents(bpe.encode_documents(docs, "word_bpe_49k.json"), "word_bpe_49k.json").collect()
    assert {r["doc_id"]: (r["n_tokens"], sha(" ".join(map(str, r["ids"]))), sha(r["decoded"])) for r in full} == want
    assert all(r["text"] == r["decoded"] for r in full)
    assert bpe.encode_documents(frame(spark, []), "word_bpe_49k.json").collect() == []


def test_byte_vocabulary_has_one_answer():
    encoder = vocabulary.Encoder("byte_bpe_50k.json")
    every = "".join(map(chr, range(vocabulary.SETTLED)))
    for text in (every, every * 2 + "<|endoftext|> x", "日本語 text", "", "  \n\n a's"):
        assert encoder.ids(text) == encoder.plain.encode(text, add_special_tokens=False).ids


LABELLED = DOC + ", lang string"


def test_language(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(None, "il est", "fr"), (20001, None, "en"), (20002, "", None), (20003, "12 34 !?", "en"), (20004, "zqxj vkqz xxqj zzkq wqxz jjqk " * 30, None)]
    out = {r["doc_id"]: r for r in language.identify(frame(spark, rows, LABELLED)).collect()}
    assert len(out) == len(rows)
    held = [(d, lang) for d, t, lang in rows if d is not None and d < 1000 and zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(out[d]["held_out"] for d, _ in held) and not out[None]["held_out"]
    assert sum(out[d]["lang_pred"] == lang for d, lang in held) >= 0.98 * len(held)
    for d in (20001, 20002, 20003):
        assert out[d]["lang_pred"] == "und" and out[d]["score"] == 0 and out[d]["rejected"]
    assert out[20004]["rejected"] and all(0 <= r["score"] <= 1 for r in out.values())
    assert sum(out[d]["rejected"] for d, _, _ in rows if d is not None and d < 1000) <= 10
    kept = language.keep_identified(frame(spark, rows, LABELLED))
    assert kept.columns == frame(spark, rows, LABELLED).columns and kept.count() == sum(not r["rejected"] for r in out.values())


def test_language_without_labels(spark):
    rows = [(1, "some text", None), (2, None, None)]
    out = language.identify(frame(spark, rows, LABELLED)).collect()
    assert [r["lang_pred"] for r in out] == ["und", "und"] and all(r["rejected"] for r in out)
    assert language.identify(frame(spark, [], LABELLED)).collect() == []


def test_kneser_ney_sums_to_one():
    model = language.fit(["abab", "abc", "cab", "b"], np.array([3.0, 1, 2, 1]), 3)
    letters = ["a", "b", "c", language.AFTER]  # all that it has seen, besides the mark before a word
    for context in ("\x02\x02", "\x02a", "ab", "zz"):
        p = np.exp(-model.surprise(np.array([[ord(c), ord(context[1]), ord(context[0])] for c in [*letters, "\u4e00"]], np.uint64)))
        assert np.isclose(p[:-1].sum() + (language.ALPHABET - len(letters)) * p[-1], 1)


PAGE = "page_id long, url string, html string"


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    big, other = "<p>" + "x" * 2000, "é" * 600
    rows = [(1, "u\r\nv", big), (2, None, big), (30, "w", big), (4, "a", "small"), (5, "b", "small"), (6, "c", None), (7, "d", ""),
            (8, "e", other), (9, "f", other), (10, "g", "WARC/1.1\r\n\r\nx" * 90), (None, "h", big), (11, "i", "y" * 999), (12, "j", "y" * 999)]
    index = warc.archive(frame(spark, rows, PAGE))
    out = {r[0]: tuple(r)[1:] for r in warc.read_back(index).collect()}
    want = {}
    for p, _, html in rows:
        if p is not None:
            data = (html or "").encode()
            top = max(q for q, _, h in rows if q is not None and (h or "") == (html or ""))
            again = len(data) >= 1000 and top != p
            want[p] = (len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None)
    assert out == want
    payload = {r["page_id"]: r["payload"] for r in warc.read_records(index).collect()}
    assert payload[30] == big.encode() and payload[1] is None
    assert warc.read_back(warc.archive(frame(spark, [], PAGE))).collect() == []


def test_normaliser_members(tmp_path):
    import gzip
    import io

    data = b"".join(warc.record(k, "u", "response", None, "d", bytes([65 + k]) * (k * 1000)) for k in range(5))
    target = io.BytesIO()
    rows = list(warc.normalise(io.BytesIO(gzip.compress(data)), target))
    assert gzip.decompress(target.getvalue()) == data and [r[0] for r in rows] == list(range(5))
    for k, _, offset, n in rows:
        assert gzip.decompress(target.getvalue()[offset:offset + n]).startswith(b"WARC/1.1\r\n") and offset == sum(r[3] for r in rows[:k])
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records(iter([data[:-3]])))


def test_pseudo_likelihood(spark, doc_rows):
    rows = [*doc_rows, (None, "the a"), (9999, None), (10000, " \n")]
    docs = frame(spark, rows)
    known = pl.vocabulary(docs)
    counts = Counter(w for _, t in rows for w in pl.words_of(t))
    top = sorted(counts, key=lambda w: (-counts[w], w))[:pl.CLASSES - pl.BUCKETS - 1]
    assert known == {w: k + 1 for k, w in enumerate(top)}
    encoded = pl.encode(docs, known)
    net = pl.train(encoded)
    out = {r["doc_id"]: r for r in pl.score(encoded, net).collect()}
    find = pl.Classes(known, pl.CLASSES, pl.BUCKETS)
    for d, t in rows:
        ids = [0, *find.of(t), 0]
        assert out[d]["n_tokens"] == len(ids) - 2
        if len(ids) <= 300:
            total = sum(float(pl.log_probabilities(net, np.array([a]), np.array([c]))[0, b]) for a, b, c in zip(ids, ids[1:], ids[2:], strict=False))
            assert abs(out[d]["log_likelihood"] - total) < 1e-3 * max(1, abs(total))
    assert out[9999]["mean_log_prob"] is None and out[10000]["perplexity"] is None and out[9999]["log_likelihood"] == 0
    # What it has learned: a text is likelier than its words in another order, and than under no training.
    longest = max(rows[:-3], key=lambda x: len(x[1] or ""))[1]
    mixed = " ".join(np.random.default_rng(0).permutation(pl.words_of(longest)))
    two = pl.encode(spark.createDataFrame([(1, longest), (2, mixed)], DOC), known)
    a, b = (r["mean_log_prob"] for r in pl.score(two, net).orderBy("doc_id").collect())
    before = pl.score(two, pl.start()).orderBy("doc_id").first()["mean_log_prob"]
    assert a > b and a > before + 0.5


def test_gradient():
    net = pl.start(12, 3, 4)
    net = {k: v.astype(np.float64) for k, v in net.items()}
    rng = np.random.default_rng(0)
    left, right, counts = rng.integers(0, 12, 7), rng.integers(0, 12, 7), rng.integers(0, 4, (7, 12)).astype(float)
    loss = lambda n: -(counts * pl.log_probabilities(n, left, right)).sum() / counts.sum()
    g = pl.gradient(net, left, right, counts)
    for k in net:
        at = tuple(int(rng.integers(s)) for s in net[k].shape)
        for place in (at, tuple(0 for _ in at)):
            up, down = ({**net, k: net[k].copy()} for _ in range(2))
            up[k][place] += 1e-5
            down[k][place] -= 1e-5
            assert np.isclose((loss(up) - loss(down)) / 2e-5, g[k][place], atol=1e-6)


def test_scores_of_nothing(spark):
    assert pl.score_documents(frame(spark, [])).collect() == []
    assert [r["n_tokens"] for r in pl.score_documents(frame(spark, [(1, None)])).collect()] == [0]


def test_every_word_has_its_own_probability(spark, doc_rows):
    docs = frame(spark, doc_rows)
    counts = pl.cut_lineage(pl.word_counts(docs))
    n = {r["word"]: r["n"] for r in counts.collect()}
    known = pl.most_frequent(counts)
    find, bucket = pl.Classes(known, pl.CLASSES, pl.BUCKETS), lambda w: pl.CLASSES - pl.BUCKETS + zlib.crc32(w.encode()) % pl.BUCKETS
    sums = Counter()
    for w, k in n.items():
        if w not in known:
            sums[bucket(w)] += k
    net = pl.start()
    # Words of the corpus, a rare and an unseen one; ids that repeat or are missing keep their rows.
    rare = next(w for w in sorted(n) if n[w] == 1)
    rows = [*doc_rows, (1, "the zzqxv a"), (None, f"the {rare} a"), (None, None)]
    for carried in (pl.CARRIED, 300, 0):
        shares = pl.shares_of(counts, known, carried=carried)
        assert len(shares.carried) <= carried and not shares.carried.keys() & known.keys()
        out = pl.score(pl.cut_lineage(pl.encode_words(frame(spark, rows), known, shares)), net, shares=shares).collect()
        want = []
        for d, t in rows:
            ids, words_ = [0, *find.of(t), 0], pl.words_of(t)
            p = pl.log_probabilities(net, np.array(ids[:-2], int), np.array(ids[2:], int))[np.arange(len(words_)), ids[1:-1]].astype(float).sum() if words_ else 0.0
            p += sum(np.log(n.get(w, pl.UNSEEN) / (sums[bucket(w)] + pl.UNSEEN)) for w in words_ if w not in known)
            want.append((d if d is not None else -1, len(words_), p))
        got = [(r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["log_likelihood"]) for r in out]
        assert len(got) == len(want)
        for a, b in zip(sorted(got), sorted(want), strict=True):
            assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-4 * max(1, abs(b[2]))
    # Gibberish is marked down against a common word in its place.
    common = max((w for w in n if w not in known), key=n.get)
    shares = pl.shares_of(counts, known)
    two = pl.cut_lineage(pl.encode_words(spark.createDataFrame([(1, common), (2, "zzqxv")], DOC), known, shares))
    a, b = (r["log_likelihood"] for r in pl.score(two, net, shares=shares).orderBy("doc_id").collect())
    assert a > b + 1


def test_lexicon_forgets_and_goes_on():
    texts = [words(50, k, 30) for k in range(6)] + ["", None]
    wide, narrow = (pl.Lexicon({"w1": 1}, {"w2": 5, "w3": 4}, pl.CLASSES, pl.BUCKETS, held) for held in (1000, 5))
    assert [wide.of(t) for t in texts] == [narrow.of(t) for t in texts]
