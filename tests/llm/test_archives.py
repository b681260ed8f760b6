"""Archives in folders named in any way, and many of them."""

import hashlib

import pytest

from lakeledger.llm import warc

PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_kinds_of_folder(spark, tmp_path, prefix):
    pages = [(k, f"http://h/{k}", f"<p>{k}" * (k + 1)) for k in range(40)]
    plan = warc.plan_records(spark.createDataFrame(pages, PAGE))
    paths = [r["path"] for r in warc.write_archives(plan, f"{prefix}{tmp_path}/a").collect()]
    assert paths and all(p.startswith("file:/") for p in paths)
    index = warc.normalise_archives(spark.createDataFrame([(p,) for p in paths], "path string"), f"{prefix}{tmp_path}/b").cache()
    assert {r["page_id"]: r["digest"] for r in warc.read_records(index).collect()} == {k: hashlib.sha1(h.encode()).hexdigest() for k, _, h in pages}


def test_an_archive_a_task(spark, tmp_path, monkeypatch):
    """As many tasks as archives rewrite them, and as many as their bytes ask for read them back."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "TASK_BYTES", 4_000)
    pages = spark.createDataFrame([(k, "u", f"<p>{k} " * 700) for k in range(120)], PAGE)
    paths = spark.createDataFrame([(r["path"],) for r in warc.write_archives(warc.plan_records(pages), f"{tmp_path}/a").collect()], "path string")
    n = paths.count()
    assert n > 8
    normal = warc.normalise_archives(paths, f"{tmp_path}/b")
    assert normal.rdd.getNumPartitions() == n
    assert sum(1 for held in normal.rdd.glom().map(len).collect() if held) == n
    index = spark.createDataFrame(normal.collect(), normal.schema)
    back = warc.read_records(index)
    assert back.rdd.getNumPartitions() > 4 and back.count() == 120
