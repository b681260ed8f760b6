import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def folder(spark, tmp_path_factory):
    from lakeledger.session import name_folder
    name_folder(spark, lambda: str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]
