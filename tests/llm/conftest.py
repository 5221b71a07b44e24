import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"
# NULLs, empty and blank texts, repeated rows, one id with two texts, a very long text, clashing names.
ODD = [
    (None, "an orphan text without any id"), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "Two words"), (5, "Two words"),
    (6, "first version of a text"), (6, "second version of a text"), (7, "word " * 30_000), (8, "a\x0bb\x0cc\rd"), (9, "naïve café — “quotes” 日本語 <|endoftext|> x"),
    (10, "x" * 5_000), (11, "the same line which is longer than forty characters\n" * 3), (-12, "negative id"),
]
KINDS = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, n_tokens string, keep int, key string, score string, `cid` int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame([(i, t, None, None, None, "r", "k", "n", 1, "y", "s", 3) for i, t in ODD], KINDS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet(f"{SMALL}/pages.parquet")


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
