import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Null, empty, blank, tiny, long, tied, repeated and non-Latin texts; ids are null, repeated and out of order.
ODD = [
    (5, None), (4, ""), (3, " \n\t"), (9, "one"), (8, "one"), (7, "two words"), (None, "alone with no id at all"),
    (11, "word " * 3000), (12, "é日本 😀 " * 50), (1, "A b C d\nA b C d\n"), (1, "A b C d\nA b C d\n"), (1, "another text"),
    (20, "".join(f"w{i} " for i in range(400))), (21, "".join(f"w{i} " for i in range(398))),
    (22, "x" * 300), (23, "x" * 99), (24, "password = abcdefghijkl0 and AKIA" + "Z" * 16), (25, "<|endoftext|> é İ"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns that are named like the operators' own."""
    return spark.createDataFrame(
        [(i, t, "en", None if i == 9 else "host", len(t or ""), "clash", 1, True) for i, t in ODD],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, n int, kept boolean",
    )


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no tables")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
