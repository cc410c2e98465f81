import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="session")
def words():
    return lambda text: WORD.findall(text or "")


@pytest.fixture(scope="session")
def docs(spark, sf):
    """The smallest documents table as rows by id."""
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


EDGES = [
    (1, "", "en", "src1", 0, "x"),
    (2, None, "en", "src1", None, "x"),
    (3, " \t\n\x0b\x0c\r ", None, "src1", 7, None),
    (4, "word", "de", None, 4, "y"),
    (5, "one two three four five six seven eight nine ten eleven twelve", None, None, None, "y"),
    (5, "one two three four five six seven eight nine ten eleven twelve", None, None, None, "y"),
    (None, "one two three four five six seven eight nine ten eleven TWELVE", "en", "src2", 1, "z"),
    (6, "Übermäßig 日本語 😀 ▁ \x00 é" * 3, "fr", "odd source", 1, "z"),
    (7, ("lorem ipsum dolor sit amet " * 30_000).strip(), "en", "src1", 1, "z"),
    (8, 'x password = "hunter2hunter2" AKIA' + "A" * 16 + " " + "0a" * 16, "en", "src1", 1, "z"),
]


@pytest.fixture
def edges(spark):
    """NULLs in every column, empty, white and very long texts, repeated rows and ids, extra columns with clashing names."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    return spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string, n_chars long, kept string").toDF(*names).withColumnsRenamed({"kept": "N_WORDS"})


@pytest.fixture
def empty(edges):
    return edges.where("false")
