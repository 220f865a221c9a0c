import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def workers_path(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


# Nulls, empty and very long texts, ties, repeated rows, a null id, and columns named like results.
LONG = " ".join(f"w{n % 977} Ünï{n % 13}" for n in range(30_000))
EDGES = [
    (1, "The same text, the same text.\nThe same text, the same text.", "en", "a"),
    (1, "The same text, the same text.\nThe same text, the same text.", "en", "a"),
    (1, "Another text of one id", "en", None),
    (2, None, None, "a"),
    (3, "", "en", "b"),
    (4, " \t\n ", "en", "b"),
    (None, "No id at all", "en", "b"),
    (5, LONG, "en", "c"),
    (6, LONG, "en", "c"),
    (7, "<|endoftext|> é漢字😀▁ x  y   z\n\n", "de", "c"),
]
CLASHES = ["ids", "Decoded", "n_tokens", "kept", "n_words", "node", "u", "d", "o", "row", "spans", "fp", "part", "topic", "taken", "point"]


@pytest.fixture(scope="session")
def edges(spark):
    rows = [(*r, 1 if r[1] is None else len(r[1]), *(["x"] * len(CLASHES))) for r in EDGES]
    names = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.fixture(scope="session")
def no_rows(spark, edges):
    return edges.where("false")
