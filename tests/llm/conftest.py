from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, digest string"


def prose(rng: random.Random, words: int, stems=("the", "ing", "ona", "ter", "was", "red", "lou", "ble")) -> str:
    return " ".join("".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, and columns whose names clash."""
    rng = random.Random(4)
    base = prose(rng, 60)
    near = base.split()
    near[30] = "other"
    texts = [None, "", " \t\n", "one", "Two words", base, base, base.upper(), " ".join(near), prose(rng, 20000), "é" * 3000, "7" * 5000, "a@b.example 10.0.0.1 +1 (212) 555-0147"]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}" if i % 4 else None, len(t or ""), "x", "k", "d") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [(i, prose(rng, rng.randint(1, 80)), "en", "src0", None, None, None, None) for i in range(20, 60)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOC)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
