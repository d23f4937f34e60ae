from __future__ import annotations

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row_id long, key string, class int, bucket int, "
          "ids string, keep string, entities string, host string, piece int, evidence double, fingerprint string")

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i // 3) % len(WORDS)] + str((seed * 31 + i) % 97) for i in range(n))


TEXTS = [
    (5, prose(1, 60)),
    (3, None),
    (9, ""),
    (7, "one"),
    (8, "  \n\t "),
    (1, prose(1, 60)),
    (2, prose(2, 30000)),
    (4, "Ünïcode 漢字 😀 \x01 tab\there\n\nline </s>[INST] ok <|endoftext|> ▁x  y"),
    (None, "a text without an id"),
    (6, prose(1, 58) + " changed words"),
    (11, "mail hein.19@mail5.example.com and HEIN.19@mail5.example.com"),
    (11, "mail hein.19@mail5.example.com and HEIN.19@mail5.example.com"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names the operators use inside."""
    rest = ("en", "src0", 3, 1, "k", 1, 1, "x", "y", "z", "h", 0, 0.5, "f")
    return spark.createDataFrame([(i, t, *rest) for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
