from __future__ import annotations

import pytest

#: Columns whose names the operators use themselves.
CLASHING = ["shard", "slot", "size", "target", "taken", "kept", "component", "key", "_key", "_row", "_bucket", "_words",
            "n", "fingerprint", "digest", "copy", "_id", "sequence_id", "piece", "file"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    near = [f"n{i}" for i in range(120)]
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, "a"), (4, "one", "en", None),
        (5, long, "en", "b"), (6, long, "en", "b"), (6, long, "en", "b"), (7, long[:150_000], "de", None),
        (8, " ".join(near), "en", "a"), (9, " ".join(near[:110] + ["z"] * 3 + near[113:]), "fr", "b"),
        (10, " ".join(near).upper(), None, None), (None, "null id with some words in it " * 9, "en", "a"),
        (11, "x " * 400, "en", "c"), (12, "é  a #*$%&|<>\n\nq\nq\n", "en", "c"), (13, "a b c", None, "c"),
        (14, "A b c", None, "c"), (15, " ".join(near[:40]), "en", "c"), (None, None, None, None),
    ]
    rows = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(CLASHING)) for r in rows]
    names = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def marks(spark):
    rows = [(5, 1, 0), (8, 1, 1), (8, 1, 1), (9, 0, 1), (11, 0, 0), (15, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
