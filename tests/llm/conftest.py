from __future__ import annotations

import pytest

#: Columns of other names that operators use inside.
EXTRA = "block INT, bucket INT, token STRING, share STRING, copies STRING, size STRING, part STRING, stays INT"
SCHEMA = f"doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, {EXTRA}"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of ``(doc_id, text)`` rows, with language, source and columns of clashing names."""

    def docs(rows, lang="en", source="s"):
        full = [(i, t, lang, source if i is None or i % 2 else None, None, 1, None, "x", None, "c", "d", "e", None) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return docs


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, ties, a long word, a long text, signs and other scripts."""
    base = " ".join(f"w{i}" for i in range(40))
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, "one two"),
        (7, "one two"),
        (None, base),
        (None, None),
        (8, "x" * 5000 + " tail"),
        (9, " ".join(f"w{i % 50}" for i in range(20000))),
        (10, "été ÇA  Ünï\x0bcode nbsp 漢字 \U0001f600 $$$"),
        (11, "w0 " * 300),
        (12, base + " w40 w41"),
    ]
