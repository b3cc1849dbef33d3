from __future__ import annotations

import pytest

# names that the operators use for columns of their own
CLASHING = ["n", "key", "row", "score", "lost", "low", "set_key", "line_shard", "pack_group", "tile", "a", "strip"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) rows, with further columns whose names clash."""

    def make(rows, extra: bool = True):
        more = ", ".join(f"{c} string" for c in CLASHING) if extra else ""
        schema = "doc_id long, text string, lang string, source string, n_chars long" + (", " + more if more else "")
        full = [(i, t, "en", "s", None if t is None else len(t), *(["x"] * len(CLASHING) if extra else [])) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and repeated rows, blanks only, and a very long text."""
    words = " ".join(f"w{i * 7919 % 9973}" for i in range(60_000))
    return [
        (1, None), (2, ""), (None, "a line without an id, repeated here"), (None, None), (3, "   \n\t "),
        (4, "short"), (4, "short"), (5, words), (6, words + " end"), (2**62, "the largest id"), (-7, "x" * 5000),
        (8, "Zeile mit Ümlaut ß \U0001F600 und <|turn|> [INST] </s>"),
    ]


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
