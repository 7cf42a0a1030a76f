"""Tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing names."""

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, node long, n long, "
          "score string, h string, row long, doc string, kind int, vslot string, ids int, "
          "_known int, key string, pos int, piece string")
EXTRA = (None, 1, "x", "y", 2, "z", 3, "v", 4, 5, "k", 6, "p")
LONG = " ".join(f"word{i} und" for i in range(30_000))


def full(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text) if text is not None else None, *EXTRA)


@pytest.fixture(scope="session")
def hard(spark):
    rows = [full(1, "the cat sat on the mat and looked at me"), full(2, None), full(3, ""),
            full(4, " \t\n"), full(5, LONG), full(6, "the cat sat on the mat and looked at me"),
            full(6, "the cat sat on the mat and looked at me"), full(None, "no id at all here now"),
            full(None, None, None, None), full(7, "%%% 123 !!!", None, None),
            full(8, "\x00 odd ​ text \U0001f600 Ünï", "de", None), full(9, "one", "fr", "t")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
