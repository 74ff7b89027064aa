from pathlib import Path

import pytest

DIR = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "wort " * 60_000 + "x" * 200_000


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty and very long texts, null values, repeated rows, ties, and extra columns with names that operators use inside."""
    rows = [
        (1, "the cat sat on the mat and looked at the moon", "en", "a"),
        (2, None, "en", "a"),
        (3, "", "fr", None),
        (4, " \n\t ", None, "b"),
        (5, "1234 -- 77 !!", "de", "b"),
        (6, LONG, "de", "c"),
        (7, "the cat sat on the mat and looked at the moon", "en", "a"),
        (7, "the cat sat on the mat and looked at the moon", "en", "a"),
        (8, "le chat était assis sur le tapis et regardait la lune", "fr", "d"),
        (9, "der hund saß auf der matte und sah den mond an", None, "d"),
        (None, "un gato miraba la luna desde la casa", "es", "e"),
        (11, "é \U0001f600 ﻿ ñandú", "es", "e"),
    ]
    full = [(*r, len(r[1] or ""), 0.5, "q", [1], "z", 3, "w", 1) for r in rows]
    return spark.createDataFrame(full, f"{COLUMNS}, score double, lang_pred string, hits array<int>, found0 string, c0 int, `odd.name` string, row int")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def folder(tmp_path):
    """Writes tables where queries look for them."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


needs_data = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables")
