"""Fixtures of these tests, imported by name (a second conftest would hide the first)."""
import pytest

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, _pool int, copy string, rank int, `set` int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra
    columns whose names the operators use themselves."""
    line = "A shared line of many words that several documents hold."
    long = " ".join(f"word{i % 977} tail{i % 13}" for i in range(60_000))
    texts = [None, "", " ", "\n", "\n\n", "x", "42 - 17", "The quick brown fox", "the QUICK brown fox", line, line + "\n" + line, f"  {line.upper()}\t\nown words here one",
             f"own words here two\n{line}", long, long + " end", long, "Straße ß É é", "STRASSE ß É é", "a\r\nb\x0bc", "emoji 😀 text 日本語 テスト"]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, len(t or "") if i % 2 else None) for i, t in enumerate(texts)]
    rows += [(9, line, "en", "src0", 1), (9, line, "en", "src0", 1), (None, line, None, None, None), (None, "only here, without an id", "fr", "src1", None),
             (None, None, None, None, None), (100, "same id, one text\nand a line", "de", "src2", 3), (100, "same id, other text\nand a line", "de", "src2", 3)]
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
