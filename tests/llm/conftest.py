import pytest

SCHEMA = """doc_id bigint, text string, lang string, source string, n_chars bigint,
  row bigint, digest string, point string, shard string, bucket string, length string, ids string"""
EXTRA = (5, "a", "b", "c", "d", "e", "f")

PROSE = (
    "The house is on the hill and it was built by a man from the village at the river. "
    "He is as old as the trees that are in the garden, and this is for him to be with them."
)


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, extra columns."""
    long = " ".join(f"word{i % 977} and the {i % 13}" for i in range(30_000))
    texts = [
        (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "en"), (3, None, "en"), (None, "", None),
        (4, "", "fr"), (5, " \t\n ", "de"), (6, long, "en"), (7, "é" * 50, "xx"), (None, PROSE, "en"),
        (8, "a\nb\n\na\nB \n", "es"), (9, PROSE.upper(), "en"), (10, "one", None),
        (-5, "\x00\x1c nul and\u00a0space \U0001f600 ﬁ İ Σ", "en"),
    ]
    rows = [(i, t, lang, None if i == 4 else "s", None, *EXTRA) for i, t, lang in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
