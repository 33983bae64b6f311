import pytest

#: Names that the operators use inside or add, here as columns of the input.
CLASHING = "n_words string, row string, hits string, w string, wh string, size string, key string, packed string, judged string, lang_pred string, score string, cls string, shard string, gone_id string"
EXTRA = tuple("x" for _ in CLASHING.split(","))
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, odd characters, ties and repeated rows."""
    long = " ".join(f"word{i % 977} other{i % 31}." for i in range(30_000))
    rows = [
        (1, "One two three four five six seven eight nine ten.", "en", "a", 10),
        (2, "one TWO three four five six seven eight nine ten.", "en", "a", None),
        (3, None, "en", "b", 0),
        (4, "", None, None, None),
        (5, " \n\t ", "en", None, 3),
        (6, long, "en", "b", len(long)),
        (7, long, "en", "b", 5),
        (8, "1234 5678 !!", "en", "c", 12),
        (9, "Ümläut ß 😀 don't  stop\x1cnow \n\n ’s <|endoftext|>", "de", "c", -4),
        (None, "No id here, but a text", "en", "a", 22),
        (None, None, None, None, None),
        (10, "again and again", "fr", "a", 15),
        (10, "again and again", "fr", "a", 15),
        (10, "another text under the same id", "fr", "a", 15),
        (-3, "x", "fr", "d", 1),
    ]
    return spark.createDataFrame([r + EXTRA for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")
