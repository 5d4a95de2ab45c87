import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """Rows with what operators must stand: NULLs, empty and very long texts, ties, repeated rows,
    and columns of clashing names."""
    long_text = " ".join(f"word{n % 977} and{n}" for n in range(20_000)) + "."
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "a"),
        (2, "The  quick brown fox\tjumps over the lazy dog near the old river bank today.", "a"),
        (3, None, None),
        (4, "", "b"),
        (5, long_text, "b"),
        (6, long_text.replace("and777 ", "changed "), "c"),
        (7, "Ünïcode wörds ÄÖÜ and 数字 here, again and again and again!", None),
        (8, "one", "a"),
        (8, "one", "a"),
        (None, "one", "a"),
        (None, None, None),
        (9, "<|im_end|> token = \"AbCd1234EfGh5678\" \\| end <|endoftext|>", "c"),
    ]
    schema = "doc_id bigint, text string, source string"
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "doc_id AS key", "text AS digest", "source AS node", "1 AS n_chars")


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus.where("1 = 0")
