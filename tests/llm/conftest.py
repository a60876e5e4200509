import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text and columns with the operators' own names."""
    long = "lorem ipsum dolor sit amet consectetur " * 4000
    rows = [
        (1, "a short text of some words", "x"),
        (1, "a short text of some words", "x"),
        (2, "", "x"),
        (3, None, None),
        (4, " \n\t ", "y"),
        (5, long, "y"),
        (6, long, None),
        (None, "a row without an id, mail a.b@mail.example.com", "z"),
        (None, None, None),
        (7, "日本語 Ωmega ß 🙂 <|endoftext|> it's", "z"),
    ]
    names = ("fp", "score", "length", "rank", "_key", "_map", "size", "shard", "n_tokens", "_rank", "predicted", "key")
    extra = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(
        [(i, t, s, "en", *["clash"] * len(names)) for i, t, s in rows], f"doc_id long, text string, source string, lang string, {extra}"
    )


@pytest.fixture(scope="session")
def documents(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet")


def python_free(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow"))
