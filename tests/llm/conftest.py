import pytest
from pyspark.sql import functions as F

#: Texts that every operator must stand: null, empty, blank, very long, tied and repeated rows, odd characters.
HARD = [
    (1, "the quick brown fox jumps over the lazy dog near the old mill"),
    (1, "the quick brown fox jumps over the lazy dog near the old mill"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "word " * 30_000),
    (None, "a row without an id has a text of its own here"),
    (None, None),
    (6, "Ünïcödé ΑΣ 你好 \x00 \x1c e\u0301 😀\nsecond line of the text with words\n\nlast"),
    (7, "the quick brown fox jumps over the lazy dog near the old mill"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """The hard texts, with further columns whose names clash with those of results."""
    docs = spark.createDataFrame(HARD, "doc_id bigint, text string")
    extra = {n: F.lit("x") for n in ("size", "shard", "slot", "h", "fp", "key", "row", "tie", "line", "score", "block", "n_tokens", "component_id")}
    return docs.withColumns(extra)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def small_documents(spark):
    """Invented texts: common words, copies with small edits, repeated lines."""
    import random

    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(150)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    texts = ["\n".join(line(rng.randint(2, 25)) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    for _ in range(40):
        own = rng.choice(texts).split(" ")
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    return texts
