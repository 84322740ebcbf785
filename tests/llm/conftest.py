import random

import pytest

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def sample_documents():
    """(doc_id, text, lang, source): copies, near copies, shared passages, nulls, ties, long text."""
    base, passage = prose(1, 120), prose(2, 70)
    rows = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, base, None, None),
        (4, base.replace("alpha1", "omega"), "en", "b"),
        (5, prose(3, 40) + " " + passage + " " + prose(4, 30), "de", "b"),
        (6, passage + "\n" + prose(5, 10), "de", "b"),
        (7, prose(6, 20) + "\t" + passage, "fr", "c"),
        (8, None, "fr", "c"), (9, "", "fr", None), (10, "   \n ", "es", "a"),
        (11, "two words", "es", "a"), (12, "TWO words", "es", "a"),
        (13, "é ü 中文   x", "es", "ü"), (14, prose(7, 6000), "en", "a"),
        (None, base, "en", "a"), (None, None, None, None),
        (15, "same row", "en", "a"), (15, "same row", "en", "a"),
        (16, "line one\n\nline  two <|endoftext|> end ", "en", "b"),
    ]
    for k in range(40):  # near copies of one text, most of them linked only through it
        words = prose(8, 150).split()
        for at in random.Random(k).sample(range(len(words)), k % 5):
            words[at] = f"new{k}"
        rows.append((100 + k, " ".join(words), "en", "hot"))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def rows():
    return sample_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The sample with extra columns that bear names the operators use."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    from pyspark.sql import functions as F

    for name in ("key", "block", "node", "size", "score", "kept", "shard", "bands", "n", "ids",
                 "digest", "rank", "part", "lang_pred", "_copy"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
