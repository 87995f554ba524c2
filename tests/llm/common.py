"""Small tables with the awkward cases, and plain readers."""

import random

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
#: doc_id, text: nulls, blanks, repeated rows, ties, odd characters.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog."), (2, None), (3, ""), (4, " \n\t "), (5, "a"),
    (6, "The quick brown fox jumps over the lazy dog."), (6, "The quick brown fox jumps over the lazy dog."),
    (None, "no id at all"), (8, "Zürich, façade; naïve — 東京 😀 \x00\x1c end"), (9, "x" * 5000), (10, "12345 !!! ???"),
    (11, "word " * 3000), (12, "<s> </s> <|endoftext|> ▁ <0x0A>"),
]
SCHEMA = "doc_id long, text string"


def awkward(spark):
    """The awkward rows with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)
    return df.withColumns({name: F.lit(7) for name in ("row", "n", "key", "digest", "locator", "spans", "score", "place", "node", "label")})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf_dir=SF):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "lang"])
    return table.to_pylist()


def random_text(seed, length, words=("alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta")):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(length))
