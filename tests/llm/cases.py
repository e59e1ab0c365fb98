"""Odd tables that every operator must stand."""

from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
LONG = "wort " * 30_000 + "x" * 50_000
TEXTS = [
    (1, "The cat and the dog walked to the river.\n" * 12),
    (1, "The cat and the dog walked to the river.\n" * 12),  # a repeated row
    (2, "The cat and the dog walked to the river.\n" * 12),  # a tie
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (None, "a text without an id that nobody else has at all"),
    (None, None),
    (6, LONG),
    (7, "one"),
    (7, "another text under the same id, as it happens here"),
    (8, "naïve café — 日本語 \U0001f600 '' <|endoftext|> </s> \\ \x00 end"),
]


def documents(spark):
    """The odd rows, with columns whose names the operators use themselves."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("lang", F.lit("en"))
    names = ["kept", "n_words", "ids", "seed", "at", "label", "component_id", "node", "key", "rep", "tokens"]
    return df.withColumns({n: F.lit(n) for n in names})


def empty(df):
    return df.filter("false")
