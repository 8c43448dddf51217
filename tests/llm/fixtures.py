"""Small tables with the awkward cases every text operator has to bear."""

import random

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

#: Names that operators use inside; as extra columns they must not matter.
CLASHING = ["id", "n", "row", "rows", "host", "token", "label", "text_hash", "length", "shard", "n_tokens", "x", "key", "a", "b", "u", "v", "words",
            "line", "kept", "score", "piece", "rep", "digest", "sig", "odd", "prefix", "component_id", "toxic", "html", "sha", "response", "f", "same"]

SHARED = "one shared passage of quite a few plain words that several documents hold"


def awkward_rows():
    rng = random.Random(7)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(30_000))
    some = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi"
    return [
        (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "word"), (5, "WORD"), (None, some), (6, some), (6, some), (7, some + " psi"),
        (8, long), (9, long + " end"), (10, "x" * 200_000), (11, " " * 100_000 + "y"), (12, "é ñ 日本語 \U0001F600 word word"), (13, SHARED),
        (14, f"{SHARED}\n{SHARED}\n{some}"), (15, "password = 'abc123XYZ' and token=token: short AKIA" + "A" * 16 + " " + "0f" * 12)]


def awkward(spark):
    df = spark.createDataFrame([(i, t, None if i == 4 else "en", None if i == 5 else f"src{(i or 0) % 2}") for i, t in awkward_rows()],
                               "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASHING:
        df = df.withColumn(name, F.lit("clash"))
    return df


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts(spark):
    return {r.doc_id: r.text for r in documents(spark).select("doc_id", "text").collect()}
