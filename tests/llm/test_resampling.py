import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tremorlake.llm.common import Scratch
from tremorlake.llm.resampling import buckets_of, op13_importance_resampling, radix_sort, resample, words_of

from fixtures import SF_DIR, awkward, awkward_rows

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target):
    """(doc_id, n_features, weight, score, rank) of every (doc_id, text)."""
    source = Counter(b for _, t in docs for b in features(t))
    wanted = Counter(b for t in target for b in features(t))
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((source[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        f = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    drawn = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(drawn[:5 * len(drawn) // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_buckets_equal_whole_features():
    for text in ("", None, "One", "one TWO", "a b c d 1x É日 q", "A-b_c\x7f\U0001F600 z\n" * 50):
        assert sorted(buckets_of(words_of(text)).tolist()) == sorted(features(text))


def test_radix_sort_equals_sorting(spark):
    """Negative and huge numbers, ties and one key for a third of the rows, over many small blocks and digits."""
    rng = random.Random(4)
    rows = [(rng.choice([7, rng.randint(-2 ** 63, 2 ** 63 - 1), rng.randint(-50, 50)]), rng.randint(-5, 5), n) for n in range(3000)]
    df = spark.createDataFrame(rows, "x long, y long, n long").repartition(5, "n")
    keys = [F.col("x").bitwiseXOR(F.lit(-2 ** 63)), F.col("y").bitwiseXOR(F.lit(-2 ** 63))]
    with Scratch(spark, "test") as scratch:
        for digit_bits, block_bits in ((11, 20), (3, 6)):
            got = radix_sort(scratch, df, keys if digit_bits == 11 else keys[1:], digit_bits, block_bits).orderBy("pos").collect()
            assert [r.pos for r in got] == list(range(3000)) and {r.n for r in got} == set(range(3000))
            key = (lambda r: (r.x, r.y)) if digit_bits == 11 else (lambda r: r.y)
            assert [key(r) for r in got] == sorted(map(key, got))
        same = radix_sort(scratch, spark.range(100).withColumn("x", F.lit(5).cast("long")), [F.col("x")])
        assert sorted(r.pos for r in same.collect()) == list(range(100))


def test_passes_are_stable(spark):
    df = spark.range(500, numPartitions=1).select("id", (F.col("id") % 3).alias("x"))
    with Scratch(spark, "test") as scratch:
        got = radix_sort(scratch, df, [F.col("x")], 2, 4).orderBy("pos").collect()
    assert [(r.x, r.id) for r in got] == sorted((i % 3, i) for i in range(500))


def test_documents_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = op13_importance_resampling(spark, SF_DIR)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target)


def test_awkward_rows(spark):
    """Repeated rows tie; null texts have no features; without target texts and without rows the result is defined."""
    target = spark.createDataFrame([("alpha beta gamma",), (None,), ("",)], "text string")
    many = awkward(spark)
    for _ in range(3):
        many = many.unionByName(many)
    got = sorted((tuple(r) for r in resample(many, target, percent=5).collect()), key=str)
    docs = [r for r in awkward_rows() for _ in range(8)]
    assert got == brute(docs, ["alpha beta gamma", None, ""]) and sum(r[4] is not None for r in got) == 5 * sum(len(words(t)) >= 20 for _, t in docs) // 100
    alone = resample(awkward(spark), target.limit(0)).collect()
    assert sorted((tuple(r) for r in alone), key=str) == brute(awkward_rows(), [])
    none = resample(awkward(spark).limit(0), target)
    assert none.count() == 0 and none.columns == ["doc_id", "n_features", "weight", "score", "rank"]
