import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tremorlake.llm.attention import PASSAGE_WORDS, SIZE, Model, encode, fit, op11_quality_classifier, quality, spread

from fixtures import SF_DIR, awkward, awkward_rows


def prose(rng, n):
    return " ".join("".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(n))


def junk(rng, n):
    return " ".join(rng.choice(["BUY!!", "NOW!!", "$$$", "###", "x|y"]) for _ in range(n))


def corpus(spark, n=500):
    """A fifth is prose with one passage of junk in it."""
    rng = random.Random(5)
    docs = []
    for i in range(n):
        parts = [prose(rng, PASSAGE_WORDS) for _ in range(rng.randint(2, 20))]
        if i % 5 == 2:
            parts[rng.randrange(len(parts))] = junk(rng, PASSAGE_WORDS)
        docs.append((i, "\n".join(parts)))
    labels = spark.createDataFrame([(i, int(i % 5 != 2)) for i in range(n)], "doc_id long, quality int")
    return spark.createDataFrame(docs, "doc_id long, text string"), labels


def test_passages_equal_plain_counts():
    rng = random.Random(1)
    text = "  Ein Ein 12 é.\n\nTwo  " + prose(rng, 150) + " A A A\t"
    got, words = encode(text), text.encode().split()
    assert got.shape == (-(-len(words) // PASSAGE_WORDS), SIZE) and np.isfinite(got).all()
    for n, row in enumerate(got):
        own = words[n * PASSAGE_WORDS:(n + 1) * PASSAGE_WORDS]
        assert np.isclose(row[8], len(set(own)) / len(own)) and np.isclose(row[11], len(own) / PASSAGE_WORDS)
        assert np.isclose(row[9], sum(a == b for a, b in zip(own, own[1:])) / len(own))
    chars = np.array([r[7] * 10 * r[11] * PASSAGE_WORDS for r in got])
    assert np.isclose(chars.sum(), len(text.encode()))
    assert np.isclose((got[:, 1] * chars).sum(), sum(c.isupper() and c.isascii() for c in text))
    assert np.isclose((got[:, 10] * got[:, 11] * PASSAGE_WORDS).sum(), text.count("\n"))
    for empty in (None, "", " \n\t"):
        assert encode(empty).shape == (1, SIZE) and not encode(empty).any()


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    h, mask = rng.normal(size=(5, 4, SIZE)), rng.random((5, 4)) < 0.8
    mask[:, 0] = True
    y, weight = np.array([0.0, 1, 1, 0, 1]), rng.random(5) + 0.5
    model = Model(np.zeros(SIZE), np.ones(SIZE), {"v": rng.normal(size=(SIZE, 3)), "u": rng.normal(size=(SIZE, 3)), "w": rng.normal(size=3),
                                                  "c": rng.normal(size=SIZE) * 0.2, "b": np.array([0.1])})

    def loss():
        a, _, _ = model.attention(h, mask)
        p = 1 / (1 + np.exp(-(np.einsum("bk,bkd->bd", a, h) @ model.parts["c"] + model.parts["b"][0])))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    for name, g in model.gradient(h, mask, y, weight).items():
        for at in list(np.ndindex(g.shape))[:: max(1, g.size // 12)]:
            kept = model.parts[name][at]
            model.parts[name][at] = kept + 1e-5
            up = loss()
            model.parts[name][at] = kept - 1e-5
            down = loss()
            model.parts[name][at] = kept
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_one_bad_passage_decides(spark):
    """Held-out documents, and more weight for the passage of junk than an equal share."""
    docs, labels = corpus(spark)
    got = quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    # of the held-out documents with junk, its passage gets far more than an equal share
    model, share = fit(docs, labels), []
    for r in docs.where("doc_id % 5 = 2 and crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect():
        parts = r.text.split("\n")
        a, _, _ = model.attention(model.prepared(encode(r.text)))
        assert len(a) == len(parts) and np.isclose(a.sum(), 1)
        share.append(a[next(n for n, p in enumerate(parts) if p.upper() == p or "$" in p)] * len(a))
    assert len(share) > 10 and np.mean(share) > 1.5


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark, 200)
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id, r.score) for r in quality(docs, x).collect()) for x in (labels, other))
    assert one == two


def test_long_texts_are_fitted_on_spread_passages_and_scored_whole():
    rng = random.Random(3)
    passages = encode(prose(rng, 100 * PASSAGE_WORDS))
    few = spread(passages, 32)
    assert len(passages) == 100 and len(few) == 32 and (few[0] == passages[0]).all() and (few[-1] == passages[-1]).all()


def test_awkward_rows(spark):
    docs, labels = corpus(spark, 100)
    got = quality(awkward(spark), labels).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 5), (3, 1), (3, 0)], "doc_id long, quality int")
    assert quality(awkward(spark), odd).count() == len(awkward_rows())
    assert quality(awkward(spark), labels.limit(0)).where("predicted = 0").count() == 0
    assert quality(docs.limit(0), labels).count() == 0


def test_given_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = op11_quality_classifier(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").groupBy("quality", "predicted").count().collect()
    seen = {(r.quality, r.predicted): r["count"] for r in got}
    right = seen.get((0, 0), 0) + seen.get((1, 1), 0)
    assert right >= 0.98 * sum(seen.values()) and seen.get((1, 0), 0) <= 7
    assert op11_quality_classifier(spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
