
import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.llm.embeddings import Quantiser, learn_rotation, near_vectors, op10_embedding_near_dedup, table_shape

from fixtures import CLASHING, SF_DIR


def brute(rows, cosine=0.98):
    ok = {}
    for i, x, label in rows:
        if x is not None and label is not None and all(v is not None and np.isfinite(v) for v in x) and any(x):
            ok[i] = (np.array(x, float) / np.linalg.norm(np.array(x, float)), label)
    links, parent = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(ok)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            (x, lx), (y, ly) = ok[i], ok[j]
            if lx == ly and len(x) == len(y) and x @ y >= cosine:
                links[i] += 1
                links[j] += 1
                one, two = sorted((find(i), find(j)))
                parent[two] = one
    return {i: (links[i], find(i), find(i) == i) for i in links}


def vectors(count=700, dim=32):
    """Families of near copies, exact copies and lone vectors."""
    rng = np.random.default_rng(2)
    rows = []
    while len(rows) < count:
        base = rng.standard_normal(dim)
        for _ in range(int(rng.choice([1, 1, 1, 2, 3, 60]))):
            x = base + rng.standard_normal(dim) * float(rng.choice([0, 0.05, 0.1, 0.18]))
            rows.append((len(rows), x.astype(np.float32).tolist(), int(rng.integers(3) if len(rows) % 50 == 0 else 1)))
    return rows


def test_recall_and_no_false_link(spark):
    rows = vectors()
    want = brute(rows)
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert len(got) == len(rows) and all(got[i].n_links <= want[i][0] for i in want)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(w[0] for w in want.values()) > 1000
    assert sum((r.component_id, r.kept) == want[i][1:] for i, r in got.items()) >= 0.97 * len(rows)


def test_exact_copies_are_counted_whole(spark):
    x = [0.5, -1.0, 2.0, 0.25]
    rows = [(n, x, 1) for n in range(1500)] + [(5000, [2 * v for v in x], 1), (6000, x, 2)]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got[7].n_links == 1500 and got[5000].n_links == 1500 and got[5000].component_id == 0 and got[6000].n_links == 0


def test_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    want = brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op10_embedding_near_dedup(spark, SF_DIR).collect()} == want


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1),
            (9, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.01], 1), (11, [1.0, 0.0], 2), (12, [1e38, 1e36], 1), (13, [1e-38, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in CLASHING:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    want = {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 9, 11)}
    assert {i: got[i] for i in want} == want
    assert [got[i] for i in (8, 10, 12, 13)] == [(3, 8, True), (3, 8, False), (3, 8, False), (3, 8, False)]
    nulls = near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (8, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in nulls) == [("8", 1, "8"), ("8", 1, "8"), ("None", 0, "None")]
    assert near_vectors(df.limit(0)).count() == 0


def test_bits_are_balanced_and_close_vectors_share_keys():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 24)) * np.linspace(0.2, 2, 24) + 1
    mean, projection = learn_rotation(x, 24, 1)
    balance = ((x - mean) @ projection >= 0).mean(axis=0)
    assert (abs(balance - 0.5) < 0.05).all() and np.allclose(projection.T @ projection, np.eye(24))
    tables, bits = table_shape(3000, 0.98, 0.99)
    keys = Quantiser(x, 24, tables, bits).keys(np.vstack([x[:200], x[:200] + rng.standard_normal((200, 24)) * 0.05]))
    assert keys.shape[0] == 400 and keys.shape[1] >= tables and (keys[:200] == keys[200:]).any(axis=1).mean() > 0.97


def test_recall_of_vectors_in_a_narrow_cone(spark):
    """All vectors point nearly the same way, so their centred directions differ more than their own."""
    rng = np.random.default_rng(4)
    rows = [(n, (rng.standard_normal(16) * 0.08 + 1).astype(np.float32).tolist(), 0) for n in range(150)]
    want = brute(rows, 0.995)
    got = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), cosine=0.995).collect()}
    assert sum(got.values()) >= 0.95 * sum(w[0] for w in want.values()) > 100 and all(got[i] <= want[i][0] for i in got)


def test_keys_grow_with_the_table():
    assert table_shape(10**9, 0.98, 0.99)[1] == 30 and table_shape(1, 0.98, 0.99)[1] == 8



def test_recall_that_is_not_reached_is_an_error(monkeypatch):
    monkeypatch.setattr(Quantiser, "_recall", lambda self, probes, cosine: 0.5)
    with pytest.raises(ValueError, match="0.5000"):
        Quantiser(np.zeros((0, 8)), 8, 2, 10)


def test_keys_longer_than_32_bits():
    x = np.random.default_rng(1).standard_normal((500, 16))
    keys = Quantiser(x, 16, 4, 52).keys(x)
    assert keys.dtype == np.int64 and keys.min() >= 0 and keys.max() >= 2**40
