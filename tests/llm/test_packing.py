import itertools
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tremorlake.llm.bpe import RANK_FILE, encode, encoding
from tremorlake.llm.packing import best_boundaries, op9_packing, pack, pack_tokens

from fixtures import SF_DIR, awkward, awkward_rows, documents, texts


def padding(lengths, counts, bounds):
    return sum((min(b for b in bounds if b >= n) - n) * c for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(150):
        lengths = sorted(rng.sample(range(1, 40), rng.randint(1, 9)))
        counts = [rng.randint(1, 9) for _ in lengths]
        buckets = rng.randint(1, 5)
        best = min(padding(lengths, counts, [*cut, lengths[-1]]) for r in range(min(buckets, len(lengths)))
                   for cut in itertools.combinations(lengths[:-1], r))
        bounds = best_boundaries(np.array(lengths), np.array(counts), buckets)
        assert len(bounds) <= buckets and bounds[-1] == lengths[-1] and padding(lengths, counts, bounds) == best


def check(rows, sizes, max_length, budget):
    """Every document is there once and whole, batches keep the budget, slots are dense."""
    held, batches = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r.doc_id].append((r.start, r.n_tokens))
        batches[r.batch_id].append(r)
        assert r.start == r.piece * max_length and 0 < r.n_tokens <= min(r.bucket_length, max_length)
    for i, size in sizes.items():
        ends = sorted(held.pop(i, []))
        assert sum(n for _, n in ends) == size and all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))
    assert not held
    short = defaultdict(int)
    for batch in batches.values():
        assert len({r.bucket_length for r in batch}) == 1
        capacity = max(1, budget // batch[0].bucket_length)
        assert sorted(r.slot for r in batch) == list(range(len(batch))) and len(batch) <= capacity
        short[batch[0].bucket_length] += len(batch) < capacity
    assert sorted(batches) == list(range(len(batches))) and max(short.values(), default=0) <= 1


def test_documents(spark):
    check(op9_packing(spark, SF_DIR).collect(), token_sizes(texts(spark)), 4096, 32768)
    words = {i: len(t.split()) for i, t in texts(spark).items()}
    check(pack(documents(spark), max_length=100, buckets=5, budget=900).collect(), words, 100, 900)


def test_one_length_holds_all(spark):
    """Ties: one bucket with all rows, numbered in several shards."""
    df = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    check(pack(df, budget=30).collect(), {i: 3 for i in range(50_000)}, 4096, 30)


def test_awkward_rows(spark):
    got = pack(awkward(spark)).collect()
    assert not {1, 2, 3} & {r.doc_id for r in got}
    assert sum(r.n_tokens for r in got if r.doc_id == 9) == 30_001 and sum(r.doc_id == 6 for r in got) == 2
    assert sum(r.n_tokens for r in got) == sum(len((t or "").split()) for _, t in awkward_rows())
    columns = ["batch_id", "bucket_length", "doc_id", "n_tokens", "piece", "slot", "start"]
    assert sorted(pack(documents(spark).limit(0)).columns) == columns and pack(documents(spark).limit(0)).count() == 0
    assert sorted(got[0].asDict()) == columns


def token_sizes(texts):
    import public_tokenizers

    enc = encoding(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return {i: len(encode(enc, t or "")) for i, t in texts.items()}


def test_registered_uses_count_tokens(spark):
    sizes = token_sizes(texts(spark))
    assert sum(sizes.values()) > sum(len(t.split()) for t in texts(spark).values())
    check(op9_packing(spark, SF_DIR).collect(), sizes, 4096, 32768)
    check(corpus_pipeline.packing_stage(spark, documents(spark), SF_DIR).collect(), sizes, 4096, 32768)


def test_long_texts_without_blanks_are_cut_by_tokens(spark):
    rows = [(1, "日本語" * 20_000), (2, "x" * 200_000), (3, None), (4, ""), (5, "one word more")]
    sizes = token_sizes(dict(rows))
    got = pack_tokens(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(got, {i: n for i, n in sizes.items() if n}, 4096, 32768)
    assert all(sum(r.doc_id == i for r in got) == -(-sizes[i] // 4096) for i in sizes) and sum(r.doc_id == 2 for r in got) > 1


def test_awkward_rows_by_tokens(spark):
    got = pack_tokens(awkward(spark)).collect()
    assert sum(r.n_tokens for r in got) == sum(token_sizes(dict(enumerate(t for _, t in awkward_rows()))).values())
    assert sum(r.doc_id == 6 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1
    assert pack_tokens(documents(spark).limit(0)).count() == 0
