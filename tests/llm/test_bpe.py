import hashlib
import random

import numpy as np
import public_tokenizers
import regex

from tremorlake.llm.bpe import LONG_RUN, RANK_FILE, encode, encode_digests, encode_documents, encoding, length_histogram, op6_byte_bpe, op7_token_counts, safe_pieces

from fixtures import SF_DIR, awkward, awkward_rows, documents, texts

ENC = encoding(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
PATTERN = regex.compile(public_tokenizers.PATTERN)


def brute(text):
    """Every match of the pattern encoded for itself."""
    return [i for match in PATTERN.findall(text) for i in ENC._encode_single_piece(match)]


def test_random_texts_equal_brute_force():
    rng = random.Random(3)
    parts = [" ", "  ", "\n", " " * (LONG_RUN + 9), "\n" * LONG_RUN, "it's", "'s'll", "été", "日本語", "12345", "!!", "_", "__x", " ", "　", "\x1c", "x" * 7000, "9" * 6000,
             "#" * 5100, "\U0001F600", "<|endoftext|>"]
    for _ in range(40):
        text = "".join(rng.choices(parts, k=60))
        ids = encode(ENC, text)
        assert ids == brute(text) and ENC.decode_bytes(ids) == text.encode()


def test_pieces_put_together_are_the_text():
    text = "word and  more\n" * 400 + "x" * 5000
    pieces = list(safe_pieces(text, 100))
    assert "".join(pieces) == text and len(pieces) > 20 and max(map(len, pieces[:-1])) < 120


def test_runs_that_overflow_the_pattern_engine():
    for text in (" " * 1_500_000, " " * 1_500_000 + "x", "\n" * 1_000_000 + " a"):
        assert ENC.decode_bytes(encode(ENC, text)) == text.encode()


def test_documents_equal_the_library(spark):
    want = texts(spark)
    for r in op6_byte_bpe(spark, SF_DIR).collect():
        ids = brute(want[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(want[r.doc_id].encode()).hexdigest())


def test_awkward_rows(spark):
    got = encode_digests(awkward(spark)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == len(awkward_rows())
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty) for r in got if r.doc_id in (1, 2))
    want = sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in awkward_rows())
    assert sorted(r.decoded_sha256 for r in got) == want
    assert sorted(hashlib.sha256(r.decoded).hexdigest() for r in encode_documents(awkward(spark)).collect()) == want
    assert encode_digests(documents(spark).limit(0)).count() == 0


def test_histogram_answers_every_limit(spark):
    lengths = np.array([len(brute(t)) for t in texts(spark).values()])
    got = op7_token_counts(spark, SF_DIR).collect()
    assert sum(r.docs for r in got) == len(lengths) and sorted(r.length for r in got) == sorted(set(lengths.tolist()))
    for r in got:
        assert r.docs == (lengths == r.length).sum() and r.total_tokens == lengths.sum()
        assert r.docs_over == (lengths > r.length).sum() and r.tokens_over == lengths[lengths > r.length].sum()
        assert r.truncated_tokens == np.minimum(lengths, r.length).sum()
        assert (r.rank_low, r.rank_high) == ((lengths < r.length).sum() + 1, (lengths <= r.length).sum())


def test_histogram_of_ties_zeros_and_nothing(spark):
    got = {r.length: r for r in length_histogram(spark.createDataFrame([(0, 2), (5, 1), (5, 3), (4000, 1)], "length long, docs long")).collect()}
    assert got[0].truncated_tokens == 0 and got[5].docs == 4 and got[5].truncated_tokens == 25 and got[4000].tokens == 4000
    assert length_histogram(spark.createDataFrame([], "length long, docs long")).count() == 0
