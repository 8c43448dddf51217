"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages, runs of ``PASSAGE_WORDS`` words. Every passage is encoded as a vector: shares of kinds of
characters, lengths, repeats of words, and a hashed histogram of byte pairs. Only the document carries a label. Gated
attention, ``w . (tanh(V h) * sigmoid(U h))`` turned into weights by a softmax over the bag, decides how much each
passage counts; the weighted mean of the passages goes through a logistic layer. All parameters are learned together
from document labels by gradient descent, so a short stretch of junk in a long text can decide its score.

Fitting takes a bounded sample: at most ``FIT_ROWS`` texts of either label and ``FIT_PASSAGES`` evenly spread passages of
each, gathered in the driver as numbers (about 6 KB a text). The loss weighs the labels by their true frequencies, so
scores are probabilities. Scoring encodes every passage of every whole text in the tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import map_texts, table, use_text_batches
from tremorlake.llm.toxicity import labelled_sample

FIT_ROWS = 1500
FIT_PASSAGES = 32
PASSAGE_WORDS = 64
#: A document is predicted good from this score on.
GOOD = 0.3
HIDDEN = 12
STEPS = 720
BATCH = 128
RATE = 0.01
DECAY = 1e-4
PAIRS = 32
_KINDS = 7
SIZE = _KINDS + 5 + PAIRS


def _kinds() -> np.ndarray:
    """The kind of every byte: 0 other, 1 white space, 2 upper case, 3 lower case, 4 digit, 5 sentence mark, 6 symbol, 7 beyond ASCII."""
    kind = np.zeros(256, np.int64)
    kind[list(b" \t\n\x0b\x0c\r")] = 1
    kind[65:91], kind[97:123], kind[48:58] = 2, 3, 4
    kind[[b for b in range(33, 127) if kind[b] == 0]] = 6
    kind[list(b".,;:?!'\"")] = 5
    kind[128:] = 7
    return kind


_KIND = _kinds()


def encode(text: str | None) -> np.ndarray:
    """One row of ``SIZE`` numbers per passage; a text without words has one row of zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.zeros((1, SIZE))
    b = np.frombuffer(data, np.uint8)
    kind = _KIND[b]
    inside = kind != 1
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    first = starts[::PASSAGE_WORDS].copy()
    first[0] = 0
    n = len(first)
    passage = np.repeat(np.arange(n), np.diff(np.append(first, len(b))))
    counts = np.bincount(passage * 8 + kind, minlength=8 * n).reshape(n, 8).astype(float)
    lines = np.bincount(passage[b == 10], minlength=n)
    own = np.arange(len(words)) // PASSAGE_WORDS
    size = np.bincount(own, minlength=n).astype(float)
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])])
    order = np.lexsort((hashes, own))
    fresh = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (own[order][1:] != own[order][:-1])])
    chars = np.maximum(counts.sum(axis=1), 1)
    code = (b[:-1].astype(np.int64) * 31 + b[1:] * 7) % PAIRS
    pairs = np.bincount(passage[:-1] * PAIRS + code, minlength=PAIRS * n).reshape(n, PAIRS)
    return np.column_stack([
        counts[:, 1:] / chars[:, None], chars / size / 10, np.bincount(own[order], fresh, minlength=n) / size,
        np.bincount(own, same, minlength=n) / size, lines / size, size / PASSAGE_WORDS, np.sqrt(pairs / chars[:, None])])


class Model:
    """Scale of the passage vectors, gates ``v`` and ``u`` with ``w``, and the logistic layer ``c``, ``b``."""

    NAMES = ("v", "u", "w", "c", "b")

    def __init__(self, mean: np.ndarray, scale: np.ndarray, parts: dict[str, np.ndarray]):
        self.mean, self.scale, self.parts = mean, scale, parts

    @staticmethod
    def constant(share: float) -> Model:
        """Scores every text with the share of good labels."""
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(np.zeros(SIZE), np.ones(SIZE), {"v": np.zeros((SIZE, 1)), "u": np.zeros((SIZE, 1)), "w": np.zeros(1), "c": np.zeros(SIZE),
                                                     "b": np.array([np.log(share / (1 - share))])})

    def prepared(self, passages: np.ndarray) -> np.ndarray:
        return np.clip((passages - self.mean) / self.scale, -6, 6)

    def attention(self, h: np.ndarray, mask: np.ndarray | None = None):
        """(weights of the passages, the two gates) for ``h`` of shape (..., passages, size)."""
        one, two = np.tanh(h @ self.parts["v"]), 1 / (1 + np.exp(-np.clip(h @ self.parts["u"], -30, 30)))
        e = (one * two) @ self.parts["w"]
        if mask is not None:
            e = np.where(mask, e, -1e9)
        a = np.exp(e - e.max(axis=-1, keepdims=True))
        return a / a.sum(axis=-1, keepdims=True), one, two

    def score(self, passages: np.ndarray) -> float:
        h = self.prepared(passages)
        a, _, _ = self.attention(h)
        logit = float(a @ h @ self.parts["c"] + self.parts["b"][0])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def gradient(self, h: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross entropy over a batch of padded bags."""
        a, one, two = self.attention(h, mask)
        z = np.einsum("bk,bkd->bd", a, h)
        p = 1 / (1 + np.exp(-np.clip(z @ self.parts["c"] + self.parts["b"][0], -30, 30)))
        out = weight * (p - y) / weight.sum()
        toward = np.einsum("bkd,d->bk", h, self.parts["c"]) * out[:, None]
        energy = a * (toward - (a * toward).sum(axis=1, keepdims=True))
        gate = energy[..., None] * self.parts["w"]
        flat = h.reshape(-1, h.shape[-1])
        return {"v": flat.T @ (gate * two * (1 - one ** 2)).reshape(-1, one.shape[-1]),
                "u": flat.T @ (gate * one * two * (1 - two)).reshape(-1, one.shape[-1]),
                "w": np.einsum("bkl,bk->l", one * two, energy), "c": z.T @ out, "b": np.array([out.sum()])}

    @staticmethod
    def train(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, steps: int = STEPS, seed: int = 11) -> Model:
        """Gradient descent with running moments (Adam) over shuffled batches of bags."""
        rng = np.random.default_rng(seed)
        every = np.concatenate(bags)
        shape = {"v": (SIZE, HIDDEN), "u": (SIZE, HIDDEN), "w": (HIDDEN,), "c": (SIZE,), "b": (1,)}
        model = Model(every.mean(axis=0), every.std(axis=0) + 1e-3, {
            k: rng.normal(0, 0.2, s) if k in ("v", "u", "w") else np.zeros(s) for k, s in shape.items()})
        longest = max(map(len, bags))
        h, mask = np.zeros((len(bags), longest, SIZE)), np.zeros((len(bags), longest), bool)
        for i, bag in enumerate(bags):
            h[i, :len(bag)], mask[i, :len(bag)] = model.prepared(bag), True
        first = {k: np.zeros(s) for k, s in shape.items()}
        second = {k: np.zeros(s) for k, s in shape.items()}
        order = np.zeros(0, int)
        for step in range(1, steps + 1):
            if len(order) == 0:
                order = rng.permutation(len(bags))
            pick, order = order[:BATCH], order[BATCH:]
            for k, g in model.gradient(h[pick], mask[pick], y[pick], weight[pick]).items():
                g = g + (DECAY * model.parts[k] if k != "b" else 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g ** 2
                model.parts[k] = model.parts[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return model


def spread(passages: np.ndarray, most: int) -> np.ndarray:
    """At most so many passages, evenly over the text."""
    return passages if len(passages) <= most else passages[np.linspace(0, len(passages) - 1, most).astype(int)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        fit_rows: int = FIT_ROWS, folds: bool = True) -> Model:
    """Learn from labelled rows of the training folds; with one label or none, the model is constant."""
    use_text_batches(docs.sparkSession)

    def work(batch):
        return {"label": batch["toxic"], "bag": [spread(encode(t), FIT_PASSAGES).astype(np.float32).tobytes() for t in batch["text"]]}

    known = labels.where(F.col(label_col).isin(0, 1))
    if folds:
        known = known.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0)
    totals = {int(r[0]): r[1] for r in known.groupBy(label_col).count().collect()}
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, fit_rows, folds)
    # at most 2 * fit_rows bags of at most FIT_PASSAGES vectors
    rows = map_texts(sample, ["toxic", "text"], [("label", T.IntegerType()), ("bag", T.BinaryType())], lambda: work).collect()
    rows.sort(key=lambda r: (bytes(r.bag), r.label))
    y = np.array([r.label for r in rows], float)
    if len(set(y)) < 2:
        # as many labels of either kind as the sample holds; an unlabelled corpus is taken for good
        return Model.constant((sum(y) + 1) / (len(y) + 1))
    taken = {label: float((y == label).sum()) for label in (0, 1)}
    weight = np.where(y == 1, totals[1] / taken[1], totals[0] / taken[0])
    return Model.train([np.frombuffer(r.bag, np.float32).reshape(-1, SIZE).astype(float) for r in rows], y, weight)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row; the label is read from training rows only.

    Null, empty and blank texts are a bag with one zero vector and get its score. A null id is not held out and carried
    through; repeated rows are scored each for itself. Labels other than 0 and 1, labels of unknown ids and repeated
    labels (the higher counts) do no harm. Other columns are not read. An empty table gives an empty result.
    """
    model = fit(docs, labels, id_col, text_col, label_col)

    def make():
        return lambda batch: {"id": batch["id"], "score": [model.score(encode(t)) for t in batch["text"]]}

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = map_texts(named, ["id", "text"], [("id", docs.schema[id_col].dataType), ("score", T.DoubleType())], make)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select(F.col("id").alias(id_col), held_out.alias("held_out"), "score", F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
