"""Embedding near duplicates: iterative quantisation, multi-index Hamming tables, and exact cosines at the end.

A rotation of the principal axes is learned so that the signs of the rotated, centred vectors are balanced bits that
lose little. The bits are cut into tables of short keys; vectors that agree in one key meet in a bucket. Only
there their original vectors are compared, in double precision. The key length follows the number of vectors, so
buckets stay short as the table grows; the number of tables follows from the wanted recall.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import Scratch, components, map_texts, table, use_text_batches

COSINE = 0.98
RECALL = 0.99
#: The rotation is fitted on at most so many vectors, chosen by a hash of their id; all vectors are indexed.
FIT_ROWS = 10_000
#: With fewer vectors of one dimension the directions are random instead.
LEAST_FIT = 100
#: Learned tables are added up to this multiple while the measured recall is short of the wanted one; then directions
#: through the origin take over, whose tables grow until it is reached. Beyond ``LAST_TIMES`` the search fails, with the figure.
MOST_TIMES = 3
LAST_TIMES = 64
#: Rows of one side of a bucket that are compared at once; larger buckets are cut into pairs of such blocks.
BLOCK_ROWS = 512


def learn_rotation(x: np.ndarray, bits: int, seed: int, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of iterative quantisation: alternate the nearest signs and the best rotation to them."""
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    v = centred @ axes
    rotation, _ = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))
    for _ in range(steps):
        signs = np.where(v @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(v.T @ signs)
        rotation = left @ right
    return mean, axes @ rotation


def table_shape(vectors: int, cosine: float, recall: float) -> tuple[int, int]:
    """(tables, key bits): short buckets for so many vectors, and the recall at the threshold for independent bits."""
    key = min(30, max(8, math.ceil(math.log2(max(2, vectors))) + 2))
    agree = (1 - math.acos(min(1.0, cosine)) / math.pi) ** key
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree))), key


class Quantiser:
    """Rotations for one dimension; more bits than dimensions are had from further rotations.

    Bits of real vectors are not independent, so the recall is measured on sampled vectors and copies of them turned
    to the threshold, and tables are added until it is reached.
    """

    def __init__(self, sample: np.ndarray, dim: int, tables: int, key_bits: int, cosine: float = COSINE, recall: float = RECALL):
        self.key_bits = key_bits
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        learned = len(sample) >= max(LEAST_FIT, 2 * dim) and self._reach(
            sample, sample[:1000], dim, tables, cosine, recall, MOST_TIMES) >= recall
        if not learned:
            # Too few to learn from, or vectors so close together that their centred directions tell nothing of
            # the cosine: directions through the origin, where a bit differs with the angle over pi.
            self.parts.clear()
            around = np.random.default_rng(dim).standard_normal((max(LEAST_FIT, 4 * dim), dim))
            around = np.concatenate([around, -around])
            probes = np.concatenate([_unit(around)[:1000], sample[:1000]])
            found = self._reach(around, probes, dim, tables, cosine, recall, LAST_TIMES)
            if found < recall:
                raise ValueError(f"{self.tables} tables of {dim} dimensions find {found:.4f} of the neighbours, {recall} is wanted")

    def _reach(self, sample: np.ndarray, probes: np.ndarray, dim: int, tables: int, cosine: float, recall: float, times: int) -> float:
        """The recall that was measured when it was enough, or when there were ``times`` the tables."""
        self._grow(sample, dim, tables)
        found = 1.0 if dim == 1 else self._recall(probes, cosine)
        while found < recall and self.tables < times * tables:
            self._grow(sample, dim, self.tables + max(1, tables // 2))
            found = self._recall(probes, cosine)
        return found

    def _grow(self, sample: np.ndarray, dim: int, tables: int) -> None:
        self.tables = tables
        while sum(p.shape[1] for _, p in self.parts) < tables * self.key_bits:
            self.parts.append(learn_rotation(sample, dim, len(self.parts) + 1))

    def _recall(self, probes: np.ndarray, cosine: float) -> float:
        aside = np.random.default_rng(9).standard_normal(probes.shape)
        aside -= (aside * probes).sum(axis=1, keepdims=True) * probes
        turned = cosine * probes + math.sqrt(1 - cosine * cosine) * _unit(aside)
        return float((self.keys(probes) == self.keys(turned)).any(axis=1).mean())

    def keys(self, x: np.ndarray) -> np.ndarray:
        bits = np.concatenate([(x - mean) @ projection >= 0 for mean, projection in self.parts], axis=1)
        # neighbours in one rotation go to different tables
        bits = bits[:, :self.tables * self.key_bits].reshape(len(x), self.key_bits, self.tables)
        return (bits.astype(np.int64) << np.arange(self.key_bits)[None, :, None]).sum(axis=1)


def _usable(embeddings: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, x): vectors that can link; x as doubles."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    finite = F.forall("x", lambda v: F.coalesce((F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v), F.lit(False)))
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), x.alias("x"))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(
        finite & F.exists("x", lambda v: v != 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _index(classes: DataFrame, quantisers: dict[int, Quantiser], shape: tuple[int, int], cosine: float, recall: float) -> DataFrame:
    """(id, label, dim, weight, keys, unit): the keys of every class, its unit vector as bytes."""

    def make():
        def work(batch):
            keys, unit = [None] * len(batch["x"]), [None] * len(batch["x"])
            at: dict[int, list[int]] = {}
            for n, dim in enumerate(batch["dim"]):
                at.setdefault(dim, []).append(n)
            for dim, places in at.items():
                if dim not in quantisers:
                    quantisers[dim] = Quantiser(np.zeros((0, dim)), dim, *shape, cosine, recall)
                rows = _unit(np.array([batch["x"][n] for n in places]))
                for n, key, row in zip(places, quantisers[dim].keys(rows), rows):
                    keys[n], unit[n] = key, row.tobytes()
            return {**{c: batch[c] for c in ("id", "label", "dim", "weight")}, "keys": keys, "unit": unit}

        return work

    return map_texts(classes, ["id", "label", "dim", "weight", "x"], [
        ("id", T.LongType()), ("label", T.StringType()), ("dim", T.IntegerType()), ("weight", T.LongType()),
        ("keys", T.ArrayType(T.LongType())), ("unit", T.BinaryType())], make)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable over the links inside one block pair."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _compare(groups: DataFrame, cosine: float) -> DataFrame:
    """(id, links, root) of the vectors that link inside a group of blocks.

    A pair counts in the first table in which its keys agree, so no pair counts twice.
    """

    def make():
        def work(batch):
            out_id, out_links, out_root = [], [], []
            for number, left, right, members in zip(batch["nth"], batch["left"], batch["right"], batch["members"]):
                ids = np.array([m["id"] for m in members])
                block = np.array([m["block"] for m in members])
                weight = np.array([m["weight"] for m in members])
                keys = np.array([m["keys"] for m in members])
                unit = np.frombuffer(b"".join(m["unit"] for m in members), np.float64).reshape(len(members), -1)
                one, two = np.flatnonzero(block == left), np.flatnonzero(block == right)
                i, j = np.nonzero(unit[one] @ unit[two].T >= cosine)
                a, b = one[i], two[j]
                if left == right:
                    a, b = a[a < b], b[a < b]
                if not len(a):
                    continue
                first = (keys[a] == keys[b]).argmax(axis=1) == number
                root = _roots(len(ids), a, b)
                links = np.bincount(a[first], weight[b[first]], len(ids)) + np.bincount(b[first], weight[a[first]], len(ids))
                touched = np.unique(np.concatenate([a, b]))
                out_id += ids[touched].tolist()
                out_links += links[touched].astype(np.int64).tolist()
                out_root += ids[root[touched]].tolist()
            return {"id": out_id, "links": out_links, "root": out_root}

        return work

    return map_texts(groups, ["nth", "left", "right", "members"], [
        ("id", T.LongType()), ("links", T.LongType()), ("root", T.LongType())], make)


def near_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``embeddings``.

    Vectors of equal label and length are linked at a cosine of ``cosine`` or more. Equal vectors of one label are a
    class that is searched once; its members link with each other and with all that the class links with.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without id or label, link with
    nothing: n_links 0, component_id the own id, kept. Rows that repeat an id count as vectors of their own and share
    what their ids reach. Other columns are not read; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    use_text_batches(spark)
    scratch = Scratch(spark, "vectors")
    usable = _usable(embeddings, id_col, vec_col, label_col).withColumn("dim", F.size("x")).withColumn(
        "same", F.sha2(F.to_json("x"), 256))
    classes = scratch.stage(usable.groupBy("label", "same").agg(
        F.min("id").cast("long").alias("id"), F.count(F.lit(1)).alias("weight"), F.min_by("x", "id").alias("x"), F.max("dim").alias("dim")).select(
        F.col("label").cast("string").alias("label"), "same", "id", "weight", "x", "dim"), "classes", keep=True)
    largest = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    shape = table_shape(largest, cosine, recall)
    # at most FIT_ROWS vectors
    sample: dict[int, list] = {}
    for row in classes.select("x").orderBy(F.xxhash64("id")).limit(FIT_ROWS).collect():
        sample.setdefault(len(row.x), []).append(row.x)
    quantisers = {dim: Quantiser(_unit(np.array(x)), dim, *shape, cosine, recall) for dim, x in sample.items()}

    indexed = scratch.stage(_index(classes, quantisers, shape, cosine, recall), "index")
    bucket = ["label", "dim", "nth", "key"]
    posted = indexed.select("id", "label", "dim", F.posexplode("keys").alias("nth", "key"))
    held = posted.groupBy(*bucket).agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    blocks = F.ceil(F.col("held") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    paired = posted.join(held, bucket).withColumn("blocks", blocks).withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", *bucket, "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    members = paired.join(indexed.select("id", "weight", "keys", "unit"), "id").groupBy(*bucket, "left", "right").agg(
        F.collect_list(F.struct("id", "block", "weight", "keys", "unit")).alias("members"))
    linked = scratch.stage(_compare(members.where(F.size("members") > 1), cosine), "linked")
    labels = scratch.stage(components(scratch, linked.select(F.col("id").alias("a"), F.col("root").alias("b"))), "labels", keep=True)
    links = scratch.stage(linked.groupBy("id").agg(F.sum("links").alias("links")), "links", keep=True)
    scratch.close()

    per_class = (classes.select("label", "same", "weight", F.col("id").alias("rep")).join(links.withColumnRenamed("id", "rep"), "rep", "left")
                 .join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
                     "label", "same", F.coalesce("component_id", "rep").alias("component"),
                     (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    row = embeddings.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"),
                            F.sha2(F.to_json(F.transform(vec_col, lambda v: v.cast("double"))), 256).alias("same"))
    component = F.coalesce(F.when(F.col("id").isNotNull(), F.col("component")), F.col("id").cast("long"))
    return row.join(per_class, ["label", "same"], "left").select(
        F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
