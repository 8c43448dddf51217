"""Near duplicates by a signature-coordinate inverted join, with links confirmed on the full shingle sets.

A document's signature has ``COORDS`` coordinates. Every (coordinate, value) pair is a token; documents are
posted under their tokens and two documents collide once per token they share. A pair is a candidate when it
collides ``MATCH`` times. Two rules keep the merge short without losing such a pair:

* skip: a token that one document alone holds cannot collide, and a document with fewer than ``MATCH`` shared
  tokens cannot be in a pair;
* prefix: with the tokens of all documents in one order (rarest first), two documents with ``MATCH`` collisions
  share a token among the first ``COORDS - MATCH + 1`` of each. Only these are posted, so tokens of passages that
  thousands of documents repeat are posted by documents that hold nothing rarer.

At a Jaccard similarity of 0.85 a pair has fewer than 30 of 48 collisions with a probability of about 0.00003.

Candidates also compare odd sketches: a bit vector in which every shingle flips one bit. Two vectors differ in at most
as many bits as the sets differ in shingles, so a larger distance rules a link out for certain.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import Scratch, components, map_texts, shingles, sized_join, table, use_text_batches

COORDS = 48
MATCH = 30
SKETCH_BITS = 1024
#: Documents of one posting that meet in one group at most on each side; longer postings are cut into pairs of such blocks.
BLOCK_ROWS = 512
#: Ids of candidate documents are copied to the executors up to this counted number (8 bytes each).
COPIED_IDS = 2_000_000


def _coefficients(coords: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(85)
    a = rng.integers(0, 1 << 63, coords, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, coords, dtype=np.uint64)[:, None]


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest hash of the set under each coordinate's function, 32 bits each."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 2048):
        low = np.minimum(low, (values[None, start:start + 2048] * a + b).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """One bit per cell of the hash range, set when an odd number of values falls there; as 64-bit words."""
    odd = np.bincount((values >> np.uint64(54)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, coords: int) -> DataFrame:
    """(id, n, digest of the set, sig, odd): the last three are null for an empty set."""

    def make():
        import xxhash

        a, b = _coefficients(coords)

        def work(batch):
            n, digest, sig, odd = [], [], [], []
            for text in batch[text_col]:
                values = shingles(text, words)
                n.append(len(values))
                digest.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                sig.append(signature(values, a, b) if len(values) else None)
                odd.append(odd_sketch(values) if len(values) else None)
            return {"id": batch[id_col], "n": n, "digest": digest, "sig": sig, "odd": odd}

        return work

    return map_texts(docs, [id_col, text_col], [
        ("id", T.LongType()), ("n", T.LongType()), ("digest", T.BinaryType()), ("sig", T.ArrayType(T.IntegerType())),
        ("odd", T.ArrayType(T.LongType()))], make)


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    def make():
        return lambda batch: {"id": batch[id_col], "shingles": [shingles(t, words).view(np.int64) for t in batch[text_col]]}

    return map_texts(docs, [id_col, text_col], [("id", T.LongType()), ("shingles", T.ArrayType(T.LongType()))], make)


def candidates(classes: DataFrame, coords: int, match: int) -> DataFrame:
    """(id, n, short, odd, prefix, central) of every class that shares enough tokens with others.

    ``central`` adds up how many classes hold each of its tokens: largest for the document that copies were made of.
    """
    tokens = classes.select("id", F.posexplode("sig").alias("c", "v")).select(
        "id", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v").cast("long") + F.lit(1 << 31)).alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = tokens.join(shared, "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t")).where(
        F.size("t") >= match)
    return classes.join(own, "id").select(
        "id", "n", F.transform("sig", lambda x: (x.bitwiseAND(F.lit(255)) - 128).cast("byte")).alias("short"), "odd",
        F.transform(F.slice("t", 1, F.size("t") - (match - 1)), lambda x: x["token"]).alias("prefix"),
        F.aggregate("t", F.lit(0).cast("long"), lambda s, x: s + x["df"]).alias("central"))


def _linkable(match: int, percent: int) -> F.Column:
    """Size, collisions (one byte per coordinate: never too few) and sketch distance allow a link."""
    size = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    collisions = F.aggregate(F.zip_with("a_short", "b_short", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    apart = F.aggregate(F.zip_with("a_odd", "b_odd", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    # |A xor B| <= (1 - j) / (1 + j) * (|A| + |B|) for a similarity of j
    return size & ((100 + percent) * apart <= (100 - percent) * (F.col("a_n") + F.col("b_n"))) & (collisions >= match)


def _side(rows: DataFrame, side: str, *names: str) -> DataFrame:
    return rows.select(F.explode("prefix").alias("token"), *(F.col(c).alias(f"{side}_{c}") for c in names))


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def star_pairs(rows: DataFrame, match: int, percent: int) -> DataFrame:
    """Each token's documents against its most central one."""
    best = F.struct((-F.col("a_central")).alias("o"), "a_id", "a_n", "a_short", "a_odd")
    centre = _side(rows, "a", "central", "id", "n", "short", "odd").groupBy("token").agg(F.min(best).alias("x")).select("token", "x.*")
    return _pairs(_side(rows, "b", "id", "n", "short", "odd").join(centre, "token").where(F.col("a_id") != F.col("b_id"))
                  .where(_linkable(match, percent)))


def lone_shingles(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, lone): how many shingles of a document of ``rows`` no other of them holds. Zero for ids that repeat."""
    own = sets.join(rows.select("id").distinct(), "id", "left_semi")
    once = own.groupBy("id").agg(F.count(F.lit(1)).alias("times"))
    alone = own.select("id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("id").alias("id")).where("df = 1")
    return alone.groupBy("id").agg(F.count(F.lit(1)).alias("n")).join(once.where("times = 1"), "id").select("id", F.col("n").alias("lone"))


def open_postings(rows: DataFrame, lone: DataFrame, percent: int) -> DataFrame:
    """``rows`` once per token and cell in which they may have a partner in another component, with the posting's size.

    A document that alone holds some of its n shingles shares at most the r others, so a link asks of both
    (100 + percent) * r >= percent * (n + n of the partner): ``reach`` is the largest partner a document can have. A
    posting holds the documents of a token and one class of sizes, and those of the class below (``below``); linked
    sizes are never further apart. Documents that the posting's smallest size or largest reach rules out leave it.
    """
    r = F.col("n") - F.coalesce("lone", F.lit(0))
    width = max(0.01, math.log(100 / percent) * 1.000001)
    sized = rows.join(lone, "id", "left").select(
        *rows.columns, F.floor(((100 + percent) * r - percent * F.col("n")) / percent).alias("reach"), F.floor(F.log("n") / width).alias("size"))
    posted = sized.withColumn("token", F.explode("prefix")).withColumn("below", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn(
        "cell", F.col("size") + F.col("below").cast("long"))
    range_ = posted.groupBy("token", "cell").agg(
        F.min("n").alias("least"), F.max("reach").alias("most"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.bool_or(~F.col("below")).alias("own")).where("own and lo <> hi").drop("own", "lo", "hi")
    alive = posted.join(range_, ["token", "cell"]).where("least <= reach and n <= most").drop("least", "most", "reach", "size")
    counted = alive.groupBy("token", "cell").agg(
        F.count(F.lit(1)).alias("posted"), F.bool_or(~F.col("below")).alias("own")).where("own and posted > 1").drop("own")
    return alive.join(counted, ["token", "cell"])


def cross_pairs(postings: DataFrame, match: int, percent: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All linkable pairs that share a token and lie in different components, each at its first common token.

    A posting is cut into blocks by a hash, and blocks meet in pairs: no group holds more than about ``block_rows``
    documents of each side, however many hold the token.
    """
    blocks = F.ceil(F.col("posted") / block_rows).cast("int")
    cut = postings.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    key = ["token", "cell", "same", "i", "j"]

    def side(name: str, rows: DataFrame, met: F.Column) -> DataFrame:
        return rows.withColumn("m", F.explode(met)).select(
            "token", "cell", "m.*", *(F.col(c).alias(f"{name}_{c}") for c in ("id", "n", "short", "odd", "prefix", "comp")))

    def struct(same: bool, i: F.Column, j: F.Column) -> F.Column:
        return F.struct(F.lit(same).alias("same"), i.alias("i"), j.alias("j"))

    block, last = F.col("block"), F.col("blocks") - 1
    own, below = cut.where(~F.col("below")), cut.where(F.col("below"))
    left = side("a", own, F.concat(F.transform(F.sequence(block, last), lambda j: struct(True, block, j)),
                                   F.transform(F.sequence(F.lit(0), last), lambda j: struct(False, block, j))))
    right = side("b", own, F.transform(F.sequence(F.lit(0), block), lambda i: struct(True, i, block))).unionByName(
        side("b", below, F.transform(F.sequence(F.lit(0), last), lambda i: struct(False, i, block))))
    once = ~F.col("same") | (F.col("i") < F.col("j")) | (F.col("a_id") < F.col("b_id"))
    first = F.element_at(F.array_intersect("a_prefix", "b_prefix"), 1) == F.col("token")
    return _pairs(left.join(right, key).where(once & (F.col("a_comp") != F.col("b_comp"))).where(_linkable(match, percent)).where(first))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(right, "b").join(left, "a").where(
        100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, words: int = 5,
    coords: int = COORDS, match: int = MATCH,
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their ``words``-word shingle sets; a
    component holds all that links reach and is named by its smallest id, whose document is kept.

    Equal sets form one class and are represented by the smallest id, so copies never meet pairwise. Inside a token
    every class is first tested against the most central one; tokens whose documents then lie in one component are
    done. Of the others, pairs of one token in different components are tested in full, so no link between components
    is lost, and a large group of copies of one document costs one test per member and token. Documents that hold too
    many shingles alone for any partner of their posting leave it first, as those made from a template do; what
    remains of a long posting meets in pairs of blocks, in as many tasks as it needs.

    Null, empty or blank texts: n_shingles 0, linked with nothing, kept. Rows with a null id: component_id null, kept,
    linked with nothing. Rows that repeat an id count as one document: a link of one holds for all. An empty table
    gives an empty result. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    use_text_batches(spark)
    scratch = Scratch(spark, "minhash")
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = scratch.stage(signatures(named, "id", "text", words, coords), "signatures", keep=True)
    classes = scratch.stage(
        sig.where("n > 0 and id is not null").groupBy("digest").agg(
            F.min("id").alias("id"), F.max("n").alias("n"), F.min_by(F.struct("sig", "odd"), "id").alias("s")).select(
            "digest", "id", "n", "s.*"), "classes", keep=True)
    rows = scratch.stage(candidates(classes, coords, match), "candidates")
    sets = scratch.stage(shingle_sets(sized_join(
        named.where("id is not null"), rows.select("id").distinct(), ["id"], "left_semi", COPIED_IDS), "id", "text", words), "sets")
    links = scratch.stage(confirm(star_pairs(rows, match, percent), sets, percent), "links")
    labels = scratch.stage(components(scratch, links), "labels", keep=True)
    rest = scratch.stage(_unresolved(rows, labels), "open")
    if not rest.isEmpty():
        postings = scratch.stage(open_postings(rest, lone_shingles(rest, sets), percent), "postings")
        more = scratch.stage(confirm(cross_pairs(postings, match, percent), sets, percent), "links")
        if not more.isEmpty():
            labels = scratch.stage(components(scratch, links.unionByName(more)), "labels", keep=True)
    scratch.close()

    member = sig.select("id", "n", "digest").join(classes.select("digest", F.col("id").alias("rep")), "digest", "left")
    member = member.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "rep", "id"))
    return member.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _unresolved(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidates with those of their prefix tokens whose documents are still in more than one component."""
    labelled = rows.join(labels, "id", "left").withColumn("comp", F.coalesce("component_id", "id")).drop("component_id")
    posted = labelled.select("id", "comp", F.explode("prefix").alias("token"))
    mixed = posted.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    kept = posted.join(mixed, "token", "left_semi").groupBy("id").agg(F.collect_list("token").alias("mixed"))
    # array_intersect keeps the order of the prefix, which all documents share
    return labelled.join(kept, "id").withColumn("prefix", F.array_intersect("prefix", "mixed")).drop("mixed")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
