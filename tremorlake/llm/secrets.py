"""Secret scan with corpus-wide ownership, in DataFrame functions only.

A regular expression splits a text into gaps and matches; running sums of their lengths give the places, in code
points, without any per-row code. The value of every candidate is hashed, and the distinct repositories and owners
that hold it are counted over the whole corpus: a value that many owners hold, or many repositories of whatever owner, is
a copied example; any other is live-looking. Loose candidates (long tokens that mix cases and digits) become spans only when
their ownership says live.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tremorlake.llm.common import Scratch, sized_join, table

#: A value held by this many owners is a copied example.
EXAMPLE_OWNERS = 3
#: So is one that stands in this many repositories, be they of one owner.
EXAMPLE_REPOS = 4
#: Digests of widely held values are copied to the executors up to this counted number (64 bytes each).
COPIED_VALUES = 500_000
#: Ids of documents with spans are copied to the executors up to this counted number.
COPIED_IDS = 2_000_000

_ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
           r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: (kind, pattern whose matches do not overlap, group that is the value), in the order of ties.
KINDS = [
    ("assign", _ASSIGN, 2),
    ("access", r"AKIA[A-Z0-9]{16,}", 0),
    ("hex", r"[0-9a-f]{24,}", 0),
    ("key", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])", 0),
]
BASE = ("assign", "access", "hex")


def _found(text: Column, kind: str, pattern: str, group: int) -> Column:
    """The matches of one kind with the length of the gap before each; null when there is none."""
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(whole)), F.length).alias("gap"), F.transform(whole, F.length).alias("length"),
        value.alias("value"))
    return F.when(text.rlike(pattern), F.transform(parts, lambda p: F.struct(
        F.lit(kind).alias("kind"), p["gap"].alias("gap"), p["length"].alias("length"), p["value"].alias("value"))))


def candidates(rows: DataFrame) -> DataFrame:
    """(row, repo, owner, kind, start, end, value) of all base spans and loose candidates."""
    each = None
    for kind, _, _ in KINDS:
        part = rows.where(F.col(kind).isNotNull()).select("row", "repo", "owner", F.posexplode(kind).alias("nth", "m"))
        each = part if each is None else each.unionByName(part)
    before = Window.partitionBy("row", "kind").orderBy("nth")
    placed = each.select("row", "repo", "owner", "nth", "m.*").withColumn(
        "end", F.sum(F.col("gap") + F.col("length")).over(before)).withColumn("start", F.col("end") - F.col("length"))
    loose = F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[0-9]")
    holds = F.when(F.col("kind") == "assign", F.length("value") >= 6).when(F.col("kind") == "key", loose).otherwise(True)
    return placed.where(holds).select("row", "repo", "owner", "kind", "start", "end", F.sha2("value", 256).alias("value"))


def ownership(found: DataFrame) -> DataFrame:
    """(value, repos, owners): distinct repositories and owners that hold a value."""
    return (found.select("value", "repo", "owner").distinct().groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"))
            .groupBy("value").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners")))


def scan(
    docs: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text", example_owners: int = EXAMPLE_OWNERS,
    example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, marks (array of kind, start, end, live, by start then kind), counts.

    Base spans always stay; ``live`` is false where the value is a copied example: ``example_owners`` owners hold it, or
    ``example_repos`` repositories. Key candidates are marks only when live; they may lie inside of a base span. Places
    are code points, ends exclusive.

    Null and empty texts have no marks. Null repositories or owners count as one of their own. Null and repeated ids
    are carried through, each row for itself. Other columns are not read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    text = F.col("__text")
    rows = scratch.stage(docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("__text"), F.coalesce(repo, F.lit("")).alias("repo"),
        F.coalesce(owner, F.lit("")).alias("owner")).select(
        F.monotonically_increasing_id().alias("row"), "id", "repo", "owner", F.xxhash64(text).alias("text_hash"),
        *(_found(text, kind, pattern, group).alias(kind) for kind, pattern, group in KINDS)), "matches", keep=True)
    found = scratch.stage(candidates(rows), "candidates", keep=True)
    order = F.array_position(F.array(*(F.lit(k) for k, _, _ in KINDS)), F.col("kind")).cast("long")
    examples = scratch.stage(ownership(found).where((F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)).select(
        "value", F.lit(True).alias("example")), "examples", keep=True)
    judged = sized_join(found, examples, ["value"], "left", COPIED_VALUES).withColumn("live", F.col("example").isNull())
    marks = judged.where((F.col("kind") != "key") | F.col("live")).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", order.alias("order"), "end", "kind", "live"))).alias("marks"))
    empty = F.array().cast("array<struct<start:bigint,order:bigint,end:bigint,kind:string,live:boolean>>")
    counts = [_count(lambda m, kind=kind: m["kind"] == kind).alias(f"n_{kind}") for kind, _, _ in KINDS]
    return (rows.select("row", "id", "text_hash").join(marks, "row", "left")
            .select(F.col("id").alias(id_col), "text_hash", F.coalesce("marks", empty).alias("marks"))
            .select(id_col, "text_hash", "marks", *counts,
                    _count(lambda m: m["live"]).alias("n_live"), _count(lambda m: ~m["live"]).alias("n_example")))


def _count(test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter("marks", lambda m: test(m))).cast("long")


def _joined(marks: Column) -> Column:
    return F.array_join(F.transform(marks, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def redact(
    docs: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text",
    live_mask: str = "[secret]", example_mask: str = "[example secret]",
) -> DataFrame:
    """``docs`` with the marked spans of the texts replaced; all columns and rows stay.

    Overlapping spans are replaced as one, with the mask of the first. Texts without marks stay as they are.
    """
    marks = scan(docs, repo, owner, id_col, text_col).where(F.size("marks") > 0).select(
        F.col(id_col).alias("id"), F.col("text_hash").alias("hash"), "marks").dropDuplicates(["id", "hash"])
    # whole rows in one column: no name of theirs can meet one used here
    whole = docs.select(F.struct("*").alias("doc")).withColumn("hash", F.xxhash64(F.col("doc")[text_col]))
    keys = marks.select("hash").distinct()
    touched = sized_join(whole, keys, ["hash"], "left_semi", COPIED_IDS)
    untouched = sized_join(whole, keys, ["hash"], "left_anti", COPIED_IDS)
    text = F.col("doc")[text_col]

    def step(done, mark):
        gap = F.substring(text, (done["at"] + 1).cast("int"), (mark["start"] - done["at"]).cast("int"))
        mask = F.when(mark["live"], F.lit(live_mask)).otherwise(F.lit(example_mask))
        return F.when(mark["start"] >= done["at"], F.struct(
            F.concat(done["out"], gap, mask).alias("out"), mark["end"].alias("at"))).otherwise(
            F.struct(done["out"].alias("out"), F.greatest(done["at"], mark["end"]).alias("at")))

    built = F.aggregate("marks", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), step, lambda done: F.concat(
        done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
    renamed = marks.withColumnsRenamed({"hash": "text_hash", "id": "marked"})
    masked = touched.join(renamed, (F.col("hash") == F.col("text_hash")) & F.col("doc")[id_col].eqNullSafe(F.col("marked"))).select(
        F.col("doc").withField(text_col, built).alias("doc"))
    return masked.unionByName(untouched.select("doc")).select("doc.*")


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' owner is their source; its texts of one language stand for a repository."""
    found = scan(table(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang"), F.col("source"))
    base = F.filter("marks", lambda m: m["kind"].isin(*BASE))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("marks")).alias("spans"), "n_live", "n_example")
