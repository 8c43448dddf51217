"""Source divergence audit: how far the words of every source stand apart from its language and from other sources.

All shares are integers in billionths with one added to every count, and the divergence of two shares ``p`` and ``q``
is ``f = floor((p - q)^2 / q)``, so results are exact.

Terms are ranked by count cells: within a group (lang, source) all terms with the same count in the group and the same
count in the lang have the same ``f``. Terms are counted per cell, ``f`` is evaluated once per cell, cells with equal
values are merged, and the values are ranked by the number of terms above them. Only cells that reach the wanted ranks
are expanded into terms again, in UTF-8 order.

Pairs of sources use cells as well: two sources of a lang meet in the terms both of them hold, counted by the pair of
their counts. A term that one of them lacks adds an amount that depends on the other's count alone, and a term that
both lack adds the same amount every time, so these are multiplied out from histograms instead of being joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import Scratch, sized_join, table, use_text_batches

#: A term is kept in a lang when at least so many of its documents hold it.
MIN_DOCS = 3
#: Terms of a group are listed down to this rank.
TOP_TERMS = 200
#: Entries a task gathers before it passes its counts on (about 0.2 KB each).
HELD_ENTRIES = 200_000
#: The table of groups, and that of cells to expand, are copied to the executors up to so many counted rows.
COPIED_ROWS = 500_000

#: Bytes of terms: letters, A-Z lower-cased, and all bytes of characters beyond ASCII; every other byte separates.
_TERM_BYTES = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in UTF-8, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def count_terms(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, d): occurrences of a term in a group and documents of the group that hold it.

    Every group also has a row with an empty term and no occurrences, so groups without terms are there. Counts are
    added up in the tasks first; a task passes them on whenever it holds ``HELD_ENTRIES``.
    """
    schema = "lang string, source string, term string, n long, d long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush():
            rows = [(lang, source, term.decode("utf-8", "replace"), n, held[term]) for (lang, source), (count, held) in groups.items()
                    for term, n in count.items()]
            rows += [(lang, source, "", 0, 0) for lang, source in groups]
            groups.clear()
            lang, source, term, n, d = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                names=["lang", "source", "term", "n", "d"])

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                count, held = groups.setdefault((lang, source), (Counter(), Counter()))
                terms = terms_of(text)
                count.update(terms)
                held.update(set(terms))
            if sum(len(count) for count, _ in groups.values()) > HELD_ENTRIES:
                yield flush()
        if groups:
            yield flush()

    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)))
    return named.mapInArrow(run, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _share(count: str, total: str, terms: str) -> str:
    """SQL of ``1 + floor(10^9 (count + 1) / (total + terms))``, exact for counts of any size."""
    return f"(1 + (cast({count} + 1 as decimal(19, 0)) * 1000000000) div cast({total} + {terms} as decimal(20, 0)))"


def _f(p: str, q: str) -> str:
    """SQL of the divergence; shares are at most 10^9 + 1, so the square is a long."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def rank_terms(scratch: Scratch, kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank) of every group's terms that are more frequent there than in the lang."""
    cells = kept.groupBy("lang", "source", "c", "m").agg(F.count(F.lit(1)).alias("k"))
    valued = sized_join(cells, groups, ["lang", "source"], "inner", COPIED_ROWS).withColumns(
        {"p": F.expr(_share("c", "ng", "v")), "q": F.expr(_share("m", "nl", "v"))}).where("p > q").select(
        "lang", "source", "c", "m", "k", F.expr(_f("p", "q")).alias("value"))
    valued = scratch.stage(valued, "cells")
    # every value has at least one term, so the wanted ranks lie within as many values
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = valued.groupBy("lang", "source", "value").agg(F.sum("k").alias("k")).withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= top)
    before = F.coalesce(F.sum("k").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    wanted = scratch.stage(valued.drop("k").join(reached, ["lang", "source", "value"]), "wanted")
    within = F.row_number().over(Window.partitionBy("lang", "source", "value").orderBy("term"))
    named = sized_join(kept, wanted, ["lang", "source", "c", "m"], "inner", COPIED_ROWS).withColumn("within", within).where(F.col("within") <= top)
    return named.select("lang", "source", F.col("term").alias("item"), "value", (F.col("before") + F.col("within")).cast("int").alias("rank")).where(
        F.col("rank") <= top)


def rank_pairs(scratch: Scratch, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): the summed divergence of every source from every other of its lang."""
    def side(name: str) -> DataFrame:
        return groups.select("lang", F.col("source").alias(name), F.col("ng").alias(f"n{name}"), "v")

    def times(k: str, f: str):
        return F.expr(f"cast({k} as decimal(18, 0)) * cast({f} as decimal(20, 0))").cast("decimal(38, 0)").alias("part")

    # terms that both hold, by the pair of their counts; each pair of sources once, for both directions
    one = kept.select("lang", "term", F.col("source").alias("s"), F.col("c").alias("a"))
    two = kept.select("lang", "term", F.col("source").alias("t"), F.col("c").alias("b"))
    both = one.join(two, ["lang", "term"]).where("s < t").groupBy("lang", "s", "t", "a", "b").agg(F.count(F.lit(1)).alias("k"))
    both = scratch.stage(both, "both")
    both = sized_join(sized_join(both, side("s"), ["lang", "s"], "inner", COPIED_ROWS), side("t").drop("v"), ["lang", "t"], "inner", COPIED_ROWS)
    both = both.withColumns({"ps": F.expr(_share("a", "ns", "v")), "pt": F.expr(_share("b", "nt", "v")),
                             "ps0": F.expr(_share("0", "ns", "v")), "pt0": F.expr(_share("0", "nt", "v"))})

    def beyond(p, q, p0, q0):
        return f"({_f(p, q)} - {_f(p, q0)} - {_f(p0, q)} + {_f(p0, q0)})"

    ways = both.select("lang", F.explode(F.array(
        F.struct(F.col("s").alias("s"), F.col("t").alias("t"), times("k", beyond("ps", "pt", "ps0", "pt0"))),
        F.struct(F.col("t").alias("s"), F.col("s").alias("t"), times("k", beyond("pt", "ps", "pt0", "ps0"))))).alias("w")).select("lang", "w.*")
    # the pairs of sources themselves are the rows of the report
    pairs = sized_join(side("s"), side("t").drop("v"), ["lang"], "inner", COPIED_ROWS).where("s <> t")
    pairs = pairs.withColumns({"ps0": F.expr(f"if(v > 0, {_share('0', 'ns', 'greatest(v, 1)')}, 1)"),
                               "pt0": F.expr(f"if(v > 0, {_share('0', 'nt', 'greatest(v, 1)')}, 1)")})
    base = pairs.select("lang", "s", "t", times("v", _f("ps0", "pt0")))
    histogram = kept.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("k"))
    first = sized_join(pairs, histogram.withColumnRenamed("source", "s"), ["lang", "s"], "inner", COPIED_ROWS).select(
        "lang", "s", "t", times("k", f"({_f(_share('c', 'ns', 'v'), 'pt0')} - {_f('ps0', 'pt0')})"))
    second = sized_join(pairs, histogram.withColumnRenamed("source", "t"), ["lang", "t"], "inner", COPIED_ROWS).select(
        "lang", "s", "t", times("k", f"({_f('ps0', _share('c', 'nt', 'v'))} - {_f('ps0', 'pt0')})"))
    summed = base.unionByName(first).unionByName(second).unionByName(ways).groupBy("lang", "s", "t").agg(F.sum("part").cast("long").alias("value"))
    order = Window.partitionBy("lang", "s").orderBy(F.desc("value"), "t")
    return summed.select("lang", F.col("s").alias("source"), F.col("t").alias("item"), "value", F.row_number().over(order).alias("rank"))


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has all other sources, part ``term`` the terms to rank ``top``.

    Null langs, sources and texts are read as empty. A group without terms has counts of 0 everywhere; a lang without kept
    terms has pairs of value 0. Repeated rows are documents of their own. Ties are ranked by item. Other columns are not
    read; an empty table gives an empty result. The report is written once, its intermediate tables are deleted.
    """
    spark = docs.sparkSession
    use_text_batches(spark)
    with Scratch(spark, "divergence") as scratch:
        counts = scratch.stage(count_terms(docs, lang_col, source_col, text_col), "counts")
        frequent = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("m"), F.sum("d").alias("d")).where(
            F.col("d") >= min_docs).drop("d")
        kept = scratch.stage(counts.join(frequent, ["lang", "term"]).select("lang", "source", "term", F.col("n").alias("c"), "m"), "kept")
        own = kept.groupBy("lang", "source").agg(F.sum("c").alias("ng"))
        langs = kept.groupBy("lang", "term").agg(F.first("m").alias("m")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("m").alias("nl"))
        every = counts.where("term = ''").select("lang", "source").distinct()
        zero = F.lit(0).cast("long")
        groups = scratch.stage(every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("ng", "v", "nl"))), "groups")
        report = rank_pairs(scratch, kept, groups).withColumn("part", F.lit("pair")).unionByName(
            rank_terms(scratch, kept, groups, top).withColumn("part", F.lit("term")))
        return scratch.stage(report.select("lang", "source", "part", "item", "value", "rank"), "report", keep=True)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
