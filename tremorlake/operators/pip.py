"""Distributed point-in-polygon: which polygon of a layer covers each event.

The layer is cut into grid cells once. A cell keeps, per polygon, only what can still decide a point
inside it, so that a point reads one cell row and needs no shuffle:

* ``edges``: the edges whose column span meets the cell, in the cell's row of the grid;
* ``far``: edges of that row wholly to the right. A ray to the right crosses such an edge exactly when
  its two ends lie on different sides of the ray, so the parity of crossings is the parity of *ends*
  above the ray. Ends shared by two such edges cancel, and what is left of a chain are its loose ends;
* ``base``: the parity of the loose ends above the whole row.

A cell that no edge meets has neither ``edges`` nor ``far``: its ``base`` says inside or outside. A
polygon that fills the cell is kept as ``filler``, which answers most points without any test. The
comparisons are those of the plain even-odd test on exact doubles, so both give the same rows.

Cells follow the layer: a cell with more than ``SPLIT_ENTRIES`` entries is cut into ``CUT`` x ``CUT``, again and again,
so one crowded spot makes its own cells smaller and no others. A cell's parts are handed down row by row, and only cells
small enough are gathered into arrays. A point walks down the few levels that exist by the list of split
cells, then reads one cell row. Points in a cell that stays crowded at the finest size take ``covering_pairs``, a
shuffle join with the same answer.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorlake.functions.geo import cell_index
from tremorlake.operators.joins import lookup_join, shuffled_left_join
from tremorlake.session import pin, stage
from tremorlake.sources.polygons import polygon_edges

CELL_SIZES = tuple(10.0 / 2 ** k for k in range(18))   # degrees, tried from coarse to fine
MAX_CELL_ENTRIES = 20_000            # edges or polygons one cell row of a fixed grid may hold
SPLIT_ENTRIES = 256                  # beyond so many, a cell is cut
CUT = 4                              # cells a side into which it is cut
SLACK = 1e-9                         # degrees, far above the rounding of a computed crossing
FEW_EDGES = 10_000                   # layers up to here are gathered at once and cut only if a cell turns out crowded
ENTRY_BYTES = 64                     # room for one edge, loose end, polygon or cell in memory
CELL_TESTS = 64                      # tests of a point against an edge that take as long as making a polygon's row of a cell
MAX_BROADCAST_BYTES = 16 * 1024 * 1024     # the driver holds a copied side several times over


def _spans(edges: DataFrame, g: float) -> DataFrame:
    return edges.select(
        "*",
        cell_index(F.least("x1", "x2"), g).alias("c_low"), cell_index(F.greatest("x1", "x2"), g).alias("c_high"),
        cell_index(F.least("y1", "y2"), g).alias("r_low"), cell_index(F.greatest("y1", "y2"), g).alias("r_high"),
    )


def polygon_boxes(edges: DataFrame) -> DataFrame:
    """Bounding boxes ``(poly, xmin, xmax, ymin, ymax)``."""
    return edges.groupBy("poly").agg(
        F.min(F.least("x1", "x2")).alias("xmin"), F.max(F.greatest("x1", "x2")).alias("xmax"),
        F.min(F.least("y1", "y2")).alias("ymin"), F.max(F.greatest("y1", "y2")).alias("ymax"))


def box_cells(boxes: DataFrame, g: float) -> DataFrame:
    """One row per polygon and grid cell its bounding box meets."""
    rows = boxes.withColumn("cell_r", F.explode(F.sequence(
        cell_index(F.col("ymin"), g), cell_index(F.col("ymax"), g))))
    return rows.withColumn("cell_c", F.explode(F.sequence(
        cell_index(F.col("xmin"), g), cell_index(F.col("xmax"), g))))


def _edge_rows(edges: DataFrame, g: float) -> DataFrame:
    """Each edge once per grid row it meets."""
    return _spans(edges, g).withColumn("cell_r", F.explode(F.sequence("r_low", "r_high")))


def _near_edges(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.select(
        "poly", "cell_r", F.explode(F.sequence("c_low", "c_high")).alias("cell_c"), "x1", "y1", "x2", "y2")


def _loose_ends(edge_rows: DataFrame, g: float) -> DataFrame:
    """Ends of edges by grid row and leftmost column that do not cancel; a null ``y`` is above the row."""
    ends = edge_rows.select("poly", "cell_r", "c_low", F.explode(F.array("y1", "y2")).alias("y"))
    end_row = cell_index(F.col("y"), g)
    placed = ends.where(end_row >= F.col("cell_r")).withColumn("y", F.when(end_row == F.col("cell_r"), F.col("y")))
    odd = placed.groupBy("poly", "cell_r", "c_low", "y").agg((F.count(F.lit(1)) % 2).alias("odd"))
    return odd.where("odd = 1").drop("odd")


def _far_ends(cells: DataFrame, loose: DataFrame) -> DataFrame:
    """Per polygon and cell, the ends right of the cell that do not cancel; a null ``y`` is above the row."""
    right = cells.join(loose.hint("merge"), ["poly", "cell_r"]).where(F.col("c_low") > F.col("cell_c"))
    return right.groupBy("poly", "cell_r", "cell_c", "y").agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1").drop("odd")


def _far_parity(cells: DataFrame, loose: DataFrame) -> DataFrame:
    """Per polygon and cell: parity above the row, and the loose ends inside it, right of the cell."""
    return _far_ends(cells, loose).groupBy("poly", "cell_r", "cell_c").agg(
        F.count_if(F.col("y").isNull()).cast("int").alias("base"), F.collect_list("y").alias("far"))


@dataclass(frozen=True)
class PolygonIndex:
    """A layer prepared for lookups.

    ``cells`` holds one row per grid cell, with its ``level``: the cells of level 0 measure ``cell_deg``, those of the
    next a ``CUT``th of it. It is None when a cell of a fixed grid would hold more than ``MAX_CELL_ENTRIES``. ``split`` lists
    the cells that were cut; those of the last level stay crowded and are answered by pairs. ``broadcast``
    tells whether the measured size of the cells allows a copy per executor, ``broadcast_split`` and
    ``broadcast_boxes`` the same of the split cells and of the cells of all bounding boxes.
    """

    edges: DataFrame
    cells: DataFrame | None
    cell_deg: float
    broadcast: bool
    broadcast_boxes: bool
    split: DataFrame | None = None
    levels: int = 1
    broadcast_split: bool = True

    def level_deg(self, level: int) -> float:
        return self.cell_deg / CUT ** level


def choose_cell_deg(edges: DataFrame) -> float:
    """The coarsest grid on which the boxes of the polygons have as many cells as the layer has edges.

    One step finer has four times the cells, so the cells grow with the edges and never faster; more vertices on the
    same shapes give a finer grid.
    """
    boxes = polygon_boxes(edges).agg(*[
        F.sum((cell_index(F.col("xmax"), g) - cell_index(F.col("xmin"), g) + 1).cast("double")
              * (cell_index(F.col("ymax"), g) - cell_index(F.col("ymin"), g) + 1)).alias(f"g{i}") for i, g in enumerate(CELL_SIZES)])
    held, count = boxes.first(), edges.count()
    return next((g for i, g in enumerate(CELL_SIZES) if count <= (held[f"g{i}"] or 0)), CELL_SIZES[-1] if count else CELL_SIZES[0])


def build_index(layer: DataFrame, cell_deg: float | None = None,
                max_cell_entries: int = MAX_CELL_ENTRIES,
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                split_entries: int = SPLIT_ENTRIES) -> PolygonIndex:
    """Cut a polygon layer into grid cells and measure the result. ``cell_deg`` fixes one grid for the whole layer."""
    # read back from a table: after a checkpoint the engine still knows what held before it, and would make the rings of a
    # layer that computes them from the row id again for every row that a join filters
    edges = stage(polygon_edges(layer))
    fixed = cell_deg is not None
    cell_deg = cell_deg or choose_cell_deg(edges)
    edge_rows = _edge_rows(edges, cell_deg)
    near = _near_edges(edge_rows)
    boxes = polygon_boxes(edges)
    where = ["cell_r", "cell_c"]
    candidates = box_cells(boxes, cell_deg).select("poly", *where)
    copy_boxes = candidates.count() * ENTRY_BYTES <= max_broadcast_bytes
    count = edges.count()
    far = _far_parity(candidates, _loose_ends(edge_rows, cell_deg))
    if not fixed and count > FEW_EDGES:
        return _adaptive_index(edges, edge_rows, near, candidates, cell_deg, copy_boxes, max_broadcast_bytes, split_entries)
    # A cell meets an edge or a polygon at most once, so only large layers need the count per cell.
    if fixed and 2 * count > max_cell_entries:
        far = pin(far)
        held = near.select(*where, F.lit(1).alias("n")).unionAll(candidates.select(*where, F.lit(1).alias("n"))).unionAll(
            far.select(*where, F.size("far").alias("n"))).groupBy(*where).agg(F.sum("n").alias("n"))
        if (held.agg(F.max("n")).first()[0] or 0) > max_cell_entries:
            return PolygonIndex(edges, None, cell_deg, False, copy_boxes)

    edge = F.struct("x1", "y1", "x2", "y2")
    per_poly = (
        candidates
        .join(far, ["poly", *where], "left")
        .join(near.groupBy("poly", *where).agg(F.collect_list(edge).alias("edges")), ["poly", *where], "left")
        .select("poly", F.lit(0).alias("level"), *where, F.coalesce("base", F.lit(0)).alias("base"),
                F.coalesce("far", F.expr("CAST(array() AS ARRAY<DOUBLE>)")).alias("far"),
                F.coalesce("edges", F.expr(
                    "CAST(array() AS ARRAY<STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>>)")).alias("edges"))
    )
    cells = pin(_cell_rows(per_poly))
    size, most = cells.agg(F.coalesce(F.sum(F.col("entries") * ENTRY_BYTES + ENTRY_BYTES), F.lit(0)), F.max("entries")).first()
    if not fixed and (most or 0) > split_entries:
        return _adaptive_index(edges, edge_rows, near, candidates, cell_deg, copy_boxes, max_broadcast_bytes, split_entries)
    return PolygonIndex(edges, cells, cell_deg, size <= max_broadcast_bytes, copy_boxes)


def _cell_rows(per_poly: DataFrame) -> DataFrame:
    """One row per cell from ``(poly, level, cell_r, cell_c, base, far, edges)``.

    The smallest polygon id wins, so nothing behind a polygon that fills the cell can matter.
    """
    entry = F.struct("poly", "base", "far", "edges")
    marked = per_poly.withColumn("whole", (F.col("base") == 1) & (F.size("far") == 0) & (F.size("edges") == 0)).where(
        "base = 1 OR size(far) > 0 OR size(edges) > 0")
    return marked.groupBy("level", "cell_r", "cell_c").agg(
        F.min(F.when(F.col("whole"), F.col("poly"))).alias("filler"),
        F.collect_list(F.when(~F.col("whole"), entry)).alias("cands"),
        F.sum(F.lit(1) + F.size("far") + F.size("edges")).alias("entries"),
    ).withColumn("cands", F.filter("cands", lambda c: F.col("filler").isNull() | (c["poly"] < F.col("filler"))))


# What a cell knows of a polygon, one row each: parity above its row, a loose end to its right, an edge that meets it.
_BASE, _FAR, _EDGE = 0, 1, 2
_PART = ["poly", "cell_r", "cell_c", "kind", "y", "x1", "y1", "x2", "y2"]


def _ends(rows: DataFrame, kind) -> DataFrame:
    none = [F.lit(None).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]
    return rows.select("poly", "cell_r", "cell_c", kind.alias("kind"), F.when(kind == _FAR, F.col("y")).alias("y"), *none)


def _without_hidden(parts: DataFrame) -> DataFrame:
    """Parts of a cell's polygons up to the first that fills the cell, and of those that look the same in it the first.

    Polygons look the same in a cell if they have equal parts there, as neighbours on a shared border and copies do: the
    smallest id answers for all of them, and no smaller cell would ever part them. Parts are compared by their number
    and two hashes.
    """
    where = ["cell_r", "cell_c"]
    said = [F.xxhash64(F.lit(seed), *_PART[3:]) for seed in (1, 2)]
    looks = parts.groupBy("poly", *where).agg(
        F.max("kind").alias("_most"), F.count(F.lit(1)).alias("_n"), F.bit_xor(said[0]).alias("_h1"), F.sum(said[1].cast("decimal(20, 0)")).alias("_h2"))
    firsts = looks.groupBy(*where, "_most", "_n", "_h1", "_h2").agg(F.min("poly").alias("poly"))
    filler = F.min(F.when(F.col("_most") == _BASE, F.col("poly"))).over(Window.partitionBy(*where))
    seen = firsts.withColumn("_filler", filler).where("_filler IS NULL OR poly <= _filler").select("poly", *where)
    return parts.join(seen.hint("merge"), ["poly", *where], "left_semi").select(*_PART)


def _cut(parts: DataFrame, g: float) -> DataFrame:
    """The parts of cells handed down to the smaller cells of size ``g`` inside them.

    An edge counts by its run inside the smaller cell's row, a little widened (``SLACK``), so a long slanting edge meets
    few of them. One that still meets the cell goes on; one wholly to the right leaves its two ends. Ends count above
    the smaller cell's row, inside it, or not at all, and equal ones cancel as before.
    """
    kids = parts.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in range(CUT * CUT)]))).withColumns({
        "cell_r": F.col("cell_r") * CUT + F.floor(F.col("_k") / CUT).cast("int"), "cell_c": F.col("cell_c") * CUT + F.col("_k") % CUT}).drop("_k")
    def x_at(y):
        along = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))))
        return F.col("x1") + (F.col("x2") - F.col("x1")) * along

    bottom, top = x_at(F.col("cell_r") * F.lit(g)), x_at((F.col("cell_r") + 1) * F.lit(g))
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    spans = kids.withColumns({
        "r_low": cell_index(F.least("y1", "y2"), g), "r_high": cell_index(F.greatest("y1", "y2"), g),
        "c_low": cell_index(F.coalesce(F.greatest(low, F.least(bottom, top) - SLACK), low), g),
        "c_high": cell_index(F.coalesce(F.least(high, F.greatest(bottom, top) + SLACK), high), g)})
    in_row = (F.col("kind") == _EDGE) & F.col("cell_r").between(F.col("r_low"), F.col("r_high"))
    edges = spans.where(in_row & F.col("cell_c").between(F.col("c_low"), F.col("c_high"))).select(*_PART)
    right = spans.where(in_row & (F.col("c_low") > F.col("cell_c"))).select("poly", "cell_r", "cell_c", F.explode(F.array("y1", "y2")).alias("y"))
    ends = right.unionByName(kids.where(F.col("kind") == _FAR).select("poly", "cell_r", "cell_c", "y"))
    row = cell_index(F.col("y"), g)
    placed = _ends(ends.where(row >= F.col("cell_r")), F.when(row == F.col("cell_r"), F.lit(_FAR)).otherwise(F.lit(_BASE))).unionByName(
        kids.where(F.col("kind") == _BASE).select(*_PART))
    odd = placed.groupBy(*_PART).agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1").drop("odd")
    return edges.unionByName(odd)


def _adaptive_index(edges: DataFrame, edge_rows: DataFrame, near: DataFrame, candidates: DataFrame, cell_deg: float, copy_boxes: bool,
                    max_broadcast_bytes: int, split_entries: int) -> PolygonIndex:
    """Cells of several sizes, none with more than ``split_entries`` entries but those that ``split`` lists last."""
    where = ["cell_r", "cell_c"]
    far = _far_ends(candidates, _loose_ends(edge_rows, cell_deg))
    parts = near.select("poly", *where, F.lit(_EDGE).alias("kind"), F.lit(None).cast("double").alias("y"), "x1", "y1", "x2", "y2").unionByName(
        _ends(far, F.when(F.col("y").isNull(), F.lit(_BASE)).otherwise(F.lit(_FAR))))
    leaves, split, level, crowded = None, None, 0, 0
    while True:
        parts = pin(_without_hidden(parts))
        held = parts.groupBy(*where).agg((F.count(F.lit(1)) + F.count_distinct("poly")).alias("n"))
        over = pin(held.where(F.col("n") > split_entries).select(*where))
        found = over.count()
        leaf = (parts.join(over, where, "left_anti") if found else parts).select(F.lit(level).alias("level"), *_PART)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        if not found:
            break
        crowded += found
        marked = over.select(F.lit(level).alias("level"), *where)
        split = marked if split is None else split.unionByName(marked)
        if cell_deg / CUT ** level <= CELL_SIZES[-1]:
            break
        level += 1
        parts = _cut(parts.join(over, where, "left_semi"), cell_deg / CUT ** level)
    edge = F.struct("x1", "y1", "x2", "y2")
    per_poly = leaves.groupBy("poly", "level", *where).agg(
        F.count_if(F.col("kind") == _BASE).cast("int").alias("base"), F.collect_list("y").alias("far"),
        F.collect_list(F.when(F.col("kind") == _EDGE, edge)).alias("edges"))
    cells = pin(_cell_rows(per_poly))
    size = cells.agg(F.coalesce(F.sum(F.col("entries") * ENTRY_BYTES + ENTRY_BYTES), F.lit(0))).first()[0]
    return PolygonIndex(edges, cells, cell_deg, size <= max_broadcast_bytes, copy_boxes, None if split is None else pin(split), level + 1,
                        crowded * ENTRY_BYTES <= max_broadcast_bytes)


def place_points(points: DataFrame, index: PolygonIndex) -> DataFrame:
    """``points`` with ``_level``, ``_r`` and ``_c`` of their cell; ``index.levels`` for points of cells that stay crowded."""
    at = lambda level: (cell_index(F.col("lat"), index.level_deg(level)), cell_index(F.col("lon"), index.level_deg(level)))
    r, c = at(0)
    placed = points.withColumns({"_level": F.lit(0), "_r": r, "_c": c})
    if index.split is None:
        return placed
    for level in range(index.levels):       # a few sizes
        cut = index.split.where(F.col("level") == level).select(F.col("level").alias("_level"), F.col("cell_r").alias("_r"), F.col("cell_c").alias("_c"),
                                                                F.lit(True).alias("_cut"))
        keys = ["_level", "_r", "_c"]
        met = placed.join(F.broadcast(cut), keys, "left") if index.broadcast_split else shuffled_left_join(placed, cut, keys)
        r, c = at(level + 1)
        placed = met.select(*points.columns, *[F.when(F.col("_cut"), deeper).otherwise(F.col(name)).alias(name) for name, deeper in (
            ("_level", F.lit(level + 1)), ("_r", r), ("_c", c))])
    return placed


def _crosses(e: Column, lon: Column, lat: Column) -> Column:
    """A ray to the right from (lon, lat) crosses the edge."""
    at = (e["x2"] - e["x1"]) * (lat - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
    return ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < at)


def _touches(e: Column, lon: Column, lat: Column) -> Column:
    """The point lies on the edge."""
    return (
        ((e["x2"] - e["x1"]) * (lat - e["y1"]) == (e["y2"] - e["y1"]) * (lon - e["x1"]))
        & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def _covers(c: Column, lon: Column, lat: Column) -> Column:
    crossings = (
        c["base"] + F.size(F.filter(c["far"], lambda y: y > lat))
        + F.size(F.filter(c["edges"], lambda e: _crosses(e, lon, lat)))
    )
    return (crossings % 2 == 1) | F.exists(c["edges"], lambda e: _touches(e, lon, lat))


def resolve_polygon(points: DataFrame, index: PolygonIndex, out: str = "poly") -> DataFrame:
    """``points`` (any columns with lon, lat and a unique id) plus the covering polygon's row id or null.

    Boundaries belong to the polygon; of several polygons the smallest row id wins.
    """
    if index.cells is None:
        return _resolve_by_pairs(points, index, out)
    placed = place_points(points, index)
    keys = ["_level", "_r", "_c"]
    cells = index.cells.select(F.col("level").alias("_level"), F.col("cell_r").alias("_r"), F.col("cell_c").alias("_c"),
                               F.col("filler").alias("_filler"), F.col("cands").alias("_cands"))
    if index.broadcast:
        joined = placed.join(F.broadcast(cells), keys, "left")
    else:
        joined = shuffled_left_join(placed, cells, keys)
    covering = F.filter("_cands", lambda c: _covers(c, F.col("lon"), F.col("lat")))
    tested = F.coalesce(F.array_min(F.transform(covering, lambda c: c["poly"])), F.col("_filler"))
    poly = F.when(F.size("_cands") > 0, tested).otherwise(F.col("_filler"))
    found = joined.select(*points.columns, "_level", poly.alias(out))
    if index.split is None or index.level_deg(index.levels - 1) > CELL_SIZES[-1]:
        return found.drop("_level")
    crowded = F.coalesce(F.col("_level") == index.levels, F.lit(False))
    return found.where(~crowded).drop("_level").unionByName(_resolve_by_pairs(found.where(crowded).select(*points.columns), index, out))


def pip_candidates(points: DataFrame, index: PolygonIndex) -> DataFrame:
    """Pairs ``(id, lon, lat, poly)`` whose bounding box holds the point: grid equi-join, then the box.

    The number of boxes per cell depends on the layer alone; the box table is copied if it was measured as small
    enough, else hot cells on the event side are split at run time.
    """
    g = index.cell_deg
    boxes = box_cells(polygon_boxes(index.edges), g).withColumnsRenamed({"cell_r": "_r", "cell_c": "_c"})
    placed = points.select("id", "lon", "lat").where("lon IS NOT NULL AND lat IS NOT NULL").withColumns(
        {"_r": cell_index(F.col("lat"), g), "_c": cell_index(F.col("lon"), g)})
    if index.broadcast_boxes:
        pairs = placed.join(F.broadcast(boxes), ["_r", "_c"])
    else:
        pairs = shuffled_left_join(placed, boxes, ["_r", "_c"]).where("poly IS NOT NULL")
    return pairs.where("lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax").select("id", "lon", "lat", "poly")


def covering_pairs(points: DataFrame, index: PolygonIndex) -> DataFrame:
    """Pairs ``(id, poly)`` where the polygon covers the point, for layers of any size.

    A polygon has one row per grid cell, with all that decides a point in that cell: nothing where it fills the cell, most
    often one edge at its border. A point meets the rows of its cell and is tested where they meet, so only points and
    rows move, never pairs. The grid is finer where there are more points (``pair_cell_deg``): pairs inside polygons need
    no test. Ids that are null or come more than once, whose crossings count together, and polygons with more than
    ``MAX_CELL_ENTRIES`` edges in one cell take the sums by (id, poly).
    """
    where = ["cell_r", "cell_c"]
    located = points.select("id", "lon", "lat").where("lon IS NOT NULL AND lat IS NOT NULL")
    again = stage(located.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL").select("id"))
    edge_rows = _edge_rows(index.edges, index.cell_deg)
    near, loose = _near_edges(edge_rows), _loose_ends(edge_rows, index.cell_deg)
    crowded = near.groupBy("poly", *where).agg(F.count(F.lit(1)).alias("n")).unionByName(
        loose.groupBy("poly", "cell_r").agg(F.count(F.lit(1)).alias("n")).select("poly", "cell_r", F.lit(None).cast("int").alias("cell_c"), "n"))
    large = stage(crowded.where(F.col("n") > MAX_CELL_ENTRIES).select("poly").distinct())
    once, few = located, index.edges
    found = []
    if not again.isEmpty():
        marked = again.withColumn("_again", F.lit(True)).withColumnRenamed("id", "_id")
        told = located.join(marked, F.col("id").eqNullSafe(F.col("_id")), "left")
        once = told.where("_again IS NULL").select(*located.columns)
        found.append(_pairs_by_sums(told.where("_again").select(*located.columns), index, index.edges))
    if not large.isEmpty():
        few = index.edges.join(large, "poly", "left_anti")
        found.append(_pairs_by_sums(once, index, index.edges.join(large, "poly", "left_semi")))
    g = pair_cell_deg(few, index.cell_deg, located.count())
    cells = stage(_polygon_cells(few, g))
    placed = once.withColumns({"cell_r": cell_index(F.col("lat"), g), "cell_c": cell_index(F.col("lon"), g)})
    # cells told in columns stay in generated code; functions of arrays, for the few others, would take all out of it
    lon, lat = F.col("lon"), F.col("lat")
    plain = lookup_join(placed, cells.where("edges IS NULL").drop("far", "edges"), where).where("poly IS NOT NULL")
    tested = plain.where(_covers_by_columns(lon, lat)).select("id", "poly")
    rest = lookup_join(placed, cells.where("edges IS NOT NULL").select("poly", *where, "base", "far", "edges"), where).where("poly IS NOT NULL")
    found.append(rest.where(_covers({c: F.col(c) for c in ("base", "far", "edges")}, lon, lat)).select("id", "poly"))
    for more in found:      # three at most
        tested = tested.unionByName(more)
    return tested


def pair_cell_deg(edges: DataFrame, cell_deg: float, n_points: int) -> float:
    """The grid, ``cell_deg`` or finer by halves, on which building the polygons' cells and testing points takes least.

    A finer grid has more cells and fewer points in cells that a border meets. Points are taken as spread over the layer.
    """
    sizes = [g for g in (cell_deg / 2 ** k for k in range(8)) if g >= CELL_SIZES[-1]] or [cell_deg]
    def spans(g):
        return [(cell_index(F.col(high), g) - cell_index(F.col(low), g) + 1).cast("double") for low, high in (("xmin", "xmax"), ("ymin", "ymax"))]

    sums = []
    for i, g in enumerate(sizes):       # eight at most
        wide, high = spans(g)
        sums += [F.sum(wide * high).alias(f"cells{i}"), F.sum(F.least(wide * high, 2 * (wide + high))).alias(f"border{i}")]
    held = polygon_boxes(edges).agg(*sums, ((F.max("xmax") - F.min("xmin")) * (F.max("ymax") - F.min("ymin"))).alias("extent")).first()

    def work(i: int) -> float:
        tests = n_points * (held[f"border{i}"] or 0) * sizes[i] ** 2 / max(held["extent"] or 0, sizes[i] ** 2)
        return CELL_TESTS * (held[f"cells{i}"] or 0) + tests

    return sizes[min(range(len(sizes)), key=work)]


def _edge_runs(edges: DataFrame, g: float) -> DataFrame:
    """As ``_edge_rows``, with the columns that the edge meets inside that row, a little widened (``SLACK``)."""
    rows = _edge_rows(edges, g)

    def x_at(y):
        along = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))))
        return F.col("x1") + (F.col("x2") - F.col("x1")) * along

    bottom, top = x_at(F.col("cell_r") * F.lit(g) - SLACK), x_at((F.col("cell_r") + 1) * F.lit(g) + SLACK)
    level, low, high = F.col("y1") == F.col("y2"), F.least("x1", "x2"), F.greatest("x1", "x2")
    return rows.withColumns({
        "c_low": cell_index(F.when(level, low).otherwise(F.greatest(low, F.least(bottom, top) - SLACK)), g),
        "c_high": cell_index(F.when(level, high).otherwise(F.least(high, F.greatest(bottom, top) + SLACK)), g)})


_CORNERS = ("x1", "y1", "x2", "y2")
_FEW = ("a", "b")          # a cell told in columns has at most so many edges, and as many loose ends


def _polygon_cells(edges: DataFrame, g: float) -> DataFrame:
    """What a grid cell knows of each polygon that meets it: ``(poly, cell_r, cell_c, base)`` and its edges and loose ends.

    With at most two edges and two loose ends, as nearly all cells of a fine grid, these stand in columns (``ax1`` to
    ``by2``, ``ay`` and ``by``) and ``far`` and ``edges`` are null; ``told`` tells whether there are any.
    """
    where = ["cell_r", "cell_c"]
    # a layer is often read by one task, and its cells are many more than its edges
    edges = edges.repartition(edges.sparkSession.sparkContext.defaultParallelism, "poly")
    edge_rows = _edge_runs(edges, g)
    edge = F.struct(*_CORNERS)
    near = _near_edges(edge_rows).groupBy("poly", *where).agg(F.collect_list(edge).alias("edges"))
    far = _far_parity(box_cells(polygon_boxes(edges), g).select("poly", *where), _loose_ends(edge_rows, g))
    met = far.join(near.hint("merge"), ["poly", *where], "full_outer").select(
        "poly", *where, F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("far", F.expr("CAST(array() AS ARRAY<DOUBLE>)")).alias("far"),
        F.coalesce("edges", F.expr("CAST(array() AS ARRAY<STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>>)")).alias("edges"))
    some = met.where("base = 1 OR size(far) > 0 OR size(edges) > 0").withColumn(
        "_plain", (F.size("far") <= len(_FEW)) & (F.size("edges") <= len(_FEW)))
    columns = []
    for i, side in enumerate(_FEW):
        columns += [F.when(F.col("_plain"), F.get("edges", F.lit(i))[c]).alias(side + c) for c in _CORNERS]
        columns.append(F.when(F.col("_plain"), F.get("far", F.lit(i))).alias(side + "y"))
    return some.select("poly", *where, "base", ((F.size("far") > 0) | (F.size("edges") > 0)).alias("told"), *columns,
                       *[F.when(~F.col("_plain"), F.col(c)).alias(c) for c in ("far", "edges")])


def _covers_by_columns(lon: Column, lat: Column) -> Column:
    """As ``_covers`` for cells told in columns."""
    odd, on_edge = F.col("base") == 1, F.lit(False)
    for side in _FEW:
        e = {c: F.col(side + c) for c in _CORNERS}
        odd = odd != F.coalesce(F.col(side + "y") > lat, F.lit(False))
        odd = odd != F.coalesce(_crosses(e, lon, lat), F.lit(False))
        on_edge = on_edge | F.coalesce(_touches(e, lon, lat), F.lit(False))
    return F.when(F.col("told"), odd | on_edge).otherwise(F.col("base") == 1)


def _pairs_by_sums(points: DataFrame, index: PolygonIndex, layer: DataFrame) -> DataFrame:
    """Covering pairs of the polygons in ``layer`` (edges). A candidate meets only the edges of its own grid row.

    Each candidate's crossings are summed before the shuffle by (id, poly), so edges multiply rows inside a task but not
    on the wire.
    """
    g = index.cell_deg
    edges = _edge_rows(layer, g).select("poly", F.col("cell_r").alias("_r"), "x1", "y1", "x2", "y2")
    pairs = pip_candidates(points, replace(index, edges=layer)).withColumn("_r", cell_index(F.col("lat"), g))
    matched = shuffled_left_join(pairs, edges, ["poly", "_r"]).where("x1 IS NOT NULL")
    e = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
    lon, lat = F.col("lon"), F.col("lat")
    tested = matched.groupBy("id", "poly").agg(
        (F.count_if(_crosses(e, lon, lat)) % 2).alias("odd"), F.bool_or(_touches(e, lon, lat)).alias("on_edge"))
    return tested.where("odd = 1 OR on_edge").select("id", "poly")


def _resolve_by_pairs(points: DataFrame, index: PolygonIndex, out: str) -> DataFrame:
    best = covering_pairs(points, index).groupBy("id").agg(F.min("poly").alias(out))
    return points.join(best, "id", "left").select(*points.columns, out)


def _cell_contents(index: PolygonIndex, values: DataFrame) -> DataFrame:
    """``(deg, r, c, mark)``: a hash of all that a cell can answer, with ``values`` (poly, value) in place of polygon ids.

    Polygons count in the order in which they win, so a layer with new row ids but the same order has the same marks.
    """
    cell = ["level", "cell_r", "cell_c"]
    listed = index.cells.select(*cell, F.posexplode(F.array_sort("cands")).alias("pos", "e")).select(*cell, "pos", "e.*")
    filled = index.cells.where("filler IS NOT NULL").select(
        *cell, F.size("cands").alias("pos"), F.col("filler").alias("poly"), F.lit(1).alias("base"), F.expr("CAST(array() AS ARRAY<DOUBLE>)").alias("far"),
        F.expr("CAST(array() AS ARRAY<STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>>)").alias("edges"))
    listed = listed.unionByName(filled)
    named = lookup_join(listed, values.select("poly", "value"), ["poly"])
    one = F.xxhash64("pos", "value", "base", F.array_sort("far"), F.array_sort("edges"))
    deg = F.element_at(F.array(*[F.lit(index.level_deg(n)) for n in range(index.levels)]), F.col("level") + 1)
    return named.select(deg.alias("deg"), F.col("cell_r").alias("r"), F.col("cell_c").alias("c"), one.alias("h")).groupBy("deg", "r", "c").agg(
        F.bit_xor("h").alias("mark"), F.count(F.lit(1)).alias("n"))


def changed_cells(old: PolygonIndex, old_values: DataFrame, new: PolygonIndex, new_values: DataFrame) -> DataFrame:
    """``(deg, r, c)`` of cells that answer differently, or that only one of two indexes has, in either of them.

    Cells that stayed crowded have no row of their own and count as changed.
    """
    if old.cells is None or new.cells is None:
        raise ValueError("only indexes with cells can be compared")
    before, after = _cell_contents(old, old_values), _cell_contents(new, new_values)
    other = after.withColumnsRenamed({"mark": "mark2", "n": "n2"})
    differ = before.join(other, ["deg", "r", "c"], "full_outer").where(
        ~(F.col("mark").eqNullSafe(F.col("mark2")) & F.col("n").eqNullSafe(F.col("n2")))).select("deg", "r", "c")
    for index in (old, new):
        if index.split is not None:
            differ = differ.unionByName(index.split.where(F.col("level") == index.levels - 1).where(
                F.lit(index.level_deg(index.levels - 1) <= CELL_SIZES[-1])).select(
                F.lit(index.level_deg(index.levels - 1)).alias("deg"), F.col("cell_r").alias("r"), F.col("cell_c").alias("c")))
    return differ.distinct()


def points_in_cells(points: DataFrame, index: PolygonIndex, cells: DataFrame, out: str) -> DataFrame:
    """``points`` with a flag: their cell of ``index`` is one of ``cells`` (deg, r, c)."""
    last = index.levels - 1
    degs = F.array(*[F.lit(index.level_deg(min(n, last))) for n in range(index.levels + 1)])
    placed = place_points(points, index)
    # a crowded cell is left one level too deep; its own place is that of the last level
    r, c = cell_index(F.col("lat"), index.level_deg(last)), cell_index(F.col("lon"), index.level_deg(last))
    deeper = F.col("_level") > last
    keyed = placed.select(*points.columns, F.element_at(degs, F.col("_level") + 1).alias("deg"),
                          F.when(deeper, r).otherwise(F.col("_r")).alias("r"), F.when(deeper, c).otherwise(F.col("_c")).alias("c"))
    met = lookup_join(keyed, cells.withColumn("_met", F.lit(True)), ["deg", "r", "c"])
    return met.select(*points.columns, F.col("_met").isNotNull().alias(out))
