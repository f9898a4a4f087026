"""Nearest site per point, exact, by descending a grid of nested cells.

Sites are put into square cells that split 8 by 8 from depth to depth. A child box is the tight box of
its sites, and all children of a cell are one array, so a join by cell id hands a point all of them in one row.
Points go down twice. First each follows one cell per depth to a leaf, which gives a distance that some site has.
Then it keeps a short list of cells: children that lie beyond that distance, or beyond what another child holds at
most, are dropped where they are measured, and only the few left are rows. Dense clusters far away are ruled out
whole and never expanded site by site.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.storage import BROADCAST_ROWS, store

_STEP = 3  # bits per axis and depth: 8 x 8 children
_DEPTHS = 16
_ROOT_CELLS = 64
_LEAF_SITES = 64  # a cell with no more sites than this is not split further
_RESOLUTION = 1 << (_STEP * _DEPTHS)
_SALTS = 16  # copies of cells too many to broadcast, so that points in one cell spread over tasks


def _cell(axis: str, depth: int) -> Column:
    return F.shiftright(axis, _STEP * (_DEPTHS - depth))


def _squared(dx: Column, dy: Column) -> Column:
    return dx * dx + dy * dy


def _nearest_gap(v: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(lo - v, v - hi, F.lit(0.0))


def _farthest_gap(v: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(F.abs(v - lo), F.abs(v - hi))


def _cells(placed: DataFrame, depth: int) -> DataFrame:
    """The occupied cells of a depth with the tight box around their sites."""
    return placed.groupBy(_cell("gx", depth).alias("kx"), _cell("gy", depth).alias("ky")).agg(
        F.min("sx").alias("bx0"), F.max("sx").alias("bx1"), F.min("sy").alias("by0"), F.max("sy").alias("by1")
    )


def _constants(boxes: list[tuple]) -> Column:
    """A few cells as one array, in the fields of `_cells`."""
    rows = ", ".join(
        f"named_struct('kx', {kx}L, 'ky', {ky}L, 'bx0', {bx0!r}D, 'bx1', {bx1!r}D, 'by0', {by0!r}D, 'by1', {by1!r}D)"
        for kx, ky, bx0, bx1, by0, by1 in boxes
    )
    return F.expr(f"array({rows})")


def _low(box: Column) -> Column:
    """No site of the box is nearer than this squared distance."""
    x, y = F.col("px"), F.col("py")
    return _squared(_nearest_gap(x, box["bx0"], box["bx1"]), _nearest_gap(y, box["by0"], box["by1"]))


def _high(box: Column) -> Column:
    """No site of the box is further off than this squared distance."""
    x, y = F.col("px"), F.col("py")
    return _squared(_farthest_gap(x, box["bx0"], box["bx1"]), _farthest_gap(y, box["by0"], box["by1"]))


def _within_reach(boxes: str | Column) -> Column:
    """The cells of `boxes` that may hold a site as near as one is known to be, with both bounds."""
    kept = F.filter(boxes, lambda b: _low(b) <= F.col("reach"))
    return F.transform(
        kept, lambda b: F.struct(b["kx"].alias("cx"), b["ky"].alias("cy"), _low(b).alias("low"), _high(b).alias("high"))
    )


def _children(placed: DataFrame, depth: int) -> DataFrame:
    """Per cell of the depth above, the occupied cells that it splits into; no more than 64."""
    up = [F.shiftright("kx", _STEP).alias("ux"), F.shiftright("ky", _STEP).alias("uy")]
    return _cells(placed, depth).groupBy(*up).agg(F.collect_list(F.struct("kx", "ky", "bx0", "bx1", "by0", "by1")).alias("boxes"))


def _leaves(placed: DataFrame, depth: int, chunks: int) -> DataFrame:
    """The sites of each cell of a depth as arrays; `chunks` are the rows of a cell at most."""
    chunk = F.pmod(F.xxhash64("sx", "sy"), F.lit(chunks)).alias("chunk")
    cell = [_cell("gx", depth).alias("kx"), _cell("gy", depth).alias("ky"), chunk]
    return placed.groupBy(*cell).agg(F.collect_list(F.struct("sx", "sy", "site_id")).alias("sites"))


def _distance2(site: Column) -> Column:
    return _squared(F.abs(F.col("px") - site["sx"]), F.abs(F.col("py") - site["sy"]))


def _step(points: DataFrame, boxes: str | Column) -> DataFrame:
    """Each point with the one cell of `boxes` that is sure to have a site nearest.

    The cell comes out of a generator, below which no filter on it is pushed: it would be chosen twice, and before
    the points are spread.
    """
    ranked = F.transform(boxes, lambda b: F.struct(_high(b).alias("high"), b["kx"].alias("cx"), b["ky"].alias("cy")))
    chosen = F.explode_outer(F.array(F.array_min(ranked)))
    return points.select("point_id", "px", "py", chosen.alias("c")).select("point_id", "px", "py", "c.cx", "c.cy")


def _spread(points: DataFrame, cells: Column) -> DataFrame:
    """A row per cell; a row without cells meets nothing."""
    named = points.select("point_id", "px", "py", "reach", F.explode_outer(cells).alias("c"))
    return named.select("point_id", "px", "py", "reach", "c.cx", "c.cy")


def _prune(measured: DataFrame) -> DataFrame:
    """A row per cell of `cells` that is not further off than another can be at most."""
    near = measured.withColumn("reach", F.least("reach", F.array_min(F.transform("cells", lambda c: c["high"]))))
    return _spread(near, F.filter("cells", lambda c: c["low"] <= F.col("reach")))


def _meet(front: DataFrame, cells: DataFrame, kx: str, ky: str, small: bool) -> DataFrame:
    """Cells joined to the points that kept them or their parent; many cells are copied per salt of the points."""
    condition = (F.col("cx") == F.col(kx)) & (F.col("cy") == F.col(ky))
    if small:
        return front.join(F.broadcast(cells), condition)
    salted = front.withColumn("__salt", F.pmod(F.xxhash64("point_id"), F.lit(_SALTS)).cast("int"))
    copies = cells.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return salted.join(copies, condition & (F.col("__salt") == F.col("__copy"))).drop("__salt", "__copy")


def distinct_positions(sites: DataFrame, site_id: str, x: str, y: str) -> DataFrame:
    """One row per position, carrying the smallest site id found there."""
    return (
        sites.select(F.col(site_id).alias("site_id"), F.col(x).cast("double").alias("sx"), F.col(y).cast("double").alias("sy"))
        .dropna()
        .groupBy("sx", "sy")
        .agg(F.min("site_id").alias("site_id"))
    )


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    point_id: str,
    px: str,
    py: str,
    site_id: str,
    sx: str,
    sy: str,
) -> DataFrame:
    """(point_id, site_id, distance2) for every point with a position; ties go to the smaller id.

    `point_id` must be unique. Sites at one position count as one, under their smallest id. Without
    any site the result is empty.
    """
    positions = store(distinct_positions(sites, site_id, sx, sy), "positions")
    extent = positions.agg(
        F.min("sx").alias("x0"), F.min("sy").alias("y0"),
        F.max("sx").alias("x1"), F.max("sy").alias("y1"), F.count("*").alias("n"),
    ).first()
    wanted = points.select(
        F.col(point_id).alias("point_id"), F.col(px).cast("double").alias("px"), F.col(py).cast("double").alias("py")
    ).dropna()
    if extent["n"] == 0:
        id_type = positions.schema["site_id"].dataType
        return wanted.select(
            "point_id", F.lit(None).cast(id_type).alias("site_id"), F.lit(None).cast("double").alias("distance2")
        ).limit(0)

    side = max(extent["x1"] - extent["x0"], extent["y1"] - extent["y0"]) or 1.0
    last = _RESOLUTION - 1

    def grid(v: str, origin: float) -> Column:
        return F.least(F.floor((F.col(v) - origin) / side * _RESOLUTION).cast("bigint"), F.lit(last))

    placed = store(
        positions.withColumn("gx", grid("sx", extent["x0"])).withColumn("gy", grid("sy", extent["y0"])), "placed"
    )
    cell_counts: list[int] = []
    for depth in range(1, _DEPTHS + 1):
        sizes = placed.groupBy(_cell("gx", depth), _cell("gy", depth)).agg(F.count("*").alias("n"))
        size = sizes.agg(F.count("*").alias("cells"), F.max("n").alias("fullest")).first()
        cell_counts.append(size["cells"])
        if size["fullest"] <= _LEAF_SITES:
            break

    # the deepest grid of few cells is the root; its boxes travel as constants
    depths = len(cell_counts)
    root = max((d for d in range(1, depths + 1) if cell_counts[d - 1] <= _ROOT_CELLS), default=1)
    boxes = _constants([tuple(r) for r in _cells(placed, root).collect()])
    levels = [(_children(placed, d), cell_counts[d - 1] <= BROADCAST_ROWS) for d in range(root + 1, depths + 1)]
    chunks = ceil(size["fullest"] / _LEAF_SITES)
    leaves, few = _leaves(placed, depths, chunks), extent["n"] <= BROADCAST_ROWS

    # small rows with much work each, so as many tasks as the session names and not as few as their bytes need
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = _step(wanted.repartition(tasks, "point_id"), boxes)
    for children, small in levels:
        path = _step(_meet(path, children, "ux", "uy", small), "boxes")
    some = leaves if chunks == 1 else leaves.groupBy("kx", "ky").agg(F.min_by("sites", "chunk").alias("sites"))
    reached = _meet(path, some, "kx", "ky", few).select(
        "point_id", "px", "py", F.array_min(F.transform("sites", _distance2)).alias("reach")
    )

    front = _spread(reached, _within_reach(boxes))
    for children, small in levels:
        met = _meet(front, children, "ux", "uy", small)
        near = met.withColumn("cells", _within_reach("boxes"))
        # one aggregate per point, over what its own reach has left
        lists = near.groupBy("point_id", "px", "py", "reach").agg(F.flatten(F.collect_list("cells")).alias("cells"))
        front = _prune(lists)

    found = _meet(front, leaves, "kx", "ky", few)
    ranked = F.transform("sites", lambda s: F.struct(_distance2(s).alias("distance2"), s["site_id"].alias("site_id")))
    best = F.min("nearest").alias("best")
    nearest = found.select("point_id", F.array_min(ranked).alias("nearest")).groupBy("point_id").agg(best)
    return nearest.select("point_id", "best.site_id", "best.distance2")
