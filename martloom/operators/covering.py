"""Which polygons contain which points, by cells that cover the polygons.

Each polygon is covered with square cells of a size that suits its own extent, from a ladder of sizes that
halve. A cell that no edge of the polygon touches lies inside it or outside as a whole; inside ones
settle every point in them. Points in a cell with an edge are tested by crossings, against those
edges only that share the column of the cell: no other edge can lie above or below the point. Points meet polygons by
equality of cells, once per size in use, never all with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.storage import BROADCAST_ROWS, store

#: A polygon is at least 2^_DEPTH and less than 2^(_DEPTH + 1) cells wide or high.
_DEPTH = 4
_LADDER = 40  # halvings of the whole extent, at most
_PAD = 1e-6  # of a cell, so that rounding cannot move an edge out of the cells marked for it
_SALTS = 16


def edges_of(areas: DataFrame, area_id: str = "area_code", parts: str = "parts") -> DataFrame:
    """(area, x1, y1, x2, y2): all edges of all rings; a ring that was left open is closed."""
    rings = areas.select(F.col(area_id).alias("area"), F.explode(F.flatten(parts)).alias("ring")).filter(F.size("ring") > 0)
    ring = F.concat("ring", F.slice("ring", 1, 1))
    ends = F.zip_with(
        F.slice(ring, F.lit(1), F.size(ring) - 1),
        F.slice(ring, F.lit(2), F.size(ring) - 1),
        lambda p, q: F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")),
    )
    return rings.select("area", F.inline(ends))


def _y_at(e: Column, x: Column) -> Column:
    return e["y1"] + (x - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])


def _passes(e: Column, x: Column) -> Column:
    """Whether the vertical line at x meets the edge; of a vertex two edges share, one counts."""
    return (e["x1"] <= x) != (e["x2"] <= x)


def crossings(edges: Column, x: Column, y: Column) -> Column:
    """How many edges lie above the point."""
    return F.size(F.filter(edges, lambda e: F.when(_passes(e, x), _y_at(e, x) > y).otherwise(F.lit(False))))


def touches(edges: Column, x: Column, y: Column) -> Column:
    """Whether the point lies on an edge."""

    def on(e: Column) -> Column:
        level = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
        beside = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        return level & beside & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    return F.exists(edges, on)


def _meet(points: DataFrame, other: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Equi-join of points with cells; many cells are copied per salt of the points, so that a full cell spreads over tasks."""
    if small:
        return points.join(F.broadcast(other), on)
    salted = points.withColumn("salt", F.pmod(F.xxhash64("point_id", "x", "y"), F.lit(_SALTS)).cast("int"))
    copies = other.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return salted.join(copies, [*on, "salt"]).drop("salt")


class Cover:
    """Cells and strips of a set of areas; both are stored, so several sets of points can be placed."""

    def __init__(self, areas: DataFrame, area_id: str = "area_code", parts: str = "parts"):
        edges = store(edges_of(areas, area_id, parts).dropna(), "edges")
        across = lambda a, b: (F.min(F.least(a, b)), F.max(F.greatest(a, b)))
        (x0, x1), (y0, y1) = across("x1", "x2"), across("y1", "y2")
        boxes = edges.groupBy("area").agg(F.greatest(x1 - x0, y1 - y0).alias("extent"), F.count("*").alias("n"))
        whole = edges.agg(x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"), F.count("*").alias("n")).first()
        self.empty = whole["n"] == 0
        if self.empty:
            self.kind = edges.schema["area"].dataType
            return
        self.x0, self.y0 = whole["x0"], whole["y0"]
        self.side = max(whole["x1"] - whole["x0"], whole["y1"] - whole["y0"]) or 1.0
        halvings = F.ceil(F.log2(F.lit(self.side) / F.greatest("extent", F.lit(self.side / 2.0**_LADDER)))) + _DEPTH
        sized = store(boxes.select("area", F.least(halvings, F.lit(_LADDER)).cast("int").alias("level")), "area_levels")
        self.levels = sorted(r["level"] for r in sized.select("level").distinct().collect())  # no more than the ladder has
        self.strips = store(self._strips(edges.join(sized, "area")), "strips")
        self.small_strips = self.strips.agg(F.sum(F.size("edges"))).first()[0] <= BROADCAST_ROWS
        self.cells = store(self._cells(), "cells")
        self.small_cells = self.cells.count() <= BROADCAST_ROWS

    def width(self, level: Column) -> Column:
        """The side of a cell."""
        return F.lit(self.side) / F.pow(F.lit(2.0), level)

    def place(self, v: Column, origin: float, level: Column) -> Column:
        """A coordinate counted in cells."""
        return (v - origin) / self.width(level)

    def _strips(self, edges: DataFrame) -> DataFrame:
        """Per area and column of cells the edges that reach into it."""
        level = F.col("level")
        first = F.floor(self.place(F.least("x1", "x2"), self.x0, level) - _PAD)
        last = F.floor(self.place(F.greatest("x1", "x2"), self.x0, level) + _PAD)
        columns = edges.withColumn("kx", F.explode(F.sequence(first, last)))
        return columns.groupBy("area", "level", "kx").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))

    def _cells(self) -> DataFrame:
        """(area, level, kx, ky, inside): cells with an edge, and those inside without one."""
        level, width = F.col("level"), self.width(F.col("level"))
        left = self.x0 + F.col("kx") * width
        strips = self.strips.select("area", "level", "kx", "edges", left.alias("left"), width.alias("width"))

        def rows(e: Column) -> Column:
            a, b = F.greatest(F.least(e["x1"], e["x2"]), F.col("left")), F.least(F.greatest(e["x1"], e["x2"]), F.col("left") + F.col("width"))
            flat = e["x1"] == e["x2"]
            ya, yb = F.when(flat, e["y1"]).otherwise(_y_at(e, a)), F.when(flat, e["y2"]).otherwise(_y_at(e, b))
            low = F.floor(self.place(F.least(ya, yb), self.y0, level) - _PAD)
            return F.sequence(low, F.greatest(low, F.floor(self.place(F.greatest(ya, yb), self.y0, level) + _PAD)))

        touched = strips.select("area", "level", "kx", F.explode(F.array_distinct(F.flatten(F.transform("edges", rows)))).alias("ky"))
        middle = F.col("left") + F.col("width") / 2
        met = F.transform(F.filter("edges", lambda e: _passes(e, middle)), lambda e: self.place(_y_at(e, middle), self.y0, level))
        heights = strips.select("area", "level", "kx", F.array_sort(met).alias("ys")).filter(F.size("ys") >= 2)
        pairs = F.transform(F.sequence(F.lit(0), F.size("ys") - 2, F.lit(2)), lambda i: F.struct(F.get("ys", i).alias("a"), F.get("ys", i + 1).alias("b")))
        within = lambda p: F.filter(F.sequence(F.floor(p["a"]), F.floor(p["b"])), lambda k: (k + 0.5 > p["a"]) & (k + 0.5 < p["b"]))
        filled = heights.select("area", "level", "kx", F.explode(F.flatten(F.transform(pairs, within))).alias("ky"))
        both = touched.withColumn("inside", F.lit(False)).unionByName(filled.withColumn("inside", F.lit(True)))
        return both.groupBy("area", "level", "kx", "ky").agg(F.min("inside").alias("inside"))

    def containing(self, points: DataFrame, point_id: str, x: str, y: str, borders: bool = False) -> DataFrame:
        """(point_id, area) for every area that contains a point; see `containing`."""
        placed = points.select(
            F.col(point_id).alias("point_id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
        ).dropna(subset=["x", "y"])
        if self.empty:
            return placed.select("point_id", F.lit(None).cast(self.kind).alias("area")).limit(0)
        levels = placed.withColumn("level", F.explode(F.array(*[F.lit(n) for n in self.levels])))
        level = F.col("level")
        in_cells = levels.withColumns(
            {"kx": F.floor(self.place(F.col("x"), self.x0, level)), "ky": F.floor(self.place(F.col("y"), self.y0, level))}
        )
        met = _meet(in_cells, self.cells, ["level", "kx", "ky"], self.small_cells)
        settled = met.filter("inside").select("point_id", "area")
        near = _meet(met.filter(~F.col("inside")), self.strips, ["area", "level", "kx"], self.small_strips)
        edges, at = F.col("edges"), (F.col("x"), F.col("y"))
        odd, border = crossings(edges, *at) % 2 == 1, touches(edges, *at)
        return settled.unionByName(near.filter(odd | border if borders else odd & ~border).select("point_id", "area"))


def containing(
    points: DataFrame,
    areas: DataFrame,
    point_id: str,
    x: str,
    y: str,
    area_id: str = "area_code",
    parts: str = "parts",
    borders: bool = False,
) -> DataFrame:
    """(point_id, area) for every area that contains a point.

    `parts` is a multipolygon as in `functions.geometry`; a point in a hole is outside. A point on an edge, also that of a
    hole, counts only with `borders`. A point in several areas has several rows, one without a position or in
    none has no row; repeated points are placed each for itself.
    """
    return Cover(areas, area_id, parts).containing(points, point_id, x, y, borders)
