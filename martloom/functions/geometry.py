"""Planar geometry on nested coordinate arrays.

A multipolygon is ARRAY<polygon>, a polygon ARRAY<ring> with the outer ring first and holes
after it, a ring a closed ARRAY<ARRAY<DOUBLE>> of [x, y].
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_PARTS = ("a", "mx", "my")


def _total(parts: Column) -> Column:
    """Component-wise sum of an array of struct(a, mx, my)."""
    zero = F.struct(*[F.lit(0.0).alias(k) for k in _PARTS])
    return F.aggregate(parts, zero, lambda s, p: F.struct(*[(s[k] + p[k]).alias(k) for k in _PARTS]))


def _edge_sums(ring: Column) -> Column:
    """Doubled signed area and first moments of a ring about its first point."""
    x0, y0 = ring[0][0], ring[0][1]
    moved = F.transform(ring, lambda p: F.struct((p[0] - x0).alias("x"), (p[1] - y0).alias("y")))
    starts, ends = F.slice(moved, 1, F.size(ring) - 1), F.slice(moved, 2, F.size(ring) - 1)
    crossed = F.zip_with(
        starts,
        ends,
        lambda p, q: F.struct(
            (p["x"] * q["y"] - q["x"] * p["y"]).alias("a"), (p["x"] + q["x"]).alias("x"), (p["y"] + q["y"]).alias("y")
        ),
    )
    return _total(
        F.transform(
            crossed, lambda e: F.struct(e["a"].alias("a"), (e["x"] * e["a"]).alias("mx"), (e["y"] * e["a"]).alias("my"))
        )
    )


def _polygon_sums(rings: Column) -> Column:
    """Sums of a polygon. A ring counts by its place, not by the direction it was drawn in: the
    first adds, the others are holes. Each transform binds what the next one uses more than once.
    """
    measured = F.transform(
        rings,
        lambda ring, i: F.struct(
            F.when(i > 0, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("role"),
            ring[0][0].alias("x0"),
            ring[0][1].alias("y0"),
            _edge_sums(ring).alias("s"),
        ),
    )
    placed = F.transform(
        measured,
        lambda r: F.struct(
            (r["role"] * F.when(r["s"]["a"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))).alias("sign"),
            r["s"]["a"].alias("a"),
            (r["s"]["mx"] + 3 * r["x0"] * r["s"]["a"]).alias("mx"),
            (r["s"]["my"] + 3 * r["y0"] * r["s"]["a"]).alias("my"),
        ),
    )
    return _total(F.transform(placed, lambda r: F.struct(*[(r["sign"] * r[k]).alias(k) for k in _PARTS])))


def centroid(multipolygon: Column) -> Column:
    """Area-weighted centroid as struct(x, y); NULL coordinates when the area is zero."""
    sums = F.array(_total(F.transform(multipolygon, _polygon_sums)))
    return F.transform(
        sums,
        lambda s: F.struct(
            F.try_divide(s["mx"], 3 * s["a"]).alias("x"), F.try_divide(s["my"], 3 * s["a"]).alias("y")
        ),
    )[0]
