"""Points in polygons against the crossing test over all edges of all areas."""

import random

import pytest

from martloom.operators import covering

AREAS = "area_code STRING, parts ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"
POINTS = "id LONG, x DOUBLE, y DOUBLE"


def plain(points, areas, borders):
    out = []
    for i, x, y in points:
        if x is None or y is None:
            continue
        for name, parts in areas:
            n, on = 0, False
            for ring in [r for polygon in parts for r in polygon]:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                    n += (x1 <= x) != (x2 <= x) and y1 + (x - x1) * (y2 - y1) / (x2 - x1) > y
                    level = (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
                    on |= level and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
            if (n % 2 == 1 or on) if borders else (n % 2 == 1 and not on):
                out.append((i, name))
    return sorted(out)


def box(x, y, w, h):
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


def star(rng, x, y, size, n):
    import math

    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    ring = [[x + math.cos(t) * size * rng.uniform(0.3, 1), y + math.sin(t) * size * rng.uniform(0.3, 1)] for t in turns]
    return ring + ring[:1]


def areas(seed):
    rng = random.Random(seed)
    made = [
        ("ring", [[box(0.0, 0.0, 8.0, 8.0), box(2.0, 2.0, 3.0, 3.0)]]),
        ("two", [[box(10.0, 0.0, 2.0, 2.0)], [box(14.0, 1.0, 2.0, 5.0), box(14.5, 2.0, 1.0, 1.0)]]),
        ("open", [[[[20.0, 0.0], [24.0, 0.0], [22.0, 3.0]]]]),
        ("huge", [[box(-500.0, -500.0, 1000.0, 1000.0)]]),
        ("tiny", [[box(3.0, 3.0, 0.001, 0.001)]]),
        ("none", []),
    ]
    return made + [(f"star{i}", [[star(rng, rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([0.5, 5, 60]), rng.randrange(3, 40))]]) for i in range(12)]


def points(seed):
    rng = random.Random(seed)
    made = [(i, float(rng.randrange(-4, 28)), float(rng.randrange(-2, 10))) for i in range(150)]
    made += [(1000 + i, rng.uniform(-70, 70), rng.uniform(-70, 70)) for i in range(300)]
    made += [(2000, 3.0005, 3.0005), (2001, 3.0, 3.0), (2002, 600.0, 0.0), (2003, 500.0, 500.0), (2004, None, 1.0), (0, 1.0, 1.0), (0, 1.0, 1.0)]
    return made


@pytest.mark.parametrize(("seed", "borders", "small"), [(1, False, True), (2, True, True), (3, False, False)])
def test_equals_all_pairs(spark, monkeypatch, seed, borders, small):
    if not small:
        monkeypatch.setattr(covering, "BROADCAST_ROWS", 0)
    some, where = areas(seed), points(seed)
    got = covering.containing(spark.createDataFrame(where, POINTS), spark.createDataFrame(some, AREAS), "id", "x", "y", borders=borders)
    assert sorted(map(tuple, got.collect())) == plain(where, some, borders)
    assert "NestedLoop" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()


def test_cells_stay_in_proportion(spark):
    """A huge area has no more cells than a small one of its shape."""
    cover = covering.Cover(spark.createDataFrame([("big", [[box(0.0, 0.0, 1e6, 1e6)]]), ("small", [[box(5.0, 5.0, 1.0, 1.0)]])], AREAS))
    counts = {r["area"]: r["count"] for r in cover.cells.groupBy("area").count().collect()}
    assert max(counts.values()) <= 40 * 40 and min(counts.values()) >= 16 * 16


def test_nothing(spark):
    none = spark.createDataFrame([], AREAS)
    where = spark.createDataFrame(points(1), POINTS)
    assert covering.containing(where, none, "id", "x", "y").collect() == []
    assert covering.containing(where.limit(0), spark.createDataFrame(areas(1), AREAS), "id", "x", "y").collect() == []
