"""Raw text as it lands: CSV in splits, types of whole columns; points placed in polygons; many columns at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.operators.components import correlation_table, fit_components
from martloom.operators.covering import containing
from martloom.plans.quality import counted
from martloom.sources.inference import column_types, read_typed_table
from martloom.sources.records import read_csv
from martloom.storage import new_path
from workload.registry import query, table


def _written(df, spark):
    path = new_path(spark, "landed")
    df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query(
    "csv_in_splits",
    "doc_id:int lines:int n:int digest:text",
    r"""SELECT doc_id, len(string_split(t, chr(10))) AS lines, length(t) AS n, md5(t) AS digest
        FROM (SELECT doc_id, replace(text, chr(13), ' ') || chr(10) || '"' || lang || '", ' AS t FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL)""",
)
def csv_in_splits(spark, sf):
    """Whole texts with line breaks, quotes and separators, written as CSV and read back in splits."""
    text = F.concat(F.regexp_replace("text", "\r", " "), F.lit('\n"'), "lang", F.lit('", '))
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), text.alias("text")).dropna()
    back = read_csv(spark, _written(docs, spark))
    return back.select("doc_id", F.size(F.split("text", "\n")).alias("lines"), F.char_length("text").alias("n"), F.md5("text").alias("digest"))


UNTIDY = r"""SELECT CAST(o_orderkey AS VARCHAR) AS k,
  CASE WHEN o_orderkey % 5 <> 0 THEN floor(o_totalprice)::BIGINT || '.25' END AS price,
  CASE WHEN o_orderkey % 3 = 0 THEN 'True' ELSE 'false' END AS flag,
  o_orderpriority AS priority,
  CASE WHEN o_custkey % 50 = 0 THEN 'unit ' || o_custkey % 7 WHEN o_custkey % 11 = 0 THEN 'true' ELSE CAST(o_custkey AS VARCHAR) END AS customer,
  CAST(NULL AS VARCHAR) AS nothing FROM orders"""


def untidy(spark, sf):
    o = table(spark, sf, "orders")
    text = lambda c: F.col(c).cast("string")
    return o.select(
        text("o_orderkey").alias("k"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.floor("o_totalprice").cast("string"), F.lit(".25"))).alias("price"),
        F.when(F.col("o_orderkey") % 3 == 0, "True").otherwise("false").alias("flag"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_custkey") % 50 == 0, F.concat(F.lit("unit "), (F.col("o_custkey") % 7).cast("string")))
        .when(F.col("o_custkey") % 11 == 0, "true").otherwise(text("o_custkey")).alias("customer"),
        F.lit(None).cast("string").alias("nothing"),
    )


@query(
    "column_types",
    "name:text type:text n_values:int n_nulls:int n_whole:int n_float:int n_boolean:int n_text:int n_bad:int bad_example:text",
    rf"""WITH u AS ({UNTIDY}), cells AS (
           SELECT name, value, CASE WHEN value IS NULL THEN NULL WHEN regexp_matches(value, '^[0-9]+$') THEN 'w'
             WHEN regexp_matches(value, '^[0-9]+\.[0-9]+$') THEN 'f' WHEN lower(value) IN ('true', 'false') THEN 'b' ELSE 't' END AS k
           FROM (SELECT unnest(['k', 'price', 'flag', 'priority', 'customer', 'nothing']) AS name,
                        unnest([k, price, flag, priority, customer, nothing]) AS value FROM u)),
         c AS (SELECT name, count(value) AS v, count(*) - count(value) AS z, count(*) FILTER (k = 'w') AS w, count(*) FILTER (k = 'f') AS f,
                      count(*) FILTER (k = 'b') AS b, count(*) FILTER (k = 't') AS t FROM cells GROUP BY 1),
         d AS (SELECT *, CASE WHEN v = 0 THEN 'null' WHEN w = v THEN 'whole' WHEN w + f = v THEN 'float' WHEN b = v THEN 'boolean'
                      WHEN t = v THEN 'text' ELSE 'mixed' END AS type, greatest(w + f, b, t) AS most FROM c)
         SELECT name, type, v AS n_values, z AS n_nulls, w AS n_whole, f AS n_float, b AS n_boolean, t AS n_text,
           CASE WHEN type = 'mixed' THEN v - most ELSE 0 END AS n_bad,
           CASE WHEN type = 'mixed' THEN (SELECT min(value) FROM cells WHERE cells.name = d.name AND
             CASE WHEN w + f = most THEN k IN ('b', 't') WHEN b = most THEN k IN ('w', 'f', 't') ELSE k IN ('w', 'f', 'b') END) END AS bad_example
         FROM d""",
)
def column_types_of_orders(spark, sf):
    return column_types(untidy(spark, sf))


@query(
    "typed_read",
    "k:int price:float flag:text customer:text",
    f"SELECT k, price, CAST(CAST(flag AS BOOLEAN) AS VARCHAR) AS flag, customer FROM ({UNTIDY})",
)
def typed_read(spark, sf):
    """Written as CSV, read in splits, and cast to the types that all of its values have."""
    back, _ = read_typed_table(spark, _written(untidy(spark, sf).drop("nothing"), spark))
    return back.select("k", "price", F.col("flag").cast("string").alias("flag"), "customer")


@query(
    "rows_on_load",
    "name:text n_rows:int",
    "SELECT 'orders' AS name, count(*) AS n_rows FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'empty', 0",
)
def rows_on_load(spark, sf):
    """Rows counted while they are written, as the runners count what they load."""
    frames = {n: table(spark, sf, n) for n in ("orders", "customer")} | {"empty": table(spark, sf, "orders").limit(0)}
    seen = {name: counted(df, f"load of {name}") for name, df in frames.items()}
    for name, (df, _) in seen.items():
        df.write.parquet(new_path(spark, name))
    return spark.createDataFrame([(name, count.get["rows"]) for name, (_, count) in seen.items()], "name STRING, n_rows BIGINT")


# Corners of the areas made of every nation, as steps from its own corner: a square with a square hole, a bent band, and a small
# square apart; one list of rings per polygon.
SHAPES = [
    [[(0, 0), (8, 0), (8, 8), (0, 8)], [(2, 2), (5, 2), (5, 5), (2, 5)]],
    [[(10, 0), (14, 0), (14, 6), (12, 6), (12, 2), (10, 2)]],
    [[(9, 9), (9.5, 9), (9.5, 9.5), (9, 9.5)]],
]
EDGES = ", ".join(
    f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for polygon in SHAPES for ring in polygon for a, b in zip(ring, ring[1:] + ring[:1])
)
# Nation k lies at (4k, 2k), so that neighbours overlap. Points fall on quarters, many on edges and corners.
PLACED = f"""
  e AS (SELECT n_nationkey AS k, 4 * n_nationkey + ax AS x1, 2 * n_nationkey + ay AS y1, 4 * n_nationkey + bx AS x2, 2 * n_nationkey + bz AS y2
        FROM nation, (VALUES {EDGES}) AS v(ax, ay, bx, bz)),
  p AS (SELECT c_custkey AS id, c_custkey % 440 / 4.0 AS x, c_custkey * 7 % 240 / 4.0 AS y FROM customer),
  tested AS (SELECT id, k, count(*) FILTER ((x1 <= x) <> (x2 <= x) AND y1 + (x - x1) * (y2 - y1) / nullif(x2 - x1, 0) > y) AS n,
        bool_or((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
                AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS touching FROM p, e GROUP BY 1, 2)"""


def nation_areas(spark, sf):
    at = lambda axis, step: (F.col("n_nationkey") * axis + F.lit(float(step))).cast("double")
    parts = F.array(
        *[F.array(*[F.array(*[F.array(at(4, x), at(2, y)) for x, y in [*ring, ring[0]]]) for ring in polygon]) for polygon in SHAPES]
    )
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("area_code"), parts.alias("parts"))


def customer_points(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(key, (key % 440 / 4.0).alias("x"), (key * 7 % 240 / 4.0).alias("y"))


@query("points_in_areas", "id:int area:int", "SELECT id, k AS area FROM tested WHERE n % 2 = 1 AND NOT touching", PLACED)
def points_in_areas(spark, sf):
    found = containing(customer_points(spark, sf), nation_areas(spark, sf), "c_custkey", "x", "y")
    return found.withColumnRenamed("point_id", "id")


@query("points_on_areas", "area:int n:int", "SELECT k AS area, count(*) AS n FROM tested WHERE n % 2 = 1 OR touching GROUP BY 1", PLACED)
def points_on_areas(spark, sf):
    """Points in an area or on its edges, counted per area."""
    found = containing(customer_points(spark, sf), nation_areas(spark, sf), "c_custkey", "x", "y", borders=True)
    return found.groupBy("area").agg(F.count("*").alias("n"))


@query(
    "pca_corr_many",
    "i:int j:int corr:float6",
    """WITH v AS (SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM embeddings)
       SELECT a.i, b.i AS j, corr(a.x, b.x) AS corr FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2""",
)
def pca_corr_many(spark, sf):
    """Correlations of all 64 components of the vectors, in tiles."""
    width = 64
    columns = table(spark, sf, "embeddings").select(*[F.get("embedding", F.lit(i)).alias(f"c{i}") for i in range(width)])
    corr = correlation_table(fit_components(columns))
    number = lambda c: F.substring(c, 2, 9).cast("int")
    return corr.select(number("feature_a").alias("i"), number("feature_b").alias("j"), "corr")
