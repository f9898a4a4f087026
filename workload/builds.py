"""The shipped model builds over the given tables, marts and component runs on what they build, and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.times import parse_datetime
from martloom.operators.components import fit_usable, numeric_columns
from martloom.operators.keys import attach_key
from martloom.plans import geographic, multivariate, operational, temporal
from martloom.plans.facts import combined
from martloom.plans.models import build_galaxy, build_star
from martloom.plans.refresh import NO_YEAR, refresh_galaxy
from martloom.sources.raw import read_areas, read_keyed_csv, read_text_table, read_weather, read_weather_json
from martloom.sources.tables import read_table, write_csv, write_tables
from martloom.storage import new_path
from workload import conforming, roles  # noqa: F401  (conforming registers the SQL used here)
from workload.registry import ORACLES, query, table
from workload.roles import GALAXY, HOURLY

SUMMARY = "name:text n_rows:int key_max:int measure:float6"


def summed(name: str, df: DataFrame, key: str, *measures: str) -> DataFrame:
    total = reduce(Column.__add__, [F.coalesce(F.sum(F.col(m).cast("double")), F.lit(0.0)) for m in measures])
    return df.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"), F.max(key).alias("key_max"), total.alias("measure"))


def summed_sql(name: str, oracle: str, key: str, *measures: str) -> str:
    total = " + ".join(f"coalesce(sum(CAST({m} AS DOUBLE)), 0)" for m in measures)
    return f"SELECT '{name}' AS name, count(*) AS n_rows, max({key}) AS key_max, {total} AS measure FROM ({ORACLES[oracle]})"


# table, query whose SQL says the same, key, measures
GALAXY_TABLES = [
    ("Dim_Time", "dim_time", "date_key", "date_key"),
    ("Dim_Location", "dim_location", "location_key", "zipcode"),
    ("Dim_Firehouse", "dim_site", "firehouse_key", "zipcode", "Latitude"),
    ("Dim_IncidentType", "dim_incident_type", "incident_type_key", "incident_type_key"),
    ("Dim_Weather", "dim_weather", "weather_key", "temp_f", "is_raining"),
    ("Fact_Incidents_EMS", "fact_a", "location_key", "location_key", "incident_type_key", "weather_key", "response_time"),
    ("Fact_Incidents_Fire", "fact_b", "location_key", "location_key", "incident_type_key", "weather_key", "total_units", "response_time"),
]
STAR_TABLES = [
    ("dim_time", "dim_time_multi", "date_key", "date_key"),
    ("dim_location", "dim_location_wide", "location_key", "ZIPCODE"),
    ("dim_firehouse", "dim_site_wide", "firehouse_key", "Postcode"),
    ("bridge_zip_firehouse", "bridge_area_site", "firehouse_key", "ZIPCODE"),
    ("fact_incident_ems", "star_fact_a", "location_key", "location_key", "ems_final_call_type_key", "ems_disposition_key"),
    ("fact_incident_fire", "star_fact_b", "location_key", "location_key", "fire_class_key", "engines_assigned_quantity"),
]


def galaxy(spark, sf) -> dict[str, DataFrame]:
    return build_galaxy(roles.raw_a(spark, sf), roles.raw_b(spark, sf), roles.raw_sites(spark, sf), roles.raw_weather(spark, sf))


def all_of(tables: dict[str, DataFrame], listed) -> DataFrame:
    return reduce(DataFrame.unionByName, [summed(name, tables[name], key, *measures) for name, _, key, *measures in listed])


@query("galaxy_build", SUMMARY, " UNION ALL ".join(summed_sql(*x) for x in GALAXY_TABLES))
def galaxy_build(spark, sf):
    return all_of(galaxy(spark, sf), GALAXY_TABLES)


@query("star_build", SUMMARY, " UNION ALL ".join(summed_sql(*x) for x in STAR_TABLES))
def star_build(spark, sf):
    return all_of(build_star(roles.raw_a(spark, sf), roles.raw_b(spark, sf), roles.raw_sites(spark, sf)), STAR_TABLES)


# --- marts on built facts, whose keys and measures are null here and there ---

BUILT = f"fa AS ({ORACLES['fact_a']}), fb AS ({ORACLES['fact_b']}), {GALAXY}"
BOTH = "(SELECT hour, travel_time, location_key, weather_key, response_time FROM fa UNION ALL SELECT hour, travel_time, location_key, weather_key, response_time FROM fb)"
SHARED = ["hour", "nb_interventions", "travel_time", "location_key", "weather_key", "incident_type_key", "response_time"]


def both_facts(built: dict[str, DataFrame]) -> DataFrame:
    return combined({"EMS": built["Fact_Incidents_EMS"], "FIRE": built["Fact_Incidents_Fire"]}, SHARED)


@query(
    "built_volume_vs_speed",
    "hour:int nb_interventions:int travel_time:float6",
    f"SELECT hour, count(*) AS nb_interventions, avg(travel_time) AS travel_time FROM {BOTH} WHERE hour IS NOT NULL GROUP BY 1",
    BUILT,
)
def built_volume_vs_speed(spark, sf):
    return temporal.volume_vs_speed(both_facts(galaxy(spark, sf)))


@query(
    "built_risk_heatmap",
    "hour:int category:text n:int",
    """SELECT s.hour, best.category, coalesce(c.n, 0) AS n FROM (SELECT category FROM counts GROUP BY 1 ORDER BY sum(n) DESC, category LIMIT 10) best
       CROSS JOIN (SELECT DISTINCT hour FROM counts WHERE hour IS NOT NULL AND category IS NOT NULL) s
       LEFT JOIN counts c ON c.category = best.category AND c.hour = s.hour""",
    BUILT + """, counts AS (SELECT hour, category, count(*) AS n FROM (
        SELECT hour, incident_type_key FROM fa UNION ALL SELECT hour, incident_type_key FROM fb) x
        JOIN dim_type USING (incident_type_key) WHERE category IS NOT NULL GROUP BY 1, 2)""",
)
def built_risk_heatmap(spark, sf):
    built = galaxy(spark, sf)
    return temporal.risk_heatmap(both_facts(built), built["Dim_IncidentType"])


@query(
    "built_temp_volume",
    "bin_hi:int nb_interventions:int",
    f"""SELECT top AS bin_hi, coalesce(n, 0) AS nb_interventions FROM (SELECT unnest(range(5, 106, 5)) AS top) LEFT JOIN (
         SELECT CAST(ceil(temp_f / 5) * 5 AS INTEGER) AS top, count(*) AS n FROM {BOTH} JOIN dim_weather USING (weather_key)
         WHERE temp_f > 0 AND temp_f <= 105 GROUP BY 1) USING (top)""",
    BUILT,
)
def built_temp_volume(spark, sf):
    built = galaxy(spark, sf)
    return temporal.temp_volume(both_facts(built), built["Dim_Weather"])


@query(
    "built_area_rollup",
    "zipcode:int nb_interventions:int response_time:float6",
    f"""SELECT zipcode, sum(n) AS nb_interventions, avg(r) AS response_time FROM (
         SELECT location_key, count(*) AS n, avg(response_time) AS r FROM {BOTH} WHERE location_key IS NOT NULL GROUP BY 1)
       JOIN dim_location USING (location_key) GROUP BY 1""",
    BUILT,
)
def built_area_rollup(spark, sf):
    built = galaxy(spark, sf)
    return geographic.area_rollup(both_facts(built), built["Dim_Location"])


@query(
    "built_resource_use",
    "category:text resource_cost_seconds:float6",
    """SELECT category, sum(total_units * (coalesce(dispatch_time, 0) + coalesce(travel_time, 0))) AS resource_cost_seconds
       FROM fb JOIN dim_type USING (incident_type_key) WHERE category IS NOT NULL GROUP BY 1""",
    BUILT,
)
def built_resource_use(spark, sf):
    built = galaxy(spark, sf)
    return operational.resource_use(built["Fact_Incidents_Fire"], built["Dim_IncidentType"])


# --- the model brought up to date by years: facts say the same as a full build, through keys that only the registry knows ---

REFRESHED = "fact:text year:int n:int zips:int codes:int temps:float6 seconds:float6"
SAID = """count(*) AS n, coalesce(sum(zipcode), 0) AS zips, count(type_code) AS codes, coalesce(sum(temp_f), 0) AS temps, coalesce(sum(response_time), 0) AS seconds
  FROM {} f LEFT JOIN dim_location USING (location_key) LEFT JOIN dim_type USING (incident_type_key) LEFT JOIN dim_weather USING (weather_key) GROUP BY 1, 2"""
BY_YEAR = "SELECT '{}' AS fact, coalesce(f.date_key // 10000, 0) AS year, " + SAID


@query("refreshed_galaxy", REFRESHED, f"{BY_YEAR.format('EMS', 'fa')} UNION ALL {BY_YEAR.format('FIRE', 'fb')}", BUILT)
def refreshed_galaxy(spark, sf):
    """All years but the last two at first, then those two and the rows without a time in a second call."""
    raw = [roles.raw_a(spark, sf), roles.raw_b(spark, sf), roles.raw_sites(spark, sf), roles.raw_weather(spark, sf)]
    seen = reduce(DataFrame.unionByName, [df.select(F.year(parse_datetime(F.col("INCIDENT_DATETIME"))).alias("y")) for df in raw[:2]])
    years = sorted(r.y for r in seen.distinct().collect() if r.y is not None)
    folder = new_path(spark, "refreshed")
    for named in (years[:-2], [*years[-2:], NO_YEAR]):
        if named:
            refresh_galaxy(*raw, folder, named)
    dims = [("Dim_Location", "location_key", "zipcode"), ("Dim_IncidentType", "incident_type_key", "type_code"), ("Dim_Weather", "weather_key", "temp_f")]
    told = []
    for tag, name in (("EMS", "Fact_Incidents_EMS"), ("FIRE", "Fact_Incidents_Fire")):
        fact = read_table(spark, folder, name)
        for dim, key, column in dims:
            fact = attach_key(fact, read_table(spark, folder, dim), [(key, key)], column)
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("zipcode", "zips"), ("temp_f", "temps"), ("response_time", "seconds"))]
        told.append(fact.groupBy(F.lit(tag).alias("fact"), "year").agg(F.count("*").alias("n"), F.count("type_code").alias("codes"), *sums))
    return reduce(DataFrame.unionByName, told)


# --- component runs; the sum and the squared sum of all eigenvalues follow from the correlations ---

PARTS = "features:int ratio_sum:float6 eigen_sum:float6 eigen_squares:float6"


def spectrum(fit) -> DataFrame:
    value = F.col("eigenvalue")
    return fit.eigen().agg(
        F.count("*").alias("features"), F.sum("ratio").alias("ratio_sum"), F.sum(value).alias("eigen_sum"), F.sum(value * value).alias("eigen_squares")
    )


def spectrum_sql(rows: str, features: list[str]) -> str:
    """The trace of the correlation matrix and of its square, scaled from N to N - 1."""
    d = len(features)
    squares = " + ".join(f"2 * pow(corr({a}, {b}), 2)" for i, a in enumerate(features) for b in features[i + 1 :])
    scale = "(count(*) / (count(*) - 1.0))"
    return f"SELECT {d} AS features, 1.0 AS ratio_sum, {d} * {scale} AS eigen_sum, ({d} + {squares}) * pow({scale}, 2) AS eigen_squares FROM {rows}"


FIRE_COLUMNS = ["dispatch_time", "travel_time", "engines_assigned_quantity", "ladders_assigned_quantity", "other_units_assigned_quantity"]
FILLED = ", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in FIRE_COLUMNS)


@query("fire_components", PARTS, spectrum_sql(f"(SELECT {FILLED} FROM fb)", FIRE_COLUMNS), BUILT)
def fire_components(spark, sf):
    return spectrum(multivariate.fire_components(galaxy(spark, sf)["Fact_Incidents_Fire"])[1])


def area_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    built = galaxy(spark, sf)
    zips = built["Dim_Location"].select("location_key", "zipcode")
    folded = [multivariate.folded_responses(built[f], "location_key") for f in ("Fact_Incidents_EMS", "Fact_Incidents_Fire")]
    return tuple(f.join(zips, "location_key").drop("location_key") for f in folded)


AREAS = BUILT + """, areas AS (SELECT coalesce(x.zipcode, y.zipcode) AS zip, coalesce(x.n, 0) AS n1, x.r AS r1, coalesce(y.n, 0) AS n2, y.r AS r2
  FROM (SELECT zipcode, count(*) AS n, avg(response_time) AS r FROM fa JOIN dim_location USING (location_key) GROUP BY 1) x
  FULL JOIN (SELECT zipcode, count(*) AS n, avg(response_time) AS r FROM fb JOIN dim_location USING (location_key) GROUP BY 1) y
  ON x.zipcode = y.zipcode)"""
FOUR = ["n1", "r1", "n2", "r2"]


@query("area_components", PARTS, spectrum_sql("(SELECT n1, coalesce(r1, avg(r1) OVER ()) AS r1, n2, coalesce(r2, avg(r2) OVER ()) AS r2 FROM areas)", FOUR), AREAS)
def area_components(spark, sf):
    return spectrum(multivariate.area_components(*area_inputs(spark, sf))[1])


@query(
    "drop_components",
    PARTS + " n_scored:int n_extremes:int",
    f"""SELECT x.*, (SELECT count(*) FROM kept) AS n_scored, least(15, (SELECT count(*) FROM kept)) AS n_extremes
        FROM ({spectrum_sql('kept', ['l_quantity', 'price', 'tax'])}) x""",
    """kept AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, floor(l_extendedprice) AS price, nullif(round(l_tax * 100), 8) AS tax
              FROM lineitem WHERE nullif(round(l_tax * 100), 8) IS NOT NULL)""",
)
def drop_components(spark, sf):
    """Rows with a gap or repeated are dropped before the fit, and only the rows left are scored; features by type."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.floor("l_extendedprice").alias("price"),
        F.nullif(F.round(F.col("l_tax") * 100), F.lit(8.0)).alias("tax"),
    )
    features = numeric_columns(lines, ["l_orderkey", "l_linenumber"])
    kept, fit = fit_usable(lines.drop("l_returnflag"), features)
    counts = fit.scores(kept, ["l_orderkey"]).agg(F.count("pc1").alias("n_scored"))
    best = fit.extremes(kept, "l_orderkey", k=15).agg(F.count("dist").alias("n_extremes"))
    return spectrum(fit).withColumns({"n_scored": counts.scalar(), "n_extremes": best.scalar()})


# --- sources: each table is written in a raw form and read back by its reader ---


@query(
    "source_text_csv",
    "name:text place:text brand:text size:int",
    "SELECT p_name || chr(10) || 'x, \"' || p_size || '\"' AS name, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS place, p_brand AS brand, p_size AS size FROM part",
)
def source_text_csv(spark, sf):
    """Quoted line breaks, quotes, separators and null tokens; some columns cast on reading."""
    raw = table(spark, sf, "part").select(
        F.concat("p_name", F.lit('\nx, "'), text_of("p_size"), F.lit('"')).alias("name"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).otherwise("N/A").alias("place"),
        F.col("p_brand").alias("brand"), text_of("p_size").alias("size"),
    )
    path = new_path(spark, "csv")
    raw.write.option("header", True).option("escape", '"').csv(path)
    return read_keyed_csv(spark, path, {"size": "int"}).select("name", "place", "brand", "size")


def text_of(column: str) -> Column:
    return F.col(column).cast("string")


@query(
    "source_weather",
    "kind:text time:text temperature_2m:float windspeed_10m:int",
    """SELECT kind, strftime(h, '%Y-%m-%dT%H:%M') AS time, temp AS temperature_2m, wind AS windspeed_10m
       FROM hours CROSS JOIN (SELECT unnest(['csv', 'json']) AS kind)""",
    HOURLY,
)
def source_weather(spark, sf):
    """Hourly weather through its CSV and its column-oriented JSON, one document per day."""
    rows = roles.raw_weather(spark, sf)
    csv, documents = new_path(spark, "weather_csv"), new_path(spark, "weather_json")
    write_csv(rows, csv)
    numbers = {"temperature_2m": "double", "precipitation": "double", "weathercode": "int", "windspeed_10m": "double"}
    entry = F.struct("time", *[F.col(c).cast(t).alias(c) for c, t in numbers.items()])
    days = rows.groupBy(F.substring("time", 1, 10).alias("day")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    days.select("day", F.struct(*[F.col(f"e.{c}").alias(c) for c in ("time", *numbers)]).alias("hourly")).write.partitionBy("day").json(documents)
    kept = ["time", F.col("temperature_2m").cast("double").alias("temperature_2m"), F.col("windspeed_10m").cast("double").alias("windspeed_10m")]
    read = {"csv": read_weather(spark, csv), "json": read_weather_json(spark, documents)}
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind"), *kept) for k, df in read.items()])


@query("source_areas", "area:text x:float6 y:float6", "SELECT CAST(c_custkey AS VARCHAR) AS area, c_nationkey + 1.0 AS x, 2.0 AS y FROM customer")
def source_areas(spark, sf):
    """One square per customer as a GeoJSON feature per line, back as its centroid."""
    x, corners = F.col("c_nationkey"), ((0, 1), (2, 1), (2, 3), (0, 3), (0, 1))
    ring = F.array(*[F.array((x + dx).cast("double"), F.lit(float(y))) for dx, y in corners])
    feature = table(spark, sf, "customer").select(
        F.struct(text_of("c_custkey").alias("MODZCTA")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    path = new_path(spark, "areas")
    feature.write.json(path)
    return geographic.area_points(read_areas(spark, path, one_per_line=True)).select(F.col("area_code").alias("area"), "x", "y")


@query("source_marts", "name:text n:int total:float6", "SELECT 'orders' AS name, count(*) AS n, sum(floor(o_totalprice)) AS total FROM orders UNION ALL SELECT 'part', count(*), sum(p_size) FROM part")
def source_marts(spark, sf):
    """Mart tables written and read as Parquet, and one of them exported as CSV and read as text."""
    folder, export = new_path(spark, "marts"), new_path(spark, "export")
    orders = table(spark, sf, "orders").select(F.lit("orders").alias("name"), F.floor("o_totalprice").alias("v"))
    write_tables({"orders": orders, "part": table(spark, sf, "part").select(F.lit("part").alias("name"), F.col("p_size").alias("v"))}, folder)
    write_csv(read_table(spark, folder, "part", ["name", "v"]), export)
    back = read_text_table(spark, export, ["name", "v"], line_breaks=False).withColumn("v", F.col("v").cast("bigint"))
    both = read_table(spark, folder, "orders").unionByName(back)
    return both.groupBy("name").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
