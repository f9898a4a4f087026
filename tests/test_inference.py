import pytest

from martloom.sources.inference import as_types, column_types, kind_of, read_typed_table


def test_kinds(one):
    values = ["1", " -2 ", "1.0", "1e3", "99999999999999999999", "1e999", "true", "False", "TRUE", "yes", "", " ", "1,000", "nan", None]
    want = ["whole", "whole", "float", "float", "float", "text", "boolean", "boolean", "boolean", "text", "text", "text", "text", "text", None]
    assert one(kind_of, values) == want


def described(df):
    return {r["name"]: (r["type"], r["n_values"], r["n_nulls"], r["n_bad"], r["bad_example"]) for r in column_types(df).orderBy("position").collect()}


def test_columns(spark):
    rows = [
        ("1", "1", "True", "a", None, "1", "true", "1"),
        ("2", "2.5", "false", "b", None, "x", "3", "true"),
        (None, "3", None, "c", None, "2", "4", "b"),
        ("4", None, "TRUE", "d", None, "y", "false", None),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` STRING" for c in ["w", "f", "b", "t", "none", "mixed", "even", "a.b"]))
    assert described(df) == {
        "w": ("whole", 3, 1, 0, None),
        "f": ("float", 3, 1, 0, None),
        "b": ("boolean", 3, 1, 0, None),
        "t": ("text", 4, 0, 0, None),
        "none": ("null", 0, 4, 0, None),
        "mixed": ("mixed", 4, 0, 2, "x"),
        "even": ("mixed", 4, 0, 2, "false"),
        "a.b": ("mixed", 3, 1, 2, "b"),
    }
    assert [tuple(r[:4]) for r in column_types(df.limit(0)).orderBy("position").collect()] == [(i, c, "null", 0) for i, c in enumerate(df.columns)]
    typed = as_types(df, {"w": "whole", "f": "float", "b": "boolean", "mixed": "mixed"})
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "boolean"] + ["string"] * 5
    assert [(r.w, r.f, r.b) for r in typed.collect()] == [(1, 1.0, True), (2, 2.5, False), (None, 3.0, None), (4, None, True)]


def test_it_is_one_aggregate(spark):
    df = spark.createDataFrame([("1",) * 40] * 3, ", ".join(f"c{i} STRING" for i in range(40)))
    plan = column_types(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2 and plan.count("Generate inline") == 1


def test_typed_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,name,x\n1,"two\nlines",1.5\n2,N/A,\n3,"say ""hi""",2\n')
    table, types = read_typed_table(spark, str(tmp_path))
    assert dict(table.dtypes) == {"id": "bigint", "name": "string", "x": "double"}
    assert sorted(map(tuple, table.collect())) == [(1, "two\nlines", 1.5), (2, None, None), (3, 'say "hi"', 2.0)]
    assert types.count() == 3
    with pytest.raises(ValueError):
        read_typed_table(spark, str(tmp_path), ["absent"])
