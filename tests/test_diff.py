import pytest
from pyspark.sql import functions as F

from ratesmith.operators import diff

NAN = float("nan")


def test_equal_tables_have_no_differences(spark):
    left = spark.createDataFrame([(1, NAN, None), (1, NAN, None), (2, 0.5, "x")], "a int, b double, c string")
    right = spark.createDataFrame([("x", 2, 0.5), (None, 1, NAN), (None, 1, NAN)], "c string, a int, b double")
    assert diff.row_differences(left, right).isEmpty()
    with pytest.raises(diff.SchemaMismatch):
        diff.row_differences(left, right, ignore_columns_order=False)


def test_copies_count(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "a int")
    right = spark.createDataFrame([(1,), (2,), (4,), (4,)], "a int")
    assert rows(diff.row_differences(left, right)) == [(1, 2, 1), (3, 1, 0), (4, 0, 2)]


def test_assertion_shows_differences(spark):
    left = spark.createDataFrame([(1,)], "a int")
    diff.assert_none(diff.row_differences(left, left))
    with pytest.raises(diff.DifferencesFound, match="a=1"):
        diff.assert_none(diff.row_differences(left, left.where("a > 1")))


def test_arrays_compare(spark, rows):
    left = spark.createDataFrame([([1, 2],), (None,)], "a array<int>")
    right = spark.createDataFrame([([2, 1],), (None,)], "a array<int>")
    assert diff.row_differences(left, right).count() == 2


def test_schema_differences(spark, rows):
    left = spark.createDataFrame([], "a int, b array<int>, s struct<x:int>, only string")
    right = spark.createDataFrame([], "a int, b array<string>, s struct<x:bigint>")
    assert diff.schema_differences(left, right) == [
        ("b", "2: array<int>", "2: array<string>"),
        ("s", "3: struct<x:int>", "3: struct<x:bigint>"), ("only", "4: string", "missing")]
    required = spark.createDataFrame([], "a int NOT NULL")
    optional = spark.createDataFrame([], "a int")
    assert diff.schema_differences(required, optional) == []
    assert len(diff.schema_differences(required, optional, ignore_nullable=False)) == 1
    moved = right.select("s", "b", "a")
    assert diff.schema_differences(right, moved, ignore_order=True) == []
    assert len(diff.schema_differences(right, moved)) == 2
    assert diff.schema_report(right, moved).isEmpty()


def test_approximate_rows(spark, rows):
    schema = "k int, v double, t string"
    left = spark.createDataFrame(
        [(1, 1.0, "a"), (2, 1.0, "a"), (3, NAN, "a"), (4, None, "a"), (5, 1.0, "a"), (6, 1.0, "a"),
         (6, 1.0, "a"), (7, 1.0, None)], schema)
    right = spark.createDataFrame(
        [(1, 1.05, "a"), (2, 1.2, "b"), (3, NAN, "a"), (4, 1.0, "a"), (8, 1.0, "a"), (6, 1.0, "a"),
         (7, 1.0, None)], schema)
    found = diff.approximate_differences(left, right, ["k"], 0.1)
    assert rows(found, "k", "difference") == [
        (2, "v,t"), (4, "v"), (5, "missing"), (6, "repeated key"), (8, "missing")]


def test_columns(spark, rows):
    df = spark.createDataFrame(
        [(1, 1.0, 1.0), (2, 1.0, 1.05), (3, None, None), (4, None, 1.0), (5, 1.0, 2.0)],
        "k int, a double, b double")
    assert rows(diff.column_differences(df, "a", "b"), "k") == [(2,), (4,), (5,)]
    assert rows(diff.column_differences(df, "a", "b", 0.1), "k") == [(4,), (5,)]


def test_repeated_names_are_fields_of_their_own(spark, rows):
    two = spark.sql("SELECT 1 AS x, 2 AS x")
    one = spark.sql("SELECT 1 AS x")
    for ordered in (True, False):
        assert [name for name, *_ in diff.schema_differences(two, one, ignore_order=not ordered)] == ["x#2"]
    with pytest.raises(diff.SchemaMismatch):
        diff.row_differences(two, one)
    assert diff.row_differences(two, two).isEmpty()
    assert rows(diff.row_differences(two, spark.sql("SELECT 2 AS x, 1 AS x"))) == [(1, 2, 1, 0), (2, 1, 0, 1)]


def test_nested_differences_name_their_path(spark):
    left = spark.createDataFrame([], "a int, s struct<x:int,t:array<struct<y:string>>>, m map<string,int>, o double")
    right = spark.createDataFrame([], "a int, s struct<x:bigint,t:array<struct<y:string,z:int>>>, m map<string,double>")
    assert diff.tree_differences(left, right) == [
        ("s.x", "int", "bigint"), ("m{value}", "int", "double"), ("o", "double", "missing"),
        ("s.t[].z", "missing", "int")]
    assert diff.tree_differences(left, left, ignore_nullable=False, ignore_order=False) == []
    required = spark.createDataFrame([], "s struct<x:int NOT NULL>")
    optional = spark.createDataFrame([], "s struct<x:int>")
    assert diff.tree_differences(required, optional) == []
    assert diff.tree_differences(required, optional, ignore_nullable=False) == [("s.x", "int not null", "int null")]
    moved = spark.createDataFrame([], "s struct<y:int,x:int>")
    plain = spark.createDataFrame([], "s struct<x:int,y:int>")
    assert diff.tree_differences(plain, moved) == []
    assert len(diff.tree_differences(plain, moved, ignore_order=False)) == 2
    assert diff.tree_differences(spark.sql("SELECT 1 AS x, 2 AS x"), spark.sql("SELECT 1 AS x")) == [
        ("x#2", "int", "missing")]


def test_options_of_table_comparison(spark, rows):
    left = spark.createDataFrame([(1, NAN, [1.0]), (2, 0.5, [NAN]), (3, 1.04, [0.0])], "k int, v double, a array<double>")
    right = left.select("a", "v", "k")
    with pytest.raises(diff.SchemaMismatch):
        diff.table_differences(left, right, allow_nan_equality=True)
    same = dict(ignore_column_order=True, ignore_nullable=True)
    assert diff.table_differences(left, right, allow_nan_equality=True, **same).isEmpty()
    # NaN equals nothing, inside arrays too
    assert rows(diff.table_differences(left, right, **same), "k") == [(1,), (2,)]
    moved = right.withColumn("v", F.col("v") + 0.01)
    rounded = [lambda df: df.withColumn("v", F.round("v", 1)), lambda df: df.drop("a")]
    assert rows(diff.table_differences(left, moved, rounded, allow_nan_equality=True, **same), "k") == [(3,), (3,)]
    assert diff.table_differences(left, moved, [lambda df: df.select("k")], **same).isEmpty()


def test_approximate_comparison_sorts_no_rows(spark, rows):
    table = spark.range(2000).select(
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), (F.col("id") * 0.5).alias("v"), F.lit("t").alias("t"))
    unique = table.where("k IS NOT NULL").unionByName(table.where("k IS NULL").limit(1))
    changed = unique.withColumn("v", F.when(F.col("k") % 7 == 1, F.col("v") + 1).otherwise(F.col("v") + 0.001))
    found = diff.approximate_differences(unique, changed, ["k"], 0.01)
    assert rows(found, "k", "difference") == sorted(
        [(k, "v") for k in range(2000) if k % 50 and k % 7 == 1], key=repr)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    null_key = unique.withColumn("v", F.when(F.col("k").isNull(), F.lit(-1.0)).otherwise(F.col("v")))
    assert rows(diff.approximate_differences(unique, null_key, ["k"], 0.01), "k", "difference") == [(None, "v")]
