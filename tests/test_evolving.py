"""Tables whose nested types grow with what is written."""

import pytest
from pyspark.sql import types as T

from creaseline.sinks import evolving, tables


def typed(ddl):
    return T.StructType.fromDDL(ddl)


@pytest.mark.parametrize(
    ("old", "new", "both"),
    [
        ("a int", "a bigint", "a bigint"), ("a bigint", "a int", "a bigint"), ("a float", "a double", "a double"), ("a int", "b string", "a int, b string"),
        ("s struct<x:int>", "s struct<y:string,x:bigint>", "s struct<x:bigint,y:string>"), ("l array<struct<x:int>>", "l array<struct<x:int,y:array<int>>>", "l array<struct<x:int,y:array<int>>>"),
        ("m map<string,struct<x:int>>", "m map<string,struct<x:double>>", "m map<string,struct<x:double>>"), ("a decimal(10,2)", "a decimal(12,2)", "a decimal(12,2)"), ("A int", "a int", "A int"),
    ],
)
def test_types_that_merge(spark, old, new, both):
    assert evolving.merged_type(typed(old), typed(new)).simpleString() == typed(both).simpleString()


@pytest.mark.parametrize(("old", "new"), [("a int", "a string"), ("a string", "a int"), ("s struct<x:int>", "s int"), ("a decimal(10,2)", "a decimal(10,3)"), ("l array<int>", "l array<string>"), ("a bigint", "a double"), ("a int", "b int, B int")])
def test_types_that_are_refused(spark, tmp_path, old, new):
    with pytest.raises(evolving.RefusedTypeError):
        evolving.merged_type(typed(old), typed(new))
    path = str(tmp_path / "t")
    if "B int" not in new:
        evolving.append(spark.createDataFrame([], typed(old)), path)
        with pytest.raises(evolving.RefusedTypeError):
            evolving.append(spark.createDataFrame([], typed(new)), path)
        assert evolving.versions(spark, path).count() == 1  # nothing was stored


def test_append_reads_old_files_under_the_new_type(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, {"x": 1}, [{"y": 2}], {"k": 3})], "id int, s struct<x:int>, l array<struct<y:int>>, m map<string,int>")
    assert evolving.append(one, path) == "INITIAL"
    assert evolving.append(one, path) == "NO_CHANGE"
    two = spark.createDataFrame([(2, {"x": 1 << 40, "new": "n"}, [{"y": 1.5, "z": [1]}], {"k": 1 << 40}), (3, None, None, None)], "id int, s struct<x:bigint,new:string>, l array<struct<y:double,z:array<int>>>, m map<string,bigint>")
    assert evolving.append(two, path) == "ADD"
    assert evolving.append(one.withColumn("id", one.id + 3).drop("m"), path) == "NO_CHANGE"  # older rows, one column less
    assert evolving.append(spark.createDataFrame([(1 << 50,)], "id bigint"), path) == "TYPE_CHANGE"
    got = sorted((r.asDict(recursive=True) for r in evolving.read(spark, path).collect()), key=str)
    old = {"id": 1, "s": {"x": 1, "new": None}, "l": [{"y": 2.0, "z": None}], "m": {"k": 3}}
    want = [old, old, {"id": 2, "s": {"x": 1 << 40, "new": "n"}, "l": [{"y": 1.5, "z": [1]}], "m": {"k": 1 << 40}}, {"id": 3, "s": None, "l": None, "m": None}, {**old, "id": 4, "m": None}, {"id": 1 << 50, "s": None, "l": None, "m": None}]
    assert got == sorted(want, key=str)
    assert [r.change for r in evolving.versions(spark, path).orderBy("version").collect()] == ["INITIAL", "ADD", "TYPE_CHANGE"]


def test_keyed_replace_with_a_nested_field_more(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(100).selectExpr("id", "named_struct('x', cast(id as int)) as s")
    assert evolving.keyed_replace(old, path, ["id"], buckets=8) == "INITIAL"
    new = spark.range(90, 110).selectExpr("id", "named_struct('x', id * 10, 'y', 'new') as s", "true as flag")
    assert evolving.keyed_replace(new, path, ["id"]) == "ADD"
    rows = {r.id: (r.s.x, r.s.y, r.flag) for r in evolving.read_keyed(spark, path).collect()}
    assert rows == {i: (i, None, None) if i < 90 else (i * 10, "new", True) for i in range(110)}
    evolving.keyed_replace(old.where("id = 105"), path, ["id"], scope=spark.createDataFrame([(1,), (105,)], "id long"))
    left = {r.id for r in evolving.read_keyed(spark, path).collect()}
    assert left == set(range(110)) - {1, 105} and tables.layout(spark, path) == 8
