from pyspark.sql import functions as F

from eventide.functions.jsonmatch import json_contains, json_text_eq

DOCS = [
    (1, '{"test":true}'),
    (2, '{"test":"true"}'),
    (3, '{"test":false}'),
    (4, '{}'),
    (5, '{"a":{"b":[1,2,{"c":3}]}}'),
    (6, '{"v":1}'),
    (7, '{"v":1.0}'),
    (8, '{"k":1,"k":2}'),
    (9, 'not json'),
    (10, None),
    (11, '[1,2,"x"]'),
    (12, '{"a.b":{"c d":5}}'),
]


def _match(spark, pattern):
    df = spark.createDataFrame(DOCS, "id int, doc string")
    rows = df.select("id", json_contains("doc", pattern).alias("m")).orderBy("id").collect()
    return {r.id: r.m for r in rows}


def test_boolean_is_type_checked(spark):
    m = _match(spark, {"test": True})
    assert m[1] is True
    assert m[2] is False  # the string "true" is not the boolean true
    assert m[3] is False
    assert m[4] is False


def test_empty_object_matches_any_object(spark):
    m = _match(spark, {})
    assert all(m[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 12))
    assert m[11] is False  # an array is not an object


def test_nested_arrays_ignore_order_and_multiplicity(spark):
    assert _match(spark, {"a": {"b": [{"c": 3}]}})[5] is True
    assert _match(spark, {"a": {"b": [2, 1, 2]}})[5] is True
    assert _match(spark, {"a": {"b": [4]}})[5] is False
    assert _match(spark, {"a": {"b": 1}})[5] is False  # array does not contain a bare scalar below top level


def test_numbers_compare_by_value(spark):
    m1, m2 = _match(spark, {"v": 1}), _match(spark, {"v": 1.0})
    assert m1[6] and m1[7] and m2[6] and m2[7]
    assert _match(spark, {"v": "1"})[6] is False


def test_duplicate_key_keeps_last(spark):
    assert _match(spark, {"k": 2})[8] is True
    assert _match(spark, {"k": 1})[8] is False


def test_malformed_false_null_null(spark):
    m = _match(spark, {"test": True})
    assert m[9] is False
    assert m[10] is None


def test_top_level_array_contains_scalar(spark):
    m = _match(spark, 1)
    assert m[11] is True
    assert _match(spark, "\"x\"")[11] is True  # a str pattern is JSON text
    assert _match(spark, [2, "x"])[11] is True


def test_keys_with_dots_and_spaces(spark):
    assert _match(spark, {"a.b": {"c d": 5}})[12] is True


def test_not_works_like_sql(spark):
    df = spark.createDataFrame(DOCS, "id int, doc string")
    n = df.where(~json_contains("doc", {"test": True})).count()
    assert n == len(DOCS) - 2  # the match and the NULL document drop out


def test_text_equality(spark):
    df = spark.createDataFrame([('{"plan":"pro"}',), ('{"plan":"free"}',), ('{"plan":1}',)], "doc string")
    assert df.where(json_text_eq("doc", "plan", "pro")).count() == 1
    assert df.where(json_text_eq("doc", "plan", "1")).count() == 1


def test_no_python_udf_in_plan(spark):
    from eventide.plans.inspect import plan_text
    df = spark.createDataFrame(DOCS, "id int, doc string").where(json_contains("doc", {"a": {"b": [1]}}))
    text = plan_text(df)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert F  # keep import


def test_escaped_keys_still_match(spark):
    df = spark.createDataFrame([('{"\\u0074est": true}',), ('{"best": true}',), ('{"test": "tr\\u0075e"}',)], "doc string")
    got = [r.m for r in df.select(json_contains("doc", {"test": True}).alias("m")).collect()]
    assert got == [True, False, False]
    got = [r.m for r in df.select(json_contains("doc", {"test": "true"}).alias("m")).collect()]
    assert got == [False, False, True]
