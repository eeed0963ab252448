import json

import pytest
from pyspark.sql import functions as F

from conftest import plan, values
from tablehaul import LoadError
from tablehaul.functions import contains_text, field_rank, parse_flag, starts_with_text
from tablehaul.operators.shape import (first_per_key, flatten_json, lookup_any_key, lookup_priority,
                                       with_extra_columns)


def test_preferred_name_per_concept(spark):
    """Own locale, then English, then preferred, then typed, then full names before short ones."""
    names = spark.createDataFrame([
        (1, "fr full", "fr", 0, "FULLY_SPECIFIED"), (1, "fr preferred", "fr", 1, None), (1, "en", "en", 1, "SHORT"),
        (2, "en short", "en", 0, "SHORT"), (2, "en full", "en", 0, "FULLY_SPECIFIED"), (2, "en untyped", "en", 0, None),
        (3, "ht", "ht", 0, None)], "concept_id bigint, name string, locale string, preferred int, type string")
    facts = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, 4), (14, 1)], "id int, concept_id int")
    order = [F.when(F.col("locale") == "fr", 0).otherwise(1), F.when(F.col("locale") == "en", 0).otherwise(1),
             F.desc("preferred"), F.col("type").isNull(), field_rank(F.col("type"), "FULLY_SPECIFIED", "SHORT"), "name"]
    got = lookup_priority(facts, names, ["concept_id"], order, ["name"])
    assert values(got, "id", "name") == [(10, "fr preferred"), (11, "en full"), (12, "ht"), (13, None),
                                         (14, "fr preferred")]


def test_one_row_per_key_leaves_the_task_before_the_shuffle(spark):
    hot = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    best = first_per_key(hot, ["k"], [F.desc("v")])
    text = plan(best)
    assert text.count("WindowGroupLimit") >= 2
    assert values(best.where("k = 0")) == [(0, 2997)]


def test_lookup_by_any_key(spark):
    dim = spark.createDataFrame([(1, "uuid-a", "Alpha"), (2, "uuid-b", "Beta"), (3, "Beta-x", "uuid-c")],
                                "id int, uuid string, name string")
    facts = spark.createDataFrame([(1, "Alpha"), (2, "uuid-b"), (3, "Beta"), (4, "none"), (5, None)],
                                  "n int, wanted string")
    got = lookup_any_key(facts, dim, "wanted", ["name", "uuid"], "id")
    assert values(got) == [(1, "Alpha", 1), (2, "uuid-b", 2), (3, "Beta", 2), (4, "none", None), (5, None, None)]


def test_a_key_with_two_meanings_fails_only_when_used(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (3, "y")], "id int, name string")
    fine = spark.createDataFrame([(1, "y")], "n int, wanted string")
    assert values(lookup_any_key(fine, dim, "wanted", ["name"], "id")) == [(1, "y", 3)]
    with pytest.raises(Exception, match="More than one row for x"):
        lookup_any_key(spark.createDataFrame([(1, "x")], "n int, wanted string"), dim, "wanted", ["name"], "id").collect()


def brute_leaves(node, path=""):
    if isinstance(node, dict):
        for key, value in node.items():
            yield from brute_leaves(value, f"{path}.{key}" if path else key)
    elif isinstance(node, list):
        for i, value in enumerate(node):
            yield from brute_leaves(value, f"{path}[{i}]")
    else:
        yield path, node


def deep(levels):
    node = "bottom"
    for i in range(levels):
        node = {"k": node, "n": i} if i % 2 else [node, "side"]
    return node


DOCS = [{"a": {"b": [1, {"c": "x"}], "e": {}}, "d": None, "f": True, "text": "with [ and { inside"}, [], {}, "top",
        deep(40), {"": {"x": "empty name"}}, [[["a"]], [], ["b", ["c"]]], 7]


def as_text(value):
    return value if value is None or isinstance(value, str) else json.dumps(value)


@pytest.mark.parametrize("text_only", [False, True])
def test_flatten_any_depth(spark, text_only):
    data = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCS)] + [(99, None)], "id int, doc string")
    want = sorted((i, path, as_text(v)) for i, d in enumerate(DOCS) for path, v in brute_leaves(d)
                  if isinstance(v, str) or not text_only)
    got = sorted((tuple(r) for r in flatten_json(data, "id", "doc", text_only=text_only).collect()),
                 key=lambda r: (r[0], r[1]))
    assert got == sorted(want, key=lambda r: (r[0], r[1]))


def test_flatten_malformed(spark):
    data = spark.createDataFrame([(1, '{"a": 1}'), (2, "{broken")], "id int, doc string")
    with pytest.raises(Exception):
        flatten_json(data, "id", "doc").collect()
    assert values(flatten_json(data, "id", "doc", skip_malformed=True)) == [(1, "a", "1")]


def test_extra_columns_may_use_any_column(spark):
    got = with_extra_columns(spark.range(2), [("twice", "int", "id * 2"), ("site", "string", "'x'")])
    assert values(got) == [(0, 0, "x"), (1, 2, "x")]
    with pytest.raises(LoadError):
        with_extra_columns(spark.range(2), [("ID", "int", "1")])


def test_text_filters(spark):
    names = spark.createDataFrame([("Primary Care",), ("primary x",), ("ZL VIH",), (None,)], "n string")
    assert names.where(starts_with_text(F.col("n"), "Primary")).count() == 1
    assert names.where(starts_with_text(F.col("n"), "PRIMARY", ignore_case=True)).count() == 2
    assert names.where(contains_text(F.col("n"), "vih", ignore_case=True)).count() == 1
    assert names.where(contains_text(F.col("n"), "vih")).count() == 0


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "names")
    spark.sql("SELECT 'red bolt' AS n, 1 AS other").write.parquet(path)
    text = plan(spark.read.parquet(path).where(starts_with_text(F.col("n"), "red")).select("n"))
    assert "StringStartsWith(n,red)" in text and "ReadSchema: struct<n:string>" in text


def test_flags(spark):
    flags = spark.createDataFrame([(t,) for t in ("true", "T", "yes", "1", "5", "0", "false", "no", "junk", None)], "t string")
    got = [r[0] for r in flags.select(parse_flag(F.col("t"))).collect()]
    assert got == [True, True, True, True, True, False, False, False, False, False]


def test_depth_is_measured(spark):
    from tablehaul.operators.shape import json_depth

    texts = [("{}", 1), ("5", 0), (None, 0), ('"[[["', 0), ('{"a[": "{\\"["}', 1), ('{"a": [1, {"b": []}, "]"]}', 4), ("[" * 300 + "]" * 300, 300),
             ('{"long": "' + "x" * 200_000 + '"}', 1)]
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string").select("i", json_depth(F.col("t"))).collect()
    assert [d for _, d in sorted(got)] == [d for _, d in texts]


def test_levels_beyond_one_plan(spark):
    rows = [(i, '{"a":[' * i + f'"{i}", true' + "]}" * i) if i else (0, '"0"') for i in (0, 1, 7, 8, 9, 20)]
    got = flatten_json(spark.createDataFrame(rows, "id int, doc string"), "id", "doc", text_only=True)
    assert set(values(got)) == {(i, ".".join(["a[0]"] * i), str(i)) for i, _ in rows}
    mixed = flatten_json(spark.createDataFrame(rows + [(99, "[[[broken")], "id int, doc string"), "id", "doc", skip_malformed=True)
    assert mixed.count() == 11
