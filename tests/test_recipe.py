import json

import pytest
from pyspark.sql import functions as F

from ladle.plans.recipe import RecipeContext, RecipeError, apply_recipe, decode_param, parse_recipe
from ladle.plans.recipe import step as register_step

SAMPLE_RECIPE = json.dumps([
    {"Action": {"Operation": "FILL_WITH_MOST_FREQUENT", "Parameters": {"sourceColumn": "cc_type"}}},
    {"Action": {"Operation": "YEAR", "Parameters": {"dateTimeFormat": "yyyy-mm-dd*HH:MM:SS",
                                                    "functionStepType": "YEAR", "sourceColumn": "cc_expiredate",
                                                    "targetColumn": "cc_expiredate_YEAR"}}},
    {"Action": {"Operation": "FLAG_COLUMN_FROM_PATTERN", "Parameters": {"pattern": "f", "sourceColumn": "gender",
                                                                        "targetColumn": "gender_flagged"}}},
    {"Action": {"Operation": "GROUP_BY", "Parameters": {
        "groupByAggFunctionOptions": "[{\"sourceColumnName\":\"cc_type\",\"targetColumnName\":\"cc_type_count\","
                                     "\"targetColumnDataType\":\"string\",\"functionName\":\"COUNT\"}]",
        "sourceColumns": "[\"state\"]", "useNewDataFrame": "false"}}},
    {"Action": {"Operation": "CATEGORICAL_MAPPING", "Parameters": {
        "categoryMap": "{\"Houston\":\"Houston\",\"Kansas City\":\"Kansas City\",\"Goff\":\"Goff\"}",
        "deleteOtherRows": "false", "mapType": "TEXT", "mappingOption": "TOP_X_VALUES", "other": "Others",
        "sourceColumn": "city", "targetColumn": "city_mapped"}}},
    {"Action": {"Operation": "MASK_RANGE", "Parameters": {
        "alphabet": "[\"WHITESPACE\",\"SYMBOLS\"]", "firstN": "5", "maskMode": "MASK_FIRST_N", "maskSymbol": "#",
        "sourceColumns": "[\"email\"]", "stop": "5"}}},
    {"Action": {"Operation": "MASK_DATE", "Parameters": {"maskSymbol": "#", "redact": "[\"YEAR\"]",
                                                         "sourceColumns": "[\"birthdate\"]"}}},
    {"Action": {"Operation": "REPLACE_WITH_RANDOM_BETWEEN", "Parameters": {
        "lowerBound": "1", "sourceColumns": "[\"cc_cvc\"]", "upperBound": "200"}}},
    {"Action": {"Operation": "SHUFFLE_ROWS", "Parameters": {"groupByColumns": "[\"state\"]",
                                                            "sourceColumns": "[\"zip\"]"}}},
])

SCHEMA = ("cc_type string, cc_expiredate string, gender string, state string, city string, email string, "
          "birthdate string, cc_cvc int, zip string")


def _rows(n=60):
    states, cities = ["TX", "CA", "NY"], ["Houston", "Goff", "Paris", "Kansas City"]
    out = []
    for i in range(n):
        out.append((None if i % 7 == 0 else ["VISA", "AMEX", "VISA", "MC"][i % 4],
                    f"20{20 + i % 5}-0{1 + i % 9}-1{i % 10}*0{i % 10}:1{i % 6}:2{i % 10}",
                    "f" if i % 3 == 0 else "m", states[i % 3], cities[i % 4], f"user{i}@domain.com",
                    f"19{50 + i % 40}-0{1 + i % 9}-2{i % 8}", 100 + i, f"{77000 + i}"))
    return out


def test_decode_param():
    assert decode_param("[\"a\"]") == ["a"]
    assert decode_param("false") is False
    assert decode_param("5") == "5"
    assert decode_param("{\"a\": \"b\"}") == {"a": "b"}


def test_parameters_are_decoded_by_kind():
    step = lambda op, **p: parse_recipe([{"Action": {"Operation": op, "Parameters": p}}]).steps[0].params
    assert step("FLAG_COLUMN_FROM_PATTERN", pattern="[a-z]+@x", sourceColumn="c", targetColumn="true")["pattern"] == "[a-z]+@x"
    for text in ("[1]", "{2}", "(x)", "True", "false", " [ ", ""):
        got = step("CATEGORICAL_MAPPING", sourceColumn="c", categoryMap='{"a": "[b]"}', other=text, deleteOtherRows="TRUE")
        assert got == {"sourceColumn": "c", "categoryMap": {"a": "[b]"}, "other": text, "deleteOtherRows": True}
    assert step("MASK_DATE", sourceColumns='["a", "b"]', redact="YEAR", maskSymbol="[") == {
        "sourceColumns": ["a", "b"], "redact": "YEAR", "maskSymbol": "["}
    assert step("GROUP_BY", sourceColumns="c", groupByAggFunctionOptions="[]", useNewDataFrame="false")["useNewDataFrame"] is False
    for op, bad in (("MASK_DATE", {"redact": "[YEAR"}), ("GROUP_BY", {"useNewDataFrame": "maybe"}), ("CATEGORICAL_MAPPING", {"categoryMap": "[1]"}),
                    ("CATEGORICAL_MAPPING", {"categoryMap": "a"}), ("CATEGORICAL_MAPPING", {"deleteOtherRows": "0"})):
        with pytest.raises(RecipeError):
            step(op, **bad)
    with pytest.raises(ValueError):
        register_step("X", kinds={"a": "number"})


def test_patterns_that_begin_with_a_bracket_run(spark):
    df = spark.createDataFrame([("ab@x",), ("12",), (None,), ("[x]",)], "c string")
    recipe = [{"Action": {"Operation": "FLAG_COLUMN_FROM_PATTERN", "Parameters": {"pattern": p, "sourceColumn": "c", "targetColumn": t}}}
              for p, t in (("[a-z]+@x", "f"), ("(1|2){2}", "g"), ("\\[x\\]", "h"))]
    assert [tuple(r)[1:] for r in apply_recipe(df, recipe).collect()] == [
        (True, False, False), (False, True, False), (None, None, None), (False, False, True)]


def test_key_files_are_read_whole(tmp_path):
    from argparse import Namespace

    from ladle.__main__ import _ctx
    key = b"\n \tkey\x00 \r\n"
    (tmp_path / "k").write_bytes(key)
    args = Namespace(secret=[f"id={tmp_path / 'k'}"], seed=1, day_first_when_ambiguous=False)
    assert _ctx(args).secrets == {"id": key}


def test_empty_recipe_is_identity(spark):
    df = spark.createDataFrame(_rows(5), SCHEMA)
    assert apply_recipe(df, None) is df
    assert apply_recipe(df, "[]") is df
    assert len(parse_recipe("")) == 0


def test_unknown_operation_and_column_fail_before_running(spark):
    df = spark.createDataFrame(_rows(5), SCHEMA)
    with pytest.raises(RecipeError):
        apply_recipe(df, [{"Action": {"Operation": "NOPE", "Parameters": {}}}])
    with pytest.raises(RecipeError):
        apply_recipe(df, [{"Action": {"Operation": "MASK_RANGE", "Parameters": {
            "sourceColumns": "[\"missing\"]", "firstN": "5"}}}])


def test_sample_recipe_end_to_end(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    out = apply_recipe(df, SAMPLE_RECIPE, RecipeContext(seed=3))
    assert out.columns == df.columns + ["cc_expiredate_YEAR", "gender_flagged", "cc_type_count", "city_mapped"]
    res = out.collect()
    assert len(res) == len(rows)
    # fill: no nulls left, most frequent is VISA
    assert all(r.cc_type is not None for r in res)
    assert sum(r.cc_type == "VISA" for r in res) == sum(1 for x in rows if x[0] in (None, "VISA"))
    assert all(2020 <= r.cc_expiredate_YEAR <= 2024 for r in res)
    assert {r.gender_flagged for r in res if r.gender == "f"} == {True}
    per_state = {s: sum(1 for x in rows if x[3] == s) for s in ("TX", "CA", "NY")}  # counted after the fill
    assert all(r.cc_type_count == str(per_state[r.state]) for r in res)
    assert {r.city_mapped for r in res} == {"Houston", "Goff", "Others", "Kansas City"}
    assert all(r.email.startswith("#####") for r in res)
    assert all(r.birthdate.startswith("####/") for r in res)
    assert all(1 <= r.cc_cvc <= 200 for r in res)
    # shuffle keeps the multiset of zip per state
    for s in ("TX", "CA", "NY"):
        assert sorted(r.zip for r in res if r.state == s) == sorted(x[8] for x in rows if x[3] == s)


def test_expression_steps_are_fused(spark):
    df = spark.createDataFrame(_rows(5), SCHEMA)
    recipe = [{"Action": {"Operation": "MASK_RANGE", "Parameters": {"sourceColumns": "[\"email\"]", "firstN": "2"}}},
              {"Action": {"Operation": "FLAG_COLUMN_FROM_PATTERN", "Parameters": {
                  "pattern": "m", "sourceColumn": "gender", "targetColumn": "g"}}}]
    plan = apply_recipe(df, recipe)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_dependent_steps_see_earlier_output(spark):
    df = spark.createDataFrame([("abcdef",)], "v string")
    recipe = [{"Action": {"Operation": "MASK_RANGE", "Parameters": {"sourceColumns": "[\"v\"]", "firstN": "2"}}},
              {"Action": {"Operation": "FLAG_COLUMN_FROM_PATTERN", "Parameters": {
                  "pattern": "^##", "sourceColumn": "v", "targetColumn": "f"}}}]
    assert apply_recipe(df, recipe).first().f is True


def test_year_pattern_variants(spark):
    df = spark.createDataFrame([("2024-03-05*10:11:12",), ("2023-01-02T01:02:03",), ("2022-12-31",), ("junk",),
                                (None,)], "d string")
    from ladle.operators.dates import year_of
    got = [r.y for r in df.select(year_of(df, "d", "yyyy-mm-dd*HH:MM:SS").alias("y")).collect()]
    assert got == [2024, 2023, 2022, None, None]


def test_group_by_new_frame_functions(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 2.0)], "k string, v double")
    from ladle.operators.group import group_new_frame
    opts = [{"sourceColumnName": "v", "targetColumnName": "s", "functionName": "SUM"},
            {"sourceColumnName": "v", "targetColumnName": "a", "functionName": "AVG"},
            {"sourceColumnName": "v", "targetColumnName": "c", "functionName": "COUNT"}]
    got = {r.k: (r.s, r.a, r.c) for r in group_new_frame(df, ["k"], opts).collect()}
    assert got == {"a": (4.0, 2.0, 2), "b": (None, None, 0), None: (2.0, 2.0, 1)}


def test_group_append_keeps_null_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), (None, 5)], "k string, v int")
    from ladle.operators.group import group_append
    out = group_append(df, ["k"], [{"sourceColumnName": "v", "targetColumnName": "n", "functionName": "COUNT"}])
    assert sorted((r.k or "", r.v, r.n) for r in out.collect()) == [
        ("", 3, 3), ("", 4, 3), ("", 5, 3), ("a", 1, 2), ("a", 2, 2)]


def test_categorical_large_map_uses_join(spark):
    from ladle.operators.category import map_categories
    mapping = {str(i): f"c{i % 3}" for i in range(1500)}
    df = spark.createDataFrame([(str(i),) for i in range(0, 3000, 7)] + [(None,)], "v string")
    got = {r.v: r.m for r in map_categories(df, "v", "m", mapping, other="zz").collect()}
    assert got["7"] == "c1" and got["2996"] == "zz" and got[None] == "zz"


def test_checkpoint_after_cuts_lineage(spark):
    df = spark.createDataFrame(_rows(30), SCHEMA)
    recipe = [{"Action": {"Operation": "SHUFFLE_ROWS", "Parameters": {"groupByColumns": "[\"state\"]",
                                                                      "sourceColumns": "[\"zip\"]"}}}]
    out = apply_recipe(df, recipe, RecipeContext(checkpoint_after=("SHUFFLE_ROWS",)))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "Window" not in plan and out.count() == 30


def test_user_registered_step(spark):
    from ladle.plans.recipe import registered_operations, step

    @step("UPPER_CASE_TEST", kind="expr")
    def _upper(df, ctx, sourceColumn, **_):
        return {sourceColumn: F.upper(F.col(sourceColumn))}

    assert "UPPER_CASE_TEST" in registered_operations()
    df = spark.createDataFrame([("abc",)], "v string")
    out = apply_recipe(df, [{"Action": {"Operation": "UPPER_CASE_TEST", "Parameters": {"sourceColumn": "v"}}}])
    assert out.first().v == "ABC"


def test_load_recipe_from_location(spark):
    import os
    from ladle.plans.recipe import load_recipe
    from ladle.session import scratch_dir
    root = scratch_dir(spark, "recipe").replace("file:", "")
    os.makedirs(root)
    with open(f"{root}/r.json", "w") as f:
        f.write(SAMPLE_RECIPE)
    open(f"{root}/empty.json", "w").close()
    assert len(load_recipe(spark, f"{root}/r.json")) == 9
    assert len(load_recipe(spark, f"{root}/empty.json")) == 0
    assert len(load_recipe(spark, None)) == 0


def test_size_checked_join_both_paths(spark):
    from ladle.operators.joins import attach_checked
    big = spark.createDataFrame([(i % 5 if i % 7 else None, i) for i in range(200)], "k int, v int")
    table = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    small = attach_checked(big, table, ["k"], max_bytes=1 << 20)
    large = attach_checked(big, table, ["k"], max_bytes=1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    a = sorted((r.k if r.k is not None else -1, r.v, r.n) for r in small.collect())
    b = sorted((r.k if r.k is not None else -1, r.v, r.n) for r in large.collect())
    assert a == b and len(a) == 200
