"""Column functions on toy rows (edge cases from FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from scorekeep.functions.answers import display_answer, normalize_answer
from scorekeep.functions.rules import answer_key, rule_map, rule_score
from scorekeep.functions.shardhash import (java_string_hash, java_string_hash_py, shard_index,
                                           shard_index_py)
from scorekeep.functions.violation import fix_violation, float_sum


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


@pytest.mark.parametrize("raw,expected", [
    ("C,A", "ac"), ("A,C", "ac"), ("A", "A"), ("a", "a"), ("AC", "AC"), ("A,,B", "ab"),
    (",", ""), ("A,A", "aa"), ("A, B", " ba"), ("A,", "a"), (None, None),
])
def test_normalize_answer(spark, raw, expected):
    assert one(spark, normalize_answer("a"), [(raw,)], "a string") == [expected]


def test_normalize_is_order_free(spark):
    rows = [("B,C,A",), ("A,B,C",), ("C,A,B",)]
    assert set(one(spark, normalize_answer("a"), rows, "a string")) == {"abc"}


def _key(spark, rules):
    q = spark.createDataFrame([(1, 2, rules)], "id long, type int, rules string")
    return {r["answerKey"]: r["ruleScore"] for r in answer_key(q).collect()}


def test_rule_key_last_wins_and_skips(spark):
    rules = ('[{"type":"group","values":[{"name":"A,C","score":1},{"name":"C,A","score":5}]},'
             '{},{"type":"other","values":[{"name":"B","score":7}]},'
             '{"type":"GROUP","values":[{"name":"D","score":"3"},{"score":9}]}]')
    assert _key(spark, rules) == {"ac": 5.0, "D": 3.0}


def test_rule_key_repeat_across_entries(spark):
    rules = ('[{"type":"group","values":[{"name":"A","score":1}]},'
             '{"type":"group","values":[{"name":"A","score":2.5}]}]')
    assert _key(spark, rules) == {"A": 2.5}


def test_rule_score_cases(spark):
    rules = '[{"type":"group","values":[{"name":"A","score":4},{"name":"A,C","score":8}]}]'
    df = spark.createDataFrame(
        [(rules, "C,A"), (rules, "A"), (rules, ""), (rules, None), (rules, "B"), (None, "A")],
        "rules string, answer string")
    got = [r[0] for r in df.select(rule_score(rule_map("rules"), "answer")).collect()]
    assert got == [8.0, 4.0, 0.0, 0.0, 0.0, 0.0]


def test_rule_score_non_numeric_text_is_zero(spark):
    rules = '[{"type":"group","values":[{"name":"A","score":"x"}]}]'
    df = spark.createDataFrame([(rules, "A")], "rules string, answer string")
    assert df.select(rule_score(rule_map("rules"), "answer")).collect()[0][0] == 0.0


@pytest.mark.parametrize("dtype,score,rule,expected", [
    (4, 9.0, (2, 5.0), 0.0), (4, 0.5, (3, 1.0), 0.0), (4, 9.0, (3, 1.0), 8.0),
    (4, 9.0, (3, -1.0), 8.0), (4, 9.0, (1, 3.0), 9.0), (1, 9.0, (3, 1.0), None),
    (None, 9.0, (3, 1.0), None),
])
def test_fix_violation(spark, dtype, score, rule, expected):
    got = one(spark, fix_violation("d", "s", *rule), [(dtype, score)], "d int, s double")
    assert got == [expected]


def test_fix_violation_is_float(spark):
    df = spark.createDataFrame([(4, 9.0)], "d int, s double").select(
        fix_violation("d", "s").alias("f"))
    assert df.schema["f"].dataType.typeName() == "float"


def test_float_sum(spark):
    df = spark.createDataFrame([(None, 2.0, None), (None, None, None), (1.5, 2.0, 0.5)],
                               "a double, b double, c double")
    assert [r[0] for r in df.select(float_sum("a", "b", "c")).collect()] == [2.0, 0.0, 4.0]


def test_display_answer(spark):
    df = spark.createDataFrame([("B", "A", 1, 2), ("B", "A", 1, 0), ("B", "A", 0, 3)],
                               "answer string, fixAnswer string, isDubious int, dubiousType int")
    assert [r[0] for r in df.select(display_answer()).collect()] == ["A", "B", "B"]


@pytest.mark.parametrize("key,h", [
    ("hello", 99162322), ("exam-102/student-77", None),
    ("", 0), ("a", 97), ("polygenelubricants", -2147483648), ("héllo中", None),
])
def test_java_string_hash(spark, key, h):
    got = one(spark, java_string_hash("k"), [(key,)], "k string")[0]
    assert got == java_string_hash_py(key)
    if h is not None:
        assert got == h


def test_java_hash_surrogate_pairs(spark):
    key = "x\U0001F600y"
    assert one(spark, java_string_hash("k"), [(key,)], "k string")[0] == java_string_hash_py(key)


def test_shard_index_min_value(spark):
    # Math.abs(Integer.MIN_VALUE) stays negative, so the remainder keeps its sign
    assert shard_index_py("polygenelubricants", 3) == -2
    got = one(spark, shard_index("k", 3), [("polygenelubricants",)], "k string")
    assert got == [-2]


def test_shard_index_matches_python(spark):
    keys = [(str(i),) for i in range(200)] + [("P0",), ("P1",)]
    got = one(spark, shard_index("k", 8), keys, "k string")
    assert got == [shard_index_py(k, 8) for (k,) in keys]


def test_null_key_hash_is_null(spark):
    assert one(spark, java_string_hash("k"), [(None,)], "k string") == [None]


def test_fixed_rule_sets_parse(spark):
    from scorekeep.sources.fixtures import RULE_SET_0, RULE_SET_1, RULE_SET_2
    assert _key(spark, RULE_SET_0) == {"A": 1.0, "ar": 3.0, "nr": 2.0, "R": 1.5}
    assert _key(spark, RULE_SET_1) == {"ar": 2.5, "N": 1.0}
    assert _key(spark, RULE_SET_2) == {"A": 0.5, " nr": 3.0, "nr": 4.0}


def test_literal_float_columns(spark):
    df = spark.range(1).select(float_sum(F.lit(0.0), F.lit(0.5)).alias("x"))
    assert df.collect()[0][0] == 0.5


BROKEN = ['[{"type":"group","values":[{"name":"A"', "nonsense", '{"type":"group"}', '[1,2]', '[{"type":"group","values":7}]']
NO_RULES = [None, "", "  ", "null", "[]", '[{"type":"other"}]']


def test_broken_rules_are_listed_or_fail(spark):
    from scorekeep.functions.rules import rejected_rules, with_rule_map
    good = '[{"type":"group","values":[{"name":"A","score":2}]}]'
    odd = '[{"type":"group","values":[{"name":"A","score":"two"}]}]'
    rows = [(i, 2, r) for i, r in enumerate([good, odd, *NO_RULES, *BROKEN])] + [(99, 1, "nonsense")]
    q = spark.createDataFrame(rows, "id int, type int, rules string")
    got = {r["questionId"]: r["reason"] for r in rejected_rules(q).collect()}
    assert got == {1: "score is no number"} | {i: "unreadable" for i in range(8, 8 + len(BROKEN))}
    kept = with_rule_map(q.where("id < 8")).collect()
    assert kept[0]["ruleMap"] == {"A": 2.0} and len(kept) == 8
    for r in BROKEN:
        with pytest.raises(Exception, match="answer rules cannot be read"):
            with_rule_map(q.where(F.col("rules") == r).where("id < 99")).collect()
    assert all(r["ruleMap"] is None for r in with_rule_map(q.where("id >= 8"), on_broken="reject").collect())


def test_scorer_in_sql_text(spark):
    from scorekeep.functions.sql import register_scorer
    q = spark.createDataFrame([(1, 2, '[{"type":"group","values":[{"name":"C,A","score":8},{"name":"B","score":1}]}]'), (2, 2, None)],
                              "id int, type int, rules string")
    name = register_scorer(spark, q, "score_in_test")
    spark.createDataFrame([(1, "A,C"), (1, "B"), (1, "b"), (1, ""), (1, None), (2, "A,C"), (3, "B")],
                          "q int, a string").createOrReplaceTempView("given_answers")
    df = spark.sql(f"SELECT q, a, {name}(q, a) AS s FROM given_answers")
    assert {(r["q"], r["a"]): r["s"] for r in df.collect()} == {
        (1, "A,C"): 8.0, (1, "B"): 1.0, (1, "b"): 0.0, (1, ""): 0.0, (1, None): 0.0, (2, "A,C"): 0.0, (3, "B"): 0.0}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" in plan
