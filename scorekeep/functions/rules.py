"""Multi-choice answer rules.

A question of type 2 carries a JSON rule text: an array of entries
``{"type": "group", "values": [{"name": "A,C", "score": 8}, ...]}``.  Each
``name`` is a comma list of options; a student's answer scores the value of
the name that normalises to the same key, or 0.

The rule text is turned into a ``map<string, float>`` column of the question
row itself (JVM higher-order functions, no explode, no shuffle, no join), so
scoring an answer is one map lookup inside the fact scan.  The same map,
exploded, is the answer-key table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekeep.fixed_values import MULTI_CHOICE_TYPE, RULE_GROUP_TYPE
from scorekeep.functions.answers import normalize_answer

RULE_SCHEMA = "array<struct<type:string, values:array<struct<name:string, score:string>>>>"
PAIRS_TYPE = "array<struct<k:string,s:float>>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rule_pairs(rules="rules") -> Column:
    """``array<struct<k, s>>``: (answer key, score) for every named value of
    every ``group`` entry, in rule order.

    Entries whose ``type`` equals ``group`` ignoring case are used; entries of
    any other type, or with no type, are skipped.  Values without a name are
    skipped.  ``score`` may be a JSON number or numeric text; it is read as a
    float, and text that is not a number gives null (scored as 0).
    """
    entries = F.from_json(_c(rules), RULE_SCHEMA)
    groups = F.filter(entries, lambda e: F.lower(e["type"]) == RULE_GROUP_TYPE)
    return F.flatten(F.transform(groups, lambda e: F.transform(
        F.filter(e["values"], lambda v: v["name"].isNotNull()),
        lambda v: F.struct(normalize_answer(v["name"]).alias("k"),
                           v["score"].try_cast("float").alias("s")))))


def _has_text(rules) -> Column:
    text = F.trim(_c(rules))
    return (text != "") & (F.lower(text) != "null")


def is_broken(rules="rules") -> Column:
    """Whether a text is there that is no list of rules: not JSON, no array of entries, or a group without a list of
    values.  Blank text and JSON null mean no rules."""
    return F.coalesce(_has_text(rules) & rule_pairs(rules).isNull(), F.lit(False))


def rejected_rules(question: DataFrame, id_col: str = "id", type_col: str = "type", rules_col: str = "rules") -> DataFrame:
    """(questionId, rules, reason) of multi-choice questions whose rules cannot be used as they stand: broken text,
    or a score that is no number (its answer key scores 0)."""
    unscored = F.exists(rule_pairs(rules_col), lambda p: p["s"].isNull())
    reason = F.when(is_broken(rules_col), F.lit("unreadable")).when(unscored, F.lit("score is no number"))
    return (question.where(F.col(type_col) == MULTI_CHOICE_TYPE)
            .select(F.col(id_col).alias("questionId"), F.col(rules_col).alias("rules"), reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def last_wins_map(pairs) -> Column:
    """Map from (key, score) pairs where a repeated key keeps its last score:
    a pair is kept only when no later pair has the same key."""
    p = _c(pairs)
    last = F.filter(p, lambda x, i: ~F.exists(
        F.slice(p, i + 2, F.size(p)), lambda o: o["k"] == x["k"]))
    return F.map_from_entries(last)


def rule_map(rules="rules") -> Column:
    """``map<answerKey, score>`` parsed from a rule text column."""
    return last_wins_map(rule_pairs(rules))


def with_rule_map(df: DataFrame, rules_col: str = "rules", out: str = "ruleMap",
                  only_when: Column | None = None, on_broken: str = "fail") -> DataFrame:
    """Add the rule map as a column, parsing the JSON once per row: the pairs
    are a separate projection that Catalyst keeps (it does not inline a
    non-trivial expression that is used more than once).  ``on_broken``: a rule
    text that cannot be read fails the job, or is left for ``rejected_rules``
    to list (its answers then score 0)."""
    pairs = rule_pairs(rules_col)
    if on_broken == "fail":
        # broken text must not score 0 unseen: the row that needs it fails the job
        pairs = F.coalesce(pairs, F.when(_has_text(rules_col), F.raise_error(F.concat(
            F.lit("answer rules cannot be read: "), F.substring(_c(rules_col), 1, 200))).cast(PAIRS_TYPE)))
    elif on_broken != "reject":
        raise ValueError("on_broken is fail or reject")
    if only_when is not None:
        pairs = F.when(only_when, pairs)
    return (df.withColumn("__rule_pairs", pairs)
            .withColumn(out, last_wins_map("__rule_pairs"))
            .drop("__rule_pairs"))


def rule_score(rule_map_col, answer) -> Column:
    """Score of one answer under a rule map: 0 for a null or empty answer,
    for an answer with no matching key, and for a question with no rules."""
    a = _c(answer)
    hit = F.try_element_at(_c(rule_map_col), normalize_answer(a))
    zero = F.lit(0.0).cast("float")
    return F.when(a.isNull() | (a == ""), zero).otherwise(F.coalesce(hit, zero))


def rule_maps(question: DataFrame, id_col: str = "id", type_col: str = "type",
              rules_col: str = "rules") -> DataFrame:
    """(questionId, ruleMap) for every multi-choice question."""
    q = question.where(F.col(type_col) == MULTI_CHOICE_TYPE).select(
        F.col(id_col).alias("questionId"), rules_col)
    return with_rule_map(q, rules_col).select("questionId", "ruleMap")


def answer_key(question: DataFrame, id_col: str = "id", type_col: str = "type",
               rules_col: str = "rules") -> DataFrame:
    """Answer-key table (questionId, answerKey, ruleScore), one row per key."""
    return (rule_maps(question, id_col, type_col, rules_col)
            .select("questionId", F.explode("ruleMap").alias("answerKey", "ruleScore")))
