"""The multi-choice scorer as a function that SQL text can call.

``register_scorer`` makes a temporary SQL function over the answer-key view: Spark inlines its body, so a call is
a join on question and answer key in the plan, with no Python and no lookup row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorekeep.functions.rules import answer_key

SCORER = "score_of_multichoose"
# the text form of functions.answers.normalize_answer
_KEY = "CASE WHEN contains(given, ',') THEN array_join(sort_array(split(lower(given), ',')), '') ELSE given END"


def register_scorer(spark: SparkSession, question: DataFrame, name: str = SCORER) -> str:
    """Register ``name(questionId, answer)``: the rule score, or 0 for no answer, no match or no rules.

    The key type follows the question ids.  A later call with other questions replaces the function."""
    keys = answer_key(question)
    view, key_type = f"{name}_keys", dict(keys.dtypes)["questionId"]
    keys.createOrReplaceTempView(view)
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(asked {key_type}, given STRING) RETURNS FLOAT
RETURN CASE WHEN given IS NULL OR given = '' THEN CAST(0 AS FLOAT)
  ELSE coalesce((SELECT max(k.ruleScore) FROM {view} k WHERE k.questionId = asked AND k.answerKey = {_KEY}),
                CAST(0 AS FLOAT)) END""")
    return name
