"""Parameterised SQL over DataFrames.

Values are bound as typed parameters (``?`` markers with a list, or
``:name`` markers with a dict), never pasted into the text, so there is
no quoting problem; too few or too many values are refused.  DataFrames
are referenced in the text as ``{name}``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def param_query(spark: SparkSession, sql_text: str, args=None, **frames: DataFrame) -> DataFrame:
    # markers outside string literals, quoted names and comments
    bare = re.sub(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", " ", sql_text, flags=re.S)
    if isinstance(args, dict):
        named = set(re.findall(r"(?<!:):([A-Za-z_]\w*)", bare))
        if named != set(args):
            raise ValueError(f"the text has the markers {sorted(named)}, values are given for {sorted(args)}")
    elif bare.count("?") != len(args or ()):
        raise ValueError(f"the text has {bare.count('?')} markers, {len(args or ())} values are given")
    return spark.sql(sql_text, args=args, **frames)


# The scored-answer filter of the scoring job as a parameterised text.
SCORED_ANSWERS_SQL = """
SELECT a.stuId, a.questionId, a.questionOrder, a.answer, q.type AS questionType,
       q.score AS questionScore
FROM {answer} a JOIN {question} q ON q.id = a.questionId
WHERE a.isChoose > ? AND q.type < ? AND a.status = ?
"""
SCORED_ANSWERS_ARGS = [0, 4, 1]
