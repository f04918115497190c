"""Question-dimension operators: the objective filter and the denormalised,
prefix-qualified question dimension (exam header x exam subject x question)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekeep.fixed_values import LIVE_STATUS, SUBJECTIVE_TYPE
from scorekeep.plans.broadcast import bounded_broadcasts


def objective_filter(type_col: str = "type") -> Column:
    """Questions other than subjective ones.  The type is read as an integer
    (an ANSI cast, so malformed text fails the job as integer parsing would)."""
    return F.col(type_col).cast("int") != SUBJECTIVE_TYPE


def prefixed(df: DataFrame, prefix: str, columns=None) -> list[Column]:
    """``prefix + name`` aliases for the given (default: all) columns."""
    return [df[c].alias(prefix + c) for c in (columns or df.columns)]


def question_dimension(paper: DataFrame, paper_subject: DataFrame,
                       question: DataFrame) -> DataFrame:
    """Live questions of live exam subjects of live exams, one wide row each,
    every column qualified by its table (``question_``, ``paperSubject_``,
    ``paper_``).  The two header tables are small and broadcast after a
    size check; the question table streams through."""
    p, ps = bounded_broadcasts(paper.where(F.col("status") == LIVE_STATUS),
                               paper_subject.where(F.col("status") == LIVE_STATUS))
    q = question.where(F.col("status") == LIVE_STATUS)
    joined = (q.join(ps, q["paperExamId"] == ps["id"], "inner")
              .join(p, ps["paperId"] == p["id"], "inner"))
    return joined.select(*prefixed(q, "question_"), *prefixed(ps, "paperSubject_"),
                         *prefixed(p, "paper_"))
