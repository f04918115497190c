"""E1: score every live, chosen answer to an objective question.

Plan shape: the answer fact is scanned once with its filters pushed into the
scan; the objective-question dimension (with its rule map as a column) is
joined by broadcast when its size is proven small, else by a shuffle of the
answers that may be to such a question; the absence table is left-joined on
student, paper and exam, by broadcast when small, else by a shuffle on that
key of the answers that may have an absence.  Scoring is a CASE plus one map
lookup, all inside generated code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.fixed_values import (LIVE_STATUS, MULTI_CHOICE_TYPE, POSITION_PREFIX,
                                    SUBJECTIVE_TYPE)
from scorekeep.functions.answers import display_answer
from scorekeep.functions.rules import rule_maps, rule_score, with_rule_map
from scorekeep.plans.broadcast import bounded_broadcast, counted_broadcasts, within_bounds
from scorekeep.plans.keyfilter import rows_that_may_match, split_by_keys

SCORE_COLUMNS = [
    "paperId", "paperName", "paperExamId", "paperExamName", "stuId", "stuSeq", "schoolId",
    "subjectId", "questionId", "questionOrder", "questionNo", "questionType", "questionScore",
    "difficulty", "answer", "ABFlag", "isDubious", "dubiousType", "stuScore", "sourceScore",
    "isChoose", "standardAnswer", "pos",
]


def objective_question_dim(question: DataFrame) -> DataFrame:
    """Objective questions (type < 4) with the columns scoring needs and
    the rule map of multi-choice questions."""
    dim = (question.where(F.col("type") < SUBJECTIVE_TYPE)
           .select(F.col("id").alias("q_id"),
                   "subjectId",
                   F.col("No").alias("questionNo"),
                   F.col("type").alias("questionType"),
                   F.col("score").alias("questionScore"),
                   "difficulty",
                   "standardAnswer",
                   F.concat(F.lit(POSITION_PREFIX), F.col("pos")).alias("pos"),
                   "rules"))
    return with_rule_map(dim, only_when=F.col("questionType") == MULTI_CHOICE_TYPE).drop("rules")


def live_absences(absent: DataFrame) -> DataFrame:
    """Absence rows that are live; the right side of the ON-predicate outer join."""
    return (absent.where(F.col("status") == LIVE_STATUS)
            .select(F.col("userId").alias("ab_userId"),
                    F.col("paperId").alias("ab_paperId"),
                    F.col("paperExamId").alias("ab_paperExamId"),
                    F.col("dubiousType").alias("ab_dubiousType"),
                    F.col("sourceFrom").alias("ab_sourceFrom")))


def same_sitting() -> F.Column:
    """An absence belongs to an answer of the same student, paper and exam: all
    exams are scored in one plan, and a student may miss some and sit others."""
    return ((F.col("stuId") == F.col("ab_userId")) & (F.col("paperId") == F.col("ab_paperId"))
            & (F.col("paperExamId") == F.col("ab_paperExamId")))


def with_absences(rows: DataFrame, absences: DataFrame, size: tuple[int, int], max_rows: int | None = None,
                  then=lambda part: part) -> DataFrame:
    """``then(rows)`` with the absence of each row's sitting, or nulls.  Absences over the broadcast bound are joined
    by a shuffle of those rows only that may have one, before ``then`` widens them.  ``then`` works row by row and
    keeps the sitting's columns and those of an absence that is there."""
    parts = None
    if not within_bounds(rows.sparkSession, size, max_rows):
        sitting = ["ab_userId", "ab_paperId", "ab_paperExamId"]
        # a null matches nothing; left out here, bitmaps and join read the same rows and their DISTINCT runs once
        for c in sitting:
            absences = absences.where(F.col(c).isNotNull())
        parts = split_by_keys(rows, ["stuId", "paperId", "paperExamId"], absences, sitting, size[0])
    if parts is None:
        return then(rows).join(absences, same_sitting(), "left")
    some, none = parts
    absent_nowhere = [F.lit(None).cast(f.dataType).alias(f.name) for f in absences.schema.fields]
    return then(some.join(absences, same_sitting(), "left")).unionByName(then(none.select("*", *absent_nowhere)))


def score_expr() -> F.Column:
    """Score of one answer: full marks for a matching single answer
    (types 1 and 3), the rule score for a multi-choice answer (type 2,
    float precision), else 0.  The raw answer is scored, not the corrected one."""
    q_type = F.col("questionType")
    matched = (q_type != SUBJECTIVE_TYPE) & (q_type != MULTI_CHOICE_TYPE) & (
        F.col("raw_answer") == F.col("standardAnswer"))
    return (F.when(matched, F.col("questionScore"))
            .when(q_type == MULTI_CHOICE_TYPE,
                  rule_score("ruleMap", "raw_answer").cast("double"))
            .otherwise(F.lit(0.0)))


def score_answers(question: DataFrame, answer: DataFrame, absent: DataFrame,
                  max_broadcast_rows: int | None = None) -> DataFrame:
    # the dimension's size is bounded by the source columns it is built from
    # (its rule map is smaller than the rule text it is parsed from)
    source = question.where(F.col("type") < SUBJECTIVE_TYPE).select(
        "id", "subjectId", "No", "type", "score", "difficulty", "standardAnswer", "pos", "rules")
    (qdim, absences), (question_size, absences_size) = counted_broadcasts(
        (objective_question_dim(question), source), live_absences(absent),
        max_rows=max_broadcast_rows)
    facts = (answer.where((F.col("isChoose") > 0) & (F.col("status") == LIVE_STATUS))
             .select("paperId", "paperName", "paperExamId", "paperExamName", "stuId",
                     "stuSeq", "schoolId", "questionId", "questionOrder",
                     F.col("answer").alias("raw_answer"),
                     display_answer("answer", "fixAnswer", "isDubious", "dubiousType")
                     .alias("answer"), "ABFlag", "isChoose"))
    if not within_bounds(facts.sparkSession, question_size, max_broadcast_rows):
        # answers to no objective question stay out of both shuffles
        facts = rows_that_may_match(facts, ["questionId"], source, ["id"], question_size[0])

    # neither rule map nor raw answer goes through the shuffle of a whole absences' join: scored before it
    def scored(part):
        return (part.join(qdim, part["questionId"] == qdim["q_id"], "inner")
                .select("paperId", "paperName", "paperExamId", "paperExamName", "stuId", "stuSeq",
                        "schoolId", "subjectId", "questionId", "questionOrder", "questionNo",
                        "questionType", "questionScore", "difficulty", "answer", "ABFlag",
                        score_expr().alias("stuScore"), "isChoose", "standardAnswer", "pos",
                        *[c for c in part.columns if c.startswith("ab_")]))

    return with_absences(facts, absences, absences_size, max_broadcast_rows, scored).select(
        "paperId", "paperName", "paperExamId", "paperExamName", "stuId", "stuSeq",
        "schoolId", "subjectId", "questionId", "questionOrder", "questionNo",
        "questionType", "questionScore", "difficulty", "answer", "ABFlag",
        F.when(F.col("ab_dubiousType").isNull(), 0).otherwise(1).alias("isDubious"),
        F.col("ab_dubiousType").alias("dubiousType"),
        "stuScore",
        F.col("ab_sourceFrom").alias("sourceScore"),
        "isChoose", "standardAnswer", "pos")


def score_multichoice(question: DataFrame, answer: DataFrame) -> DataFrame:
    """Rule score of every answer to a multi-choice question (the registered
    SQL function of the original job, as a column expression over a join)."""
    rules = rule_maps(question).withColumnRenamed("questionId", "q_id")
    rules = bounded_broadcast(rules, bound_by=question.where(F.col("type") == MULTI_CHOICE_TYPE))
    return (answer.join(rules, answer["questionId"] == rules["q_id"], "inner")
            .select("questionId", "stuId", "questionOrder", "answer",
                    rule_score("ruleMap", "answer").alias("ruleScore")))


def left_join_on_predicate(answer: DataFrame, absent: DataFrame) -> DataFrame:
    """Every answer row, with the live absence of its student when there is
    one (an outer join whose right-side predicate sits in ON, so a non-live
    absence yields nulls rather than dropping the row)."""
    (absences,), (size,) = counted_broadcasts(live_absences(absent))
    facts = answer.select("questionId", "stuId", "paperId", "paperExamId", "questionOrder", "answer", "dubiousType")
    return (with_absences(facts, absences, size)
            .select("questionId", "stuId", "questionOrder", "answer",
                    F.col("dubiousType").alias("answerDubiousType"),
                    F.col("ab_dubiousType").alias("dubiousType"),
                    F.when(F.col("ab_dubiousType").isNull(), 0).otherwise(1).alias("isDubious"),
                    F.col("ab_sourceFrom").alias("sourceScore")))
