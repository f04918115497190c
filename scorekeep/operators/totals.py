"""E2: full marks per exam and subject, plus one row per composite exam.

The question table is aggregated before it meets the dimensions, to
(paperId, paperExamId, subjectId) sums; the tiny exam-subject and subject
tables are joined to those sums and the result is re-aggregated on the
output keys.  Sums are distributive, and joining before the final
aggregation keeps the join multiplicities, so this equals aggregating the
joined question rows directly, while only partial sums cross the shuffle.
``paper_totals`` produces both row kinds from a single grouping-sets
aggregation, so the question table is scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.fixed_values import COMPOSITE_FLAG, COMPOSITE_SHORT_NAME, SUBJECTIVE_TYPE
from scorekeep.plans.broadcast import (bounded_broadcast, bounded_broadcasts, counted_broadcasts,
                                       fixed_row_bytes)

TOTAL_COLUMNS = [
    "paperId", "paperName", "paperExamId", "paperExamName", "subjectId", "subjectName",
    "subjectShortName", "objTotal", "subTotal", "paperTotal", "isAB", "isComprehensiveSubject",
]


def _exam_subject_sums(question: DataFrame) -> DataFrame:
    q_type, score = F.col("type"), F.col("score")
    return (question.where(F.col("questionOrder") > 0)
            .groupBy("paperId", "paperExamId", "subjectId")
            .agg(F.sum(F.when(q_type != SUBJECTIVE_TYPE, score).otherwise(0)).alias("obj"),
                 F.sum(F.when(q_type == SUBJECTIVE_TYPE, score).otherwise(0)).alias("sub"),
                 F.sum(score).alias("all")))


def _exams(paper_subject: DataFrame) -> DataFrame:
    return paper_subject.select(
        F.col("paperId").alias("ps_paperId"), F.col("id").alias("ps_id"),
        F.col("paperName").alias("ps_paperName"),
        F.col("paperExamName").alias("ps_paperExamName"),
        F.col("isAB").alias("ps_isAB"), F.col("isComprehensive").alias("ps_isComprehensive"))


def _subjects(subject: DataFrame) -> DataFrame:
    return subject.select(F.col("id").alias("s_id"), F.col("subjectName").alias("s_name"),
                          F.col("shortName").alias("s_short"))


def _rounded_totals():
    return [F.round(F.sum("obj"), 2).alias("objTotal"),
            F.round(F.sum("sub"), 2).alias("subTotal"),
            F.round(F.sum("all"), 2).alias("paperTotal")]


def _join_exams(sums: DataFrame, exams: DataFrame) -> DataFrame:
    return sums.join(exams, (sums["paperId"] == exams["ps_paperId"])
                     & (sums["paperExamId"] == exams["ps_id"]), "inner")


def subject_totals(question: DataFrame, paper_subject: DataFrame, subject: DataFrame,
                   sums: DataFrame | None = None) -> DataFrame:
    sums = _exam_subject_sums(question) if sums is None else sums
    exams, subjects = bounded_broadcasts(_exams(paper_subject), _subjects(subject))
    joined = (_join_exams(sums, exams)
              .join(subjects, F.col("subjectId") == F.col("s_id"), "inner"))
    grouped = joined.groupBy("ps_paperId", "ps_paperName", "ps_id", "ps_paperExamName",
                             "ps_isAB", "ps_isComprehensive", "s_id", "s_name", "s_short")
    return grouped.agg(*_rounded_totals()).select(
        F.col("ps_paperId").alias("paperId"), F.col("ps_paperName").alias("paperName"),
        F.col("ps_id").alias("paperExamId"), F.col("ps_paperExamName").alias("paperExamName"),
        F.col("s_id").cast("bigint").alias("subjectId"), F.col("s_name").alias("subjectName"),
        F.col("s_short").alias("subjectShortName"),
        "objTotal", "subTotal", "paperTotal",
        F.coalesce(F.col("ps_isAB"), F.lit(0)).alias("isAB"),
        F.col("ps_isComprehensive").alias("isComprehensiveSubject"))


def composite_totals(question: DataFrame, paper_subject: DataFrame,
                     sums: DataFrame | None = None) -> DataFrame:
    """One row per composite exam (isComprehensive = 1): its own full marks,
    keyed by the exam id in the subject column, short name ``ZH``."""
    sums = _exam_subject_sums(question) if sums is None else sums
    exams = bounded_broadcast(
        _exams(paper_subject).where(F.col("ps_isComprehensive") == COMPOSITE_FLAG))
    grouped = _join_exams(sums, exams).groupBy(
        "ps_paperId", "ps_paperName", "ps_id", "ps_paperExamName", "ps_isAB",
        "ps_isComprehensive")
    return grouped.agg(*_rounded_totals()).select(
        F.col("ps_paperId").alias("paperId"), F.col("ps_paperName").alias("paperName"),
        F.col("ps_id").alias("paperExamId"), F.col("ps_paperExamName").alias("paperExamName"),
        F.col("ps_id").cast("bigint").alias("subjectId"),
        F.col("ps_paperExamName").alias("subjectName"),
        F.lit(COMPOSITE_SHORT_NAME).alias("subjectShortName"),
        "objTotal", "subTotal", "paperTotal",
        F.coalesce(F.col("ps_isAB"), F.lit(0)).alias("isAB"),
        F.lit(0).alias("isComprehensiveSubject"))


def paper_totals(question: DataFrame, paper_subject: DataFrame, subject: DataFrame) -> DataFrame:
    return paper_totals_bounded(question, paper_subject, subject)[0]


def paper_totals_bounded(question: DataFrame, paper_subject: DataFrame, subject: DataFrame):
    """``(totals, (rows, bytes))``: the totals and a proven bound on their size.

    A total row is one exam-subject row with at most one subject row, or the
    exam's own row, so there are at most exams x (subjects + 1) rows; their
    text comes from those rows (the exam's text at most twice in its own
    row), which bounds the text bytes by the probed sizes of both tables.

    Both kinds of total rows from one aggregation of the question table.

    Grouping sets compute the (exam, subject) and (exam) sums in one pass
    (one scan, one shuffle of partial sums).  Every sum row joins the tiny
    exam-subject table; subject-grain rows also join the subject table.
    Subject-grain rows with a known subject and exam-grain rows of
    composite exams are kept, then grouped by their output keys -- after
    the joins, so duplicate dimension rows count as they would in SQL.
    """
    q_type, score = F.col("type"), F.col("score")
    sums = (question.where(F.col("questionOrder") > 0)
            .groupingSets([["paperId", "paperExamId", "subjectId"], ["paperId", "paperExamId"]],
                          "paperId", "paperExamId", "subjectId")
            .agg(F.sum(F.when(q_type != SUBJECTIVE_TYPE, score).otherwise(0)).alias("obj"),
                 F.sum(F.when(q_type == SUBJECTIVE_TYPE, score).otherwise(0)).alias("sub"),
                 F.sum(score).alias("all"),
                 F.grouping_id().alias("gid")))
    (exams, subjects), ((n_exams, exam_bytes), (n_subjects, subject_bytes)) = \
        counted_broadcasts(_exams(paper_subject), _subjects(subject))
    per_subject = F.col("gid") == 0
    joined = (_join_exams(sums, exams)
              .join(subjects, per_subject & (F.col("subjectId") == F.col("s_id")), "left"))
    keep = ((per_subject & F.col("s_id").isNotNull())
            | (~per_subject & (F.col("ps_isComprehensive") == COMPOSITE_FLAG)))
    grouped = joined.where(keep).groupBy(
        "gid", "ps_paperId", "ps_paperName", "ps_id", "ps_paperExamName", "ps_isAB",
        "ps_isComprehensive", "s_id", "s_name", "s_short")
    totals = grouped.agg(*_rounded_totals()).select(
        F.col("ps_paperId").alias("paperId"), F.col("ps_paperName").alias("paperName"),
        F.col("ps_id").alias("paperExamId"), F.col("ps_paperExamName").alias("paperExamName"),
        F.when(per_subject, F.col("s_id").cast("bigint")).otherwise(F.col("ps_id"))
        .alias("subjectId"),
        F.when(per_subject, F.col("s_name")).otherwise(F.col("ps_paperExamName"))
        .alias("subjectName"),
        F.when(per_subject, F.col("s_short")).otherwise(F.lit(COMPOSITE_SHORT_NAME))
        .alias("subjectShortName"),
        "objTotal", "subTotal", "paperTotal",
        F.coalesce(F.col("ps_isAB"), F.lit(0)).alias("isAB"),
        F.when(per_subject, F.col("ps_isComprehensive")).otherwise(F.lit(0))
        .alias("isComprehensiveSubject"))
    rows = n_exams * (n_subjects + 1)
    size = (rows * fixed_row_bytes(totals) + (n_subjects + 2) * exam_bytes
            + n_exams * subject_bytes + 2 * n_exams)
    return totals, (rows, size)
