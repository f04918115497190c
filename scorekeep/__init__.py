"""Exam-scoring analytics expressed as Spark DataFrame plans.

Layout:
  sources/    exam tables (parquet fixtures, JDBC, catalog, text, parameterised SQL)
  functions/  Column-level functions (answer normaliser, rule keys, violation fix,
              null-safe sums, Java-compatible shard hash, audit columns)
  operators/  the scoring pipelines (scores, paper totals, detail fact, wide scores,
              export frames, sharded layout, question dimension, student load)
  plans/      plan-level helpers (bounded broadcast, fact spreading, hot-key split, staged job)
  sinks/      JDBC / table / file writers with the four save modes
  streaming/  incremental scoring of newly arriving answer files

Typical use::

    from scorekeep import build_session, load, score_answers, paper_totals_bounded, \\
        question_detail, wide_scores, pivot_values
    spark = build_session()
    t = load(spark, "/data/exam")
    scores = score_answers(t.question, t.answer, t.absent)
    totals, bound = paper_totals_bounded(t.question, t.paper_subject, t.subject)
    detail = question_detail(scores, totals, t.student, totals_bound=bound)
    sheet = wide_scores(detail, pivot_values(t.question))
"""

__version__ = "0.1.0"

from scorekeep.operators.detail import question_detail  # noqa: E402,F401
from scorekeep.operators.scoring import score_answers  # noqa: E402,F401
from scorekeep.operators.totals import paper_totals, paper_totals_bounded  # noqa: E402,F401
from scorekeep.operators.wide import pivot_values, wide_scores, wide_scores_strict  # noqa: E402,F401
from scorekeep.plans.job import ExamJob, run_exam_job  # noqa: E402,F401
from scorekeep.session import build_session  # noqa: E402,F401
from scorekeep.sources.fixtures import ExamTables, load  # noqa: E402,F401
