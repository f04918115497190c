"""E4: the objective-score export frame (12 score columns + audit columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.functions.audit import with_audit_columns

EXPORT_COLUMNS = ["paperId", "paperName", "paperExamId", "paperExamName", "stuId", "stuSeq",
                  "schoolId", "questionId", "questionOrder", "answer", "ABFlag", "stuScore"]
DEFAULT_WRITER = "objective-scoring"
AUDIT_CONSTANTS = ("sourceScore", "status", "lastModifier", "creator")


def obj_score_frame(scores: DataFrame, writer: str = DEFAULT_WRITER) -> DataFrame:
    """The deterministic part: selected columns, ``stuScore`` renamed to
    ``questionScore``, constant status/source/writer columns."""
    return (scores.select(*EXPORT_COLUMNS)
            .withColumnRenamed("stuScore", "questionScore")
            .withColumns({"sourceScore": F.lit(0), "status": F.lit(1),
                          "lastModifier": F.lit(writer), "creator": F.lit(writer)}))


def obj_score_export(scores: DataFrame, writer: str = DEFAULT_WRITER) -> DataFrame:
    """Full export rows: the 12 score columns, then ``id`` (UUID),
    ``createDate``, ``lastModify``, ``sourceScore``, ``status``,
    ``lastModifier``, ``creator``."""
    frame = obj_score_frame(scores, writer)
    audited = with_audit_columns(frame, "id", ("createDate", "lastModify"))
    head = [c for c in frame.columns if c not in AUDIT_CONSTANTS]
    return audited.select(*head, "id", "createDate", "lastModify", *AUDIT_CONSTANTS)


def wide_score_export(wide_scores: DataFrame) -> DataFrame:
    """Wide score sheet rows: keys, cells, totals, then ``id`` (UUID),
    ``sourceScore``, ``createtime``, ``fixTotal``."""
    audited = with_audit_columns(wide_scores, "id", ("createtime",))
    head = [c for c in wide_scores.columns if c not in ("sourceScore", "fixTotal")]
    return audited.select(*head, "id", "sourceScore", "createtime", "fixTotal")
