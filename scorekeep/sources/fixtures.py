"""Exam tables derived from the driver's TPC-H-style parquet tables.

The exam job works on seven logical tables (question, answer, absence,
exam-subject, subject, student, import batch) plus the exam header.  The
test data ships TPC-H tables instead, so each logical table is a projection
of one of them.  Every column is written once, as a SQL expression that
Spark and DuckDB both parse, so the Spark side and the DuckDB oracle read
exactly the same rows.

On Spark the views are plain ``select``/``filter`` over a parquet scan:
Catalyst prunes columns and pushes the filters into the scan, and the
views add no shuffle of their own (``paper_subject``, ``paper`` and
``batch`` are DISTINCTs over small key sets, partially aggregated per task).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekeep.session import files_state


# The three answer-rule sets given to multi-choice questions in the fixture.
# Rule text format: a JSON array of {"type": "group", "values": [{"name", "score"}]}
# entries; "score" may be a number or numeric text; entries of another type,
# or without a type, are ignored; a repeated name keeps the last score.
RULE_SET_0 = (
    '[{"type":"group","values":[{"name":"A","score":1},{"name":"A,R","score":"3"},'
    '{"name":"N,R","score":2},{"name":"R","score":1.5}]},{}]'
)
RULE_SET_1 = (
    '[{"type":"GROUP","values":[{"name":"R,A","score":2},{"name":"N","score":1},'
    '{"name":"A,R","score":2.5}]}]'
)
RULE_SET_2 = (
    '[{"type":"other","values":[{"name":"A","score":9}]},'
    '{"type":"group","values":[{"name":"A","score":"0.5"},{"name":"r, n","score":3},'
    '{"name":"R,N","score":4}]}]'
)


def _txt(expr: str, width: int = 20) -> str:
    """Integer expression as text, written so that both engines accept it."""
    return f"CAST({expr} AS VARCHAR({width}))"


# (column name, SQL expression) per view, in output order.
QUESTION_COLUMNS = [
    ("id", "p_partkey"),
    ("paperId", f"concat('P', {_txt('p_partkey % 2', 4)})"),
    ("paperName", f"concat('Paper-', {_txt('p_partkey % 2', 4)})"),
    ("paperExamId", "100 + p_partkey % 10"),
    ("paperExamName", f"concat('Exam-', {_txt('p_partkey % 10', 4)})"),
    ("subjectId", "p_partkey % 25"),
    ("type", "1 + p_size % 4"),
    ("pos", "1 + p_partkey % 20"),
    ("questionOrder", "p_partkey % 50"),
    ("score", "(1 + p_size % 5) / 2"),
    ("standardAnswer",
     "CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END"),
    ("No", "p_brand"),
    ("difficulty", "p_type"),
    ("rules",
     f"CASE p_size % 3 WHEN 0 THEN '{RULE_SET_0}' WHEN 1 THEN '{RULE_SET_1}' "
     f"ELSE '{RULE_SET_2}' END"),
    ("status", "CASE WHEN p_size % 11 = 0 THEN 0 ELSE 1 END"),
]

ANSWER_COLUMNS = [
    ("questionId", "l_partkey"),
    ("stuId", "l_orderkey"),
    ("paperId", f"concat('P', {_txt('l_partkey % 2', 4)})"),
    ("paperName", f"concat('Paper-', {_txt('l_partkey % 2', 4)})"),
    ("paperExamId", "100 + l_partkey % 10"),
    ("paperExamName", f"concat('Exam-', {_txt('l_partkey % 10', 4)})"),
    ("stuSeq", f"concat('S', {_txt('l_orderkey')})"),
    ("schoolId", "l_suppkey"),
    ("questionOrder", "l_linenumber"),
    ("answer",
     "CASE WHEN l_quantity = 25 THEN NULL WHEN l_quantity = 26 THEN '' "
     "WHEN l_linestatus = 'F' AND l_returnflag <> 'R' THEN concat('R,', l_returnflag) "
     "ELSE l_returnflag END"),
    ("fixAnswer", "'A'"),
    ("isDubious", "CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END"),
    ("dubiousType", "CASE WHEN l_tax >= 0.05 THEN 1 ELSE 0 END"),
    ("ABFlag", "CAST(l_linenumber % 2 AS INTEGER)"),
    ("isChoose", "CASE WHEN l_quantity <= 2 THEN 0 ELSE 1 END"),
    ("status", "CASE WHEN l_quantity >= 49 THEN 0 ELSE 1 END"),
]

# One absence per student and exam; every 16th student misses some exams, often
# several of them, that the student also has answers for.
ABSENT_COLUMNS = [
    ("userId", "l_orderkey"),
    ("paperId", f"concat('P', {_txt('l_partkey % 2', 4)})"),
    ("paperExamId", "100 + l_partkey % 10"),
    ("dubiousType", "CAST(1 + (l_orderkey + l_partkey % 10) % 5 AS INTEGER)"),
    ("status", "CASE WHEN (l_orderkey + l_partkey % 10) % 7 = 0 THEN 0 ELSE 1 END"),
    ("sourceFrom", "1"),
]
ABSENT_FILTER = "l_orderkey % 16 < 3"

PAPER_SUBJECT_COLUMNS = [
    ("id", "100 + p_partkey % 10"),
    ("paperId", f"concat('P', {_txt('p_partkey % 2', 4)})"),
    ("paperName", f"concat('Paper-', {_txt('p_partkey % 2', 4)})"),
    ("paperExamName", f"concat('Exam-', {_txt('p_partkey % 10', 4)})"),
    ("isAB", "CASE WHEN p_partkey % 10 IN (3, 4) THEN NULL "
             "ELSE CAST(p_partkey % 2 AS INTEGER) END"),
    ("isComprehensive", "CASE WHEN p_partkey % 10 < 4 THEN 1 ELSE 0 END"),
    ("status", "CASE WHEN p_partkey % 10 = 8 THEN 0 ELSE 1 END"),
]

PAPER_COLUMNS = [
    ("id", f"concat('P', {_txt('p_partkey % 2', 4)})"),
    ("paperName", f"concat('Paper-', {_txt('p_partkey % 2', 4)})"),
    ("gradeId", "CAST(7 + p_partkey % 2 AS INTEGER)"),
    ("year", "2017"),
    ("status", "1"),
]

SUBJECT_COLUMNS = [
    ("id", "n_nationkey"),
    ("subjectName", "n_name"),
    ("shortName", "substr(n_name, 1, 2)"),
]

STUDENT_COLUMNS = [
    ("userId", "o_orderkey"),
    ("stuName", f"concat('Student-', {_txt('o_orderkey')})"),
    ("cityId", "o_custkey % 7"),
    ("cityName", f"concat('City-', {_txt('o_custkey % 7', 4)})"),
    ("areaId", "o_custkey % 13"),
    ("areaName", f"concat('Area-', {_txt('o_custkey % 13', 4)})"),
    ("schoolId", "o_custkey"),
    ("schoolName", f"concat('School-', {_txt('o_custkey')})"),
    ("gradeId", "o_orderkey % 3"),
    ("gradeName", f"concat('Grade-', {_txt('o_orderkey % 3', 4)})"),
    ("classId", "o_orderpriority"),
    ("className", "concat('Class ', o_orderpriority)"),
    ("isRestudy", "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 0 END"),
    ("classType", "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 1 END"),
    ("batchId", "o_custkey % 3"),
    ("paperId", f"concat('P', {_txt('o_orderkey % 2', 4)})"),
    ("paperExamId", "100 + o_orderkey % 10"),
]

BATCH_COLUMNS = [
    ("id", "r_regionkey % 3"),
    ("paperId", "CASE WHEN r_regionkey = 4 THEN 'P1' ELSE 'P0' END"),
]


@dataclass(frozen=True)
class ViewSpec:
    source: str
    columns: list
    where: str | None = None
    distinct: bool = False

    def sql(self) -> str:
        cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in self.columns)
        text = f"SELECT {'DISTINCT ' if self.distinct else ''}\n  {cols}\nFROM {self.source}"
        if self.where:
            text += f"\nWHERE {self.where}"
        return text


VIEWS: dict[str, ViewSpec] = {
    "question": ViewSpec("part", QUESTION_COLUMNS),
    "answer": ViewSpec("lineitem", ANSWER_COLUMNS),
    "absent": ViewSpec("lineitem", ABSENT_COLUMNS, where=ABSENT_FILTER, distinct=True),
    "paper_subject": ViewSpec("part", PAPER_SUBJECT_COLUMNS, distinct=True),
    "paper": ViewSpec("part", PAPER_COLUMNS, distinct=True),
    "subject": ViewSpec("nation", SUBJECT_COLUMNS),
    "student": ViewSpec("orders", STUDENT_COLUMNS),
    "batch": ViewSpec("region", BATCH_COLUMNS, distinct=True),
}

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


_schemas: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one source table; the schema of unchanged files is read once a session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key in _schemas:
        schema, state = _schemas[key]
        df = spark.read.schema(schema).parquet(path)
        if files_state(df) == state:
            return df
    df = spark.read.parquet(path)
    state = files_state(df)
    if state is not None:
        _schemas[key] = df.schema, state
    return df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One exam view as a lazy DataFrame over the parquet table it comes from."""
    return view_of(read_table(spark, sf_dir, VIEWS[name].source), name)


def view_of(df: DataFrame, name: str) -> DataFrame:
    """Apply a view's projection to a frame of its source table (batch or stream)."""
    spec = VIEWS[name]
    if spec.where:
        df = df.where(F.expr(spec.where))
    df = df.selectExpr(*[f"{expr} AS {col}" for col, expr in spec.columns])
    return df.distinct() if spec.distinct else df


class ExamTables:
    """The logical tables of one exam data set (question, answer, absent,
    paper_subject, paper, subject, student, batch) as DataFrames.

    Given frames are used as they are; the others are built on first use
    from ``sf_dir``, so a query only lists and plans the tables it reads."""

    NAMES = tuple(VIEWS)

    def __init__(self, spark: SparkSession | None = None, sf_dir: str | None = None,
                 **frames: DataFrame):
        unknown = set(frames) - set(self.NAMES)
        if unknown:
            raise TypeError(f"unknown exam tables: {sorted(unknown)}")
        self._spark, self._sf_dir, self._frames = spark, sf_dir, dict(frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.NAMES:
            raise AttributeError(name)
        if name not in self._frames:
            if self._spark is None:
                raise AttributeError(f"table {name} was not given")
            self._frames[name] = view(self._spark, self._sf_dir, name)
        return self._frames[name]

    def __repr__(self) -> str:
        return f"ExamTables({self._sf_dir or ', '.join(self._frames)})"


def load(spark: SparkSession, sf_dir: str) -> ExamTables:
    return ExamTables(spark, sf_dir)


def duckdb_with(*names: str) -> str:
    """``WITH`` clause defining the named views for a DuckDB oracle query."""
    return "WITH " + ",\n".join(f"{n} AS (\n{VIEWS[n].sql()}\n)" for n in names)
