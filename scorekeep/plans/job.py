"""E6: the staged scoring job.

Arguments follow the original command line: ``mode redo paperId paperExamId``
with mode ``0`` = objective scoring (built), ``1`` = subjective scoring
(the original has no implementation; accepted and does nothing), anything
else prints the usage.  ``redo`` = 1 replaces the exam's earlier rows in the
output, the JDBC tables and the catalog table; 0 appends.  Each run's stages
read that run's rows only, so an append run does not count earlier rows again.

Stages, each ending in a table written to the run's own folder under the
shared output folder, so a lost executor is recovered from written files
rather than by recomputing the lineage from the sources:

1. load: the exam's rows of each source table (all exams when no exam is
   given) -- the filters reach the scans;
2. scores and paper totals, written partitioned by exam;
3. with the misconduct rule given late: the detail fact (written,
   partitioned by exam) and the wide score sheet computed from the written
   detail (one aggregation keyed by student, no self-joins).

Only then is the run published (see ``plans.publish``): a manifest names the
files that come and go, and for redo the rows that are replaced -- those of
the selected paper and exam, and no row with another or a null key.  Optional
copies -- scores and sheet in JDBC tables, the detail in a typed catalog table
filled by position -- are staged beside them and published by the same
manifest; in a database one transaction deletes, inserts and records the run.
A run that dies before the manifest changes nothing; one that dies later is
finished by the next job on the same output.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekeep.functions.violation import DEFAULT_VIOLATION_RULE
from scorekeep.operators import detail as detail_ops
from scorekeep.operators import export, scoring, totals, wide
from scorekeep.operators.students import load_students
from scorekeep.plans import publish
from scorekeep.sinks.jdbc import create_like, publish_staged, write_jdbc
from scorekeep.sinks.tables import create_detail_table, insert_into
from scorekeep.sources.fixtures import ExamTables

USAGE = """usage: MODE REDO PAPER_ID PAPER_EXAM_ID
  MODE           0 = objective scoring, 1 = subjective scoring
  REDO           1 = replace this exam's earlier results, 0 = append
  PAPER_ID       exam id ("-" for all exams)
  PAPER_EXAM_ID  exam-subject id ("-" for all)"""

OUTPUTS = ("obj_score", "paper_score", "stu_que_detail", "stu_que_score")


@dataclass
class JdbcExport:
    """Optional JDBC targets of the job: objective scores and the wide sheet
    are appended there as well (credentials are passed, never logged)."""

    url: str
    obj_table: str = "obj_score"
    wide_table: str = "stu_que_score"
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    num_partitions: int | None = None


@dataclass
class ExamJob:
    spark: SparkSession
    tables: ExamTables
    output: str
    paper_id: str | None = None
    paper_exam_id: int | None = None
    redo: bool = False
    partition_col: str = "paperExamId"
    jdbc: JdbcExport | None = None
    detail_table: str | None = None     # typed catalog table, filled by position
    written: dict = field(default_factory=dict)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    _staged: list = field(default_factory=list)
    _jdbc_entries: list = field(default_factory=list)

    # ------------------------------------------------------------ stage 1
    def load(self) -> ExamTables:
        t = self.tables

        def exam(df, paper="paperId", exam_col="paperExamId"):
            if self.paper_id is not None:
                df = df.where(F.col(paper) == self.paper_id)
            if self.paper_exam_id is not None and exam_col:
                df = df.where(F.col(exam_col) == self.paper_exam_id)
            return df

        exams = exam(t.paper_subject, exam_col="id")
        return ExamTables(
            question=exam(t.question), answer=exam(t.answer), absent=exam(t.absent),
            paper_subject=exams, paper=t.paper if self.paper_id is None
            else t.paper.where(F.col("id") == self.paper_id),
            subject=t.subject, student=load_students(exam(t.student, exam_col=None),
                                                     t.batch, exams),
            batch=t.batch)

    # ------------------------------------------------------------ writing
    def _path(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"

    def _run_path(self, name: str = "") -> str:
        return f"{self.output.rstrip('/')}/_runs/{self.run_id}/{name}".rstrip("/")

    def _selection(self) -> dict:
        """Key columns and values of the rows that this run is about; empty for all."""
        keys = {} if self.paper_id is None else {"paperId": self.paper_id}
        return keys if self.paper_exam_id is None else keys | {"paperExamId": self.paper_exam_id}

    def _selected(self) -> Column:
        out = F.lit(True)
        for key, value in self._selection().items():
            out = out & (F.col(key) == F.lit(value))
        return out

    def _replaced(self, old: DataFrame, target: str, staged_kept) -> list[str]:
        """Files of target that go because this run replaces rows of theirs; their other rows are staged."""
        if not self.redo:
            return []
        if not self._selection():
            return publish.Folder(self.spark, target).files()
        files = publish.replaced_files(old, target, self._selected())
        if files:
            staged_kept(publish.kept_rows(self.spark, target, files, self._selected()))
        return files

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        """Write this run's rows apart.  Later stages read them from there, with the types they were computed with.
        One exam is one folder: the tasks that compute its rows write them, without a shuffle in between."""
        own = self._run_path(name)
        rows = df if self.partition_col in self._selection() else df.hint("rebalance", self.partition_col)
        rows.write.partitionBy(self.partition_col).mode("overwrite").parquet(own)
        self._staged.append(name)
        self.written[name] = self._path(name)
        return self.spark.read.schema(df.schema).parquet(own).select(df.columns)

    def _output_entry(self, name: str) -> dict:
        target, staged, remove = self._path(name), [self._run_path(name)], []
        if publish.Folder(self.spark, target).files():
            def keep(rows):
                rows.write.partitionBy(self.partition_col).mode("overwrite").parquet(self._run_path(f"kept-{name}"))
                staged.append(self._run_path(f"kept-{name}"))
            old = self.spark.read.parquet(target)
            remove = self._replaced(old, target, keep)
        return publish.stage(self.spark, target, staged, remove)

    def read(self, name: str) -> DataFrame:
        """All rows of the selected exams in the output, of whichever run."""
        return self.spark.read.parquet(self._path(name)).where(self._selected())

    def _access(self) -> dict:
        return {"driver": self.jdbc.driver, "user": self.jdbc.user, "password": self.jdbc.password}

    def _stage_jdbc(self, df: DataFrame, table: str) -> None:
        """Write the rows to a staging table of the database; the commit moves them inside it."""
        if self.jdbc is None:
            return
        staging = f"{table}_{self.run_id[:12]}"
        create_like(df, self.jdbc.url, table, **self._access())
        write_jdbc(df, self.jdbc.url, staging, mode="overwrite", num_partitions=self.jdbc.num_partitions, **self._access())
        self._jdbc_entries.append({"table": table, "staging": staging, "columns": df.columns,
                                   "replace": self._selection() if self.redo else None})

    def _catalog_entry(self, detail: DataFrame) -> dict:
        """The detail rows, inserted by position into a table of the target's columns that lies in the run's folder."""
        create_detail_table(self.spark, self.detail_table)
        location = self.spark.sql(f"DESCRIBE FORMATTED {self.detail_table}").where("col_name = 'Location'").first()["data_type"]
        where, name = self._run_path("catalog"), f"staged_{self.run_id}"
        create_detail_table(self.spark, name, where)
        try:
            insert_into(detail.select(*detail_ops.DETAIL_COLUMNS), name)
            old = self.spark.table(self.detail_table)
            remove = self._replaced(old, location, lambda rows: insert_into(rows.select(*old.columns), name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return publish.stage(self.spark, location, [where], remove) | {"table": self.detail_table}

    # ------------------------------------------------------------ publishing
    def _commit(self, detail: DataFrame) -> None:
        """Everything is staged: write the manifest, and carry it out."""
        entries = {"run": self.run_id, "files": [self._output_entry(n) for n in self._staged], "jdbc": self._jdbc_entries}
        if self.detail_table is not None:
            entries["files"].append(self._catalog_entry(detail))
        if self.jdbc is not None:
            entries["url"] = self.jdbc.url
        publish.commit(self.spark, self._run_path(), entries)
        self._publish(self._run_path(), entries)

    def _publish(self, folder: str, entries: dict) -> None:
        if entries["jdbc"] and (self.jdbc is None or self.jdbc.url != entries["url"]):
            raise RuntimeError(f"the run in {folder} has rows for the database {entries['url']}: give its access to finish it")
        for entry in entries["files"]:
            publish.publish_files(self.spark, entry)
            if "table" in entry and self.spark.catalog.tableExists(entry["table"]):
                self.spark.catalog.refreshTable(entry["table"])
        for entry in entries["jdbc"]:
            publish_staged(self.spark, self.jdbc.url, run_id=entries["run"], **entry, **self._access())
        publish.Folder(self.spark, folder).delete()

    def recover(self) -> list[str]:
        """Finish runs that were committed and then interrupted."""
        found = publish.committed_runs(self.spark, f"{self.output.rstrip('/')}/_runs")
        for folder, entries in found:
            self._publish(folder, entries)
        return [entries["run"] for _, entries in found]

    # ------------------------------------------------------------ stages 2, 3
    def start(self):
        """Stage 1 now; returns stage 2, which returns stage 3 (taking the
        misconduct rule).  Nothing is published before stage 3 has ended."""
        self.recover()
        src = self.load()

        def stage2():
            scores = self._write(scoring.score_answers(src.question, src.answer, src.absent),
                                 "obj_score")
            if self.jdbc is not None:
                self._stage_jdbc(export.obj_score_export(scores), self.jdbc.obj_table)
            paper_df, bound = totals.paper_totals_bounded(src.question, src.paper_subject,
                                                          src.subject)
            paper = self._write(paper_df, "paper_score")

            def stage3(violation_rule=DEFAULT_VIOLATION_RULE) -> int:
                d = self._write(detail_ops.question_detail(scores, paper, src.student,
                                                           totals_bound=bound),
                                "stu_que_detail")
                positions = wide.pivot_values(src.question)
                sheet = export.wide_score_export(wide.wide_scores(d, positions, violation_rule))
                sheet = self._write(sheet, "stu_que_score")
                if self.jdbc is not None:
                    self._stage_jdbc(sheet, self.jdbc.wide_table)
                self._commit(d)
                return 0

            return stage3

        return stage2


def run_exam_job(spark: SparkSession, tables: ExamTables, argv: list[str],
                 output: str, violation_rule=DEFAULT_VIOLATION_RULE) -> int:
    if len(argv) != 4:
        print(USAGE)
        return 0
    mode, redo, paper_id, paper_exam_id = argv
    if mode == "1":
        return 0
    if mode != "0":
        print(USAGE)
        return 0
    job = ExamJob(spark, tables, output,
                  paper_id=None if paper_id == "-" else paper_id,
                  paper_exam_id=None if paper_exam_id == "-" else int(paper_exam_id),
                  redo=redo == "1")
    return job.start()()(violation_rule)


def main(argv=None) -> int:  # pragma: no cover - command-line wrapper
    from scorekeep.session import build_session
    from scorekeep.sources.fixtures import load
    argv = list(sys.argv[1:] if argv is None else argv)
    if len(argv) < 6:
        print(USAGE + "\n  followed by: SF_DIR OUTPUT")
        return 0
    spark = build_session("exam-job")
    return run_exam_job(spark, load(spark, argv[4]), argv[:4], argv[5])


if __name__ == "__main__":  # pragma: no cover
    raise SystemExit(main())
