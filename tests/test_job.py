"""The staged job end to end, and its export frames."""

import os

from pyspark.sql import functions as F

from scorekeep import queries
from scorekeep.operators.export import obj_score_export, wide_score_export
from scorekeep.operators.detail import question_detail
from scorekeep.operators.scoring import score_answers
from scorekeep.operators.students import load_students
from scorekeep.operators.totals import paper_totals
from scorekeep.operators.wide import pivot_values, wide_scores
from scorekeep.plans.job import ExamJob, run_exam_job
from tests.conftest import SF_SMALL


def test_job_all_exams(spark, tables_small, workdir):
    out = workdir + "/job"
    assert run_exam_job(spark, tables_small, ["0", "0", "-", "-"], out) == 0
    sheet = spark.read.parquet(out + "/stu_que_score")
    t = tables_small
    students = load_students(t.student, t.batch, t.paper_subject)
    detail_expected = question_detail(
        score_answers(t.question, t.answer, t.absent),
        paper_totals(t.question, t.paper_subject, t.subject), students)
    expected = wide_scores(detail_expected, pivot_values(t.question))
    assert sheet.count() == expected.count()
    assert abs(sheet.agg(F.sum("total")).collect()[0][0]
               - expected.agg(F.sum("total")).collect()[0][0]) < 1e-6
    assert sheet.select("id").distinct().count() == sheet.count()
    detail = spark.read.parquet(out + "/stu_que_detail")
    assert detail.count() == detail_expected.count()
    # the query loads students by batch too
    assert detail.count() == queries.question_detail(spark, SF_SMALL).count()


def test_job_one_exam_redo(spark, tables_small, workdir):
    out = workdir + "/job1"
    job = ExamJob(spark, tables_small, out, paper_id="P0", paper_exam_id=102, redo=False)
    job.start()()((3, 1.0))
    first = spark.read.parquet(out + "/obj_score").count()
    assert first > 0
    assert spark.read.parquet(out + "/obj_score").where(F.col("paperExamId") != 102).count() == 0
    ExamJob(spark, tables_small, out, paper_id="P0", paper_exam_id=102, redo=False).start()()()
    assert spark.read.parquet(out + "/obj_score").count() == 2 * first
    ExamJob(spark, tables_small, out, paper_id="P0", paper_exam_id=102, redo=True).start()()()
    assert spark.read.parquet(out + "/obj_score").count() == first
    # another exam is added next to it, not over it
    ExamJob(spark, tables_small, out, paper_id="P1", paper_exam_id=103, redo=True).start()()()
    assert spark.read.parquet(out + "/obj_score").where(F.col("paperExamId") == 102).count() \
        == first


def test_job_modes(spark, tables_small, workdir, capsys):
    assert run_exam_job(spark, tables_small, ["1", "0", "P0", "101"], workdir + "/x") == 0
    assert run_exam_job(spark, tables_small, ["9"], workdir + "/y") == 0
    assert "usage" in capsys.readouterr().out


def test_export_frames(spark):
    scores = queries.score_answers(spark, SF_SMALL)
    e = obj_score_export(scores)
    assert len(e.columns) == 19
    assert "questionScore" in e.columns and "stuScore" not in e.columns
    row = e.select(F.length("id").alias("n"), "createDate", "lastModify").first()
    assert row["n"] == 36 and row["createDate"] == row["lastModify"]
    assert e.select("id").distinct().count() == e.count()
    w = wide_score_export(queries.wide_scores(spark, SF_SMALL))
    assert {"id", "createtime", "fixTotal", "sourceScore"} <= set(w.columns)


def test_job_with_jdbc_and_catalog_copies(spark, tables_small, workdir):
    import uuid

    from scorekeep.plans.job import JdbcExport
    from scorekeep.sources.jdbc import jdbc_query
    url = f"jdbc:derby:memory:job{uuid.uuid4().hex[:8]};create=true"
    drv = "org.apache.derby.jdbc.EmbeddedDriver"
    table = "detail_copy_" + uuid.uuid4().hex[:8]
    job = ExamJob(spark, tables_small, workdir + "/jobj", paper_id="P0", paper_exam_id=102,
                  jdbc=JdbcExport(url, driver=drv), detail_table=table)
    job.start()()()
    scores = spark.read.parquet(workdir + "/jobj/obj_score")
    sheet = spark.read.parquet(workdir + "/jobj/stu_que_score")
    assert jdbc_query(spark, url, "SELECT * FROM obj_score", driver=drv).count() == scores.count()
    copied = jdbc_query(spark, url, "SELECT * FROM stu_que_score", driver=drv)
    assert copied.count() == sheet.count()
    assert spark.table(table).count() == spark.read.parquet(workdir + "/jobj/stu_que_detail").count()


def test_job_command_line(spark, workdir, capsys):
    from scorekeep.plans.job import main
    out = workdir + "/cli"
    assert main(["0", "1", "P1", "103", SF_SMALL, out]) == 0
    assert spark.read.parquet(out + "/stu_que_score").count() > 0
    assert main(["0"]) == 0
    assert "usage" in capsys.readouterr().out


def test_export_column_order(spark):
    scores = queries.score_answers(spark, SF_SMALL)
    e = obj_score_export(scores)
    assert e.columns[12:] == ["id", "createDate", "lastModify", "sourceScore", "status",
                              "lastModifier", "creator"]
    w = wide_score_export(queries.wide_scores(spark, SF_SMALL))
    assert w.columns[-4:] == ["id", "sourceScore", "createtime", "fixTotal"]
    assert w.columns[-7:-4] == ["total", "subjectiveTotal", "objectiveTotal"]


def test_job_one_exam_matches_duckdb(spark, tables_small, workdir):
    """The staged job for one exam (P0 / 102) against SQL written from the
    same views: exam filters on every source, batch-aware students, the
    pivot list taken from that exam's questions."""
    from scorekeep import compare, oracle
    out = workdir + "/exam102"
    ExamJob(spark, tables_small, out, paper_id="P0", paper_exam_id=102).start()()()
    sheet = spark.read.parquet(out + "/stu_que_score").drop("id", "createtime")

    ctes = oracle.one_exam_with("P0", 102)
    positions = [f"c{r[0]}" for r in compare.duckdb_frame(
        ctes + "\nSELECT DISTINCT pos FROM question ORDER BY pos", SF_SMALL).itertuples(
        index=False)]
    assert positions == [c for c in sheet.columns if c.startswith("c") and c[1:].isdigit()]
    saved = oracle.POSITIONS
    try:
        oracle.POSITIONS = positions
        sql = ctes + "\n" + oracle._wide()
    finally:
        oracle.POSITIONS = saved
    right = compare.duckdb_frame(sql, SF_SMALL)
    left = sheet.toPandas()
    assert sorted(left.columns) == sorted(right.columns)
    assert len(left) == len(right) > 0
    assert compare.canonical_rows(left) == compare.canonical_rows(right)


def test_job_redo_replaces_every_copy(spark, tables_small, workdir):
    """After redo the parquet, JDBC and catalog copies hold one run's rows; other exams stay."""
    import uuid

    from scorekeep.plans.job import JdbcExport
    from scorekeep.sources.jdbc import jdbc_query
    url = f"jdbc:derby:memory:redo{uuid.uuid4().hex[:8]};create=true"
    drv = "org.apache.derby.jdbc.EmbeddedDriver"
    table = "detail_redo_" + uuid.uuid4().hex[:8]

    def run(paper, exam, redo):
        # a sheet's columns are its exam's positions, so another exam's goes to another database
        own = url if exam == 102 else url.replace("redo", "other")
        ExamJob(spark, tables_small, workdir + "/redo", paper_id=paper, paper_exam_id=exam, redo=redo,
                jdbc=JdbcExport(own, driver=drv), detail_table=table).start()()()
        sheet = spark.read.parquet(workdir + "/redo/stu_que_score")
        return [df.where(F.col("paperExamId") == exam).count() for df in (
            spark.read.parquet(workdir + "/redo/obj_score"), jdbc_query(spark, own, "SELECT * FROM obj_score", driver=drv),
            spark.read.parquet(workdir + "/redo/stu_que_detail"), spark.table(table),
            sheet, jdbc_query(spark, own, "SELECT * FROM stu_que_score", driver=drv))]

    first = run("P0", 102, False)
    assert first[0] > 0 and first[0::2] == first[1::2]
    other = run("P1", 103, True)
    assert run("P0", 102, False) == [2 * n for n in first]
    assert run("P0", 102, True) == first
    assert run("P1", 103, True) == other


def test_job_redo_without_rows_leaves_none(spark, tables_small, workdir):
    out = workdir + "/none"
    ExamJob(spark, tables_small, out, paper_id="P0", paper_exam_id=102).start()()()
    t = tables_small
    from scorekeep.sources.fixtures import ExamTables
    empty = ExamTables(question=t.question, answer=t.answer.where("false"), absent=t.absent, student=t.student,
                       paper_subject=t.paper_subject, paper=t.paper, subject=t.subject, batch=t.batch)
    ExamJob(spark, empty, out, paper_id="P0", paper_exam_id=102, redo=True).start()()()
    schema = spark.read.parquet(out + "/paper_score").schema
    assert schema and not [p for p in os.listdir(out + "/obj_score") if p.endswith("=102")]


def _counts(spark, out, where="true"):
    return [spark.read.option("mergeSchema", "true").parquet(f"{out}/{n}").where(where).count()
            for n in ("obj_score", "stu_que_detail", "stu_que_score")]


def test_job_that_dies_leaves_no_half_output(spark, tables_small, workdir):
    """Killed before the manifest: nothing changed, in no copy.  Killed after it: the next job ends it, once."""
    import uuid

    import pytest

    from scorekeep.plans import publish
    from scorekeep.plans.job import JdbcExport
    from scorekeep.sources.jdbc import jdbc_query
    out, drv = workdir + "/dies", "org.apache.derby.jdbc.EmbeddedDriver"
    url = f"jdbc:derby:memory:dies{uuid.uuid4().hex[:8]};create=true"
    table = "detail_dies_" + uuid.uuid4().hex[:8]

    def job(kind=ExamJob, redo=False):
        return kind(spark, tables_small, out, paper_id="P0", paper_exam_id=102, redo=redo,
                    jdbc=JdbcExport(url, driver=drv), detail_table=table)

    def copies():
        return [jdbc_query(spark, url, "SELECT * FROM obj_score", driver=drv).count(),
                jdbc_query(spark, url, "SELECT * FROM stu_que_score", driver=drv).count(), spark.table(table).count()]

    class Early(ExamJob):
        def _commit(self, detail):
            raise ConnectionError

    class Late(ExamJob):
        def _publish(self, folder, entries):
            if entries["run"] != self.run_id:
                return super()._publish(folder, entries)
            publish.publish_files(self.spark, entries["files"][0])
            files = entries["files"][1] | {"add": [a | {"files": a["files"][:1]} for a in entries["files"][1]["add"]]}
            publish.publish_files(self.spark, files)
            raise ConnectionError

    job().start()()()
    first, held = _counts(spark, out), copies()
    for redo in (False, True):
        with pytest.raises(ConnectionError):
            job(Early, redo).start()()()
        assert job().recover() == [] and _counts(spark, out) == first and copies() == held
    for redo, times in ((False, 2), (True, 1)):
        with pytest.raises(ConnectionError):
            job(Late, redo).start()()()
        assert len(job().recover()) == 1
        assert _counts(spark, out) == [times * n for n in first] and copies() == [times * n for n in held]
        assert job().recover() == []
    # a run with rows for a database is not ended without it
    with pytest.raises(ConnectionError):
        job(Late, True).start()()()
    with pytest.raises(RuntimeError, match="access"):
        ExamJob(spark, tables_small, out).recover()
    job().recover()
    assert _counts(spark, out) == first and copies() == held
    assert publish.drop_uncommitted(spark, out + "/_runs") and not publish.drop_uncommitted(spark, out + "/_runs")


def test_redo_replaces_by_the_selection_alone(spark, tables_small, workdir):
    """Rows of other exams stay, those without an exam's id too; with only a paper given, all its rows go,
    whether its exams are listed or not."""
    from scorekeep.sources.fixtures import ExamTables
    t = tables_small
    answer = t.answer.withColumn("paperExamId", F.when(F.col("paperExamId") != 103, F.col("paperExamId")))
    lost = ExamTables(question=t.question, answer=answer, absent=t.absent, student=t.student,
                      paper_subject=t.paper_subject.where("id <> 102"), paper=t.paper, subject=t.subject, batch=t.batch)
    out = workdir + "/selection"
    ExamJob(spark, lost, out).start()()()
    nulls = spark.read.parquet(out + "/obj_score").where("paperExamId IS NULL").count()
    listed = spark.read.parquet(out + "/obj_score").where("paperId = 'P0' AND paperExamId = 102").count()
    assert nulls > 0 and listed > 0
    before = _counts(spark, out)
    ExamJob(spark, lost, out, paper_id="P0", redo=True).start()()()
    assert _counts(spark, out)[0] == before[0]
    ExamJob(spark, t, out, paper_id="P0", paper_exam_id=102, redo=True).start()()()
    assert spark.read.parquet(out + "/obj_score").where("paperExamId IS NULL").count() == nulls
    assert _counts(spark, out)[0] == before[0]


def test_existence_is_asked_not_guessed(spark):
    import pytest

    from scorekeep.sinks.jdbc import Connection, create_like
    url, drv = "jdbc:derby:memory:exists_probe;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    create_like(df, url, "things", driver=drv)
    with Connection(spark, url, drv) as c:
        assert c.has_table("things") and not c.has_table("other") and set(c.column_types("things")) == {"id", "name"}
    with pytest.raises(Exception):
        create_like(df, "jdbc:derby:memory:not_there", "things", driver=drv)


def test_one_exam_is_written_without_a_shuffle(spark, workdir, tables_small, monkeypatch):
    """The tasks that compute one exam's rows write them; those of all exams are still rebalanced.  Same rows."""
    frames = type(tables_small.answer)
    hints, hint = [], frames.hint
    monkeypatch.setattr(frames, "hint", lambda df, name, *a: (hints.append(name), hint(df, name, *a))[1])
    whole = ExamJob(spark, tables_small, f"{workdir}/out")
    whole.start()()((3, 1.0))
    assert "rebalance" in hints
    before = sorted(map(str, whole.read("obj_score").collect()))
    hints.clear()
    one = ExamJob(spark, tables_small, f"{workdir}/out", paper_id="P0", paper_exam_id=102, redo=True)
    one.start()()((3, 1.0))
    assert "rebalance" not in hints and one.read("obj_score").count() > 0
    assert sorted(map(str, whole.read("obj_score").collect())) == before
