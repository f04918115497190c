"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the exam views of that data set.  Building one may run small jobs (size
checks, the pivot list) or, for the sharded layouts, write a copy of a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scorekeep.operators import detail as detail_ops
from scorekeep.operators import scoring, totals, wide
from scorekeep.plans.broadcast import size_probe
from scorekeep.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark, sf_dir) -> fixtures.ExamTables:
    return fixtures.load(spark, sf_dir)


def score_answers(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return scoring.score_answers(t.question, t.answer, t.absent)


def paper_totals(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return totals.paper_totals(t.question, t.paper_subject, t.subject)


def composite_totals(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return totals.composite_totals(t.question, t.paper_subject)


def question_detail(spark, sf_dir):
    """E1, E2 and the student-size probe are planned side by side (their
    size checks run at once)."""
    from concurrent.futures import ThreadPoolExecutor
    t = _tables(spark, sf_dir)
    question, answer, absent = t.question, t.answer, t.absent
    paper_subject, subject, student = t.paper_subject, t.subject, t.student
    with ThreadPoolExecutor(max_workers=3) as pool:
        scores = pool.submit(scoring.score_answers, question, answer, absent)
        paper = pool.submit(totals.paper_totals_bounded, question, paper_subject, subject)
        student = students.load_students(student, t.batch, paper_subject)
        student_size = pool.submit(size_probe, detail_ops.student_side(student))
        (totals_df, bound), scores_df = paper.result(), scores.result()
    return detail_ops.question_detail(scores_df, totals_df, student, totals_bound=bound,
                                      student_size=student_size.result())


def _detail_and_positions(spark, sf_dir):
    """The detail plan and the pivot list; the pivot-list job runs while the
    detail plan's size checks run."""
    from concurrent.futures import ThreadPoolExecutor
    t = _tables(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=1) as pool:
        positions = pool.submit(wide.pivot_values, t.question)
        detail = question_detail(spark, sf_dir)
        return detail, positions.result()


def wide_scores(spark, sf_dir):
    d, pos = _detail_and_positions(spark, sf_dir)
    return wide.wide_scores(d, pos)


def wide_scores_strict(spark, sf_dir):
    d, pos = _detail_and_positions(spark, sf_dir)
    return wide.wide_scores_strict(d, pos)


def wide_scores_pivot_join(spark, sf_dir):
    d, pos = _detail_and_positions(spark, sf_dir)
    return wide.wide_scores_pivot_join(d, pos)


def student_total(spark, sf_dir):
    return wide.student_total(question_detail(spark, sf_dir))


def pivot_position(spark, sf_dir):
    d, pos = _detail_and_positions(spark, sf_dir)
    return wide.pivot_position(d, pos)


def pivot_type(spark, sf_dir):
    return wide.pivot_type(question_detail(spark, sf_dir))


def objective_total(spark, sf_dir):
    return wide.type_totals(question_detail(spark, sf_dir))


def violation_fix(spark, sf_dir):
    return wide.violation_fix(question_detail(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "score_answers": score_answers,
    "paper_totals": paper_totals,
    "composite_totals": composite_totals,
    "question_detail": question_detail,
    "wide_scores": wide_scores,
    "wide_scores_strict": wide_scores_strict,
    "wide_scores_pivot_join": wide_scores_pivot_join,
    "student_total": student_total,
    "pivot_position": pivot_position,
    "pivot_type": pivot_type,
    "objective_total": objective_total,
    "violation_fix": violation_fix,
}


# ------------------------------------------------------------------ functions
from pyspark.sql import functions as F  # noqa: E402

from scorekeep.functions.answers import normalize_answer as _normalize  # noqa: E402
from scorekeep.functions.rules import answer_key as _answer_key  # noqa: E402
from scorekeep.operators import dimension, export, sharding, students  # noqa: E402
from scorekeep.sources import catalog, params  # noqa: E402
from scorekeep.session import scratch_path  # noqa: E402

# The fixture shard layout: 2 databases x 8 tables (small enough for tests).
FIXTURE_LAYOUT = sharding.ShardLayout(db_key="paperId", tb_key="questionId", n_db=2, n_tb=8)
BUCKETS = 8


def answer_key(spark, sf_dir):
    return _answer_key(_tables(spark, sf_dir).question)


def normalize_answer(spark, sf_dir):
    a = _tables(spark, sf_dir).answer
    return a.select("questionId", "stuId", "questionOrder", "answer",
                    _normalize("answer").alias("answerKey"))


def score_multichoice(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return scoring.score_multichoice(t.question, t.answer)


def left_join_on_pred(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return scoring.left_join_on_predicate(t.answer, t.absent)


def filter_objective(spark, sf_dir):
    q = _tables(spark, sf_dir).question
    return q.where(dimension.objective_filter()).select("id", "paperId", "paperExamId",
                                                        "type", "score")


def dim_scan(spark, sf_dir):
    """Full, unfiltered scan of a dimension (the question table: it grows
    with the data, unlike the fixed-size subject list)."""
    return _tables(spark, sf_dir).question


def table_scan(spark, sf_dir):
    catalog.register_views(_tables(spark, sf_dir), prefix="exam_")
    return catalog.table_scan(spark, "exam_student")


def row_counts(spark, sf_dir):
    t = _tables(spark, sf_dir)
    parts = [getattr(t, name).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("tableName"), "n")
             for name in fixtures.VIEWS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def obj_score_export(spark, sf_dir):
    return export.obj_score_frame(score_answers(spark, sf_dir))


def question_dimension(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return dimension.question_dimension(t.paper, t.paper_subject, t.question)


def union_positional(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return totals.subject_totals(t.question, t.paper_subject, t.subject).union(
        totals.composite_totals(t.question, t.paper_subject))


def param_query(spark, sf_dir):
    t = _tables(spark, sf_dir)
    from scorekeep.plans.broadcast import bounded_broadcast
    question = bounded_broadcast(t.question.select("id", "type", "score"))
    return params.param_query(spark, params.SCORED_ANSWERS_SQL, params.SCORED_ANSWERS_ARGS,
                              answer=t.answer, question=question)


def student_batch_load(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return students.load_students(t.student, t.batch,
                                  t.paper_subject.where(F.col("status") == 1))


def shard_id(spark, sf_dir):
    a = _tables(spark, sf_dir).answer
    return sharding.with_shards(a, FIXTURE_LAYOUT).select(
        "questionId", "stuId", "questionOrder", "paperId", "db_shard", "tb_shard")


def shard_set(spark, sf_dir):
    q = _tables(spark, sf_dir).question.where(F.col("type") < 4)
    return sharding.shard_targets(q.withColumnRenamed("id", "questionId"), FIXTURE_LAYOUT,
                                  group="paperId")


def _sharded_answers(spark, sf_dir) -> str:
    """The answers' sharded layout: written by the first query that needs it, and again only when the files changed."""
    return sharding.sharded_layout(_tables(spark, sf_dir).answer, "answers-by-shard", FIXTURE_LAYOUT)


def shard_routed_read(spark, sf_dir):
    """Answers to one question of one paper, read by equality on both shard
    keys: one of the 2 x 8 shards is listed, and both keys reach the scan.
    The question is the smallest id of those that the data have."""
    t = _tables(spark, sf_dir)
    first = t.answer.agg(F.min(F.struct("questionId", "paperId")).alias("k")).first()["k"]
    path = _sharded_answers(spark, sf_dir)
    if first is None:
        return sharding.read_sharded(spark, path).drop(*sharding.SHARD_COLUMNS)
    return (sharding.routed_read(spark, path, FIXTURE_LAYOUT, paperId=first["paperId"],
                                 questionId=first["questionId"]).drop(*sharding.SHARD_COLUMNS))


def shard_gather(spark, sf_dir):
    path = _sharded_answers(spark, sf_dir)
    keys = (_tables(spark, sf_dir).question.where(dimension.objective_filter())
            .select(F.col("id").alias("questionId")))
    return (sharding.gather(sharding.read_sharded(spark, path), keys, FIXTURE_LAYOUT)
            .drop(*sharding.SHARD_COLUMNS))


def sharded_roundtrip(spark, sf_dir):
    path = _sharded_answers(spark, sf_dir)
    return sharding.read_sharded(spark, path).drop(*sharding.SHARD_COLUMNS)


def colocated_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    a = sharding.bucketed_layout(t.answer.select("questionId", "stuId", "questionOrder", "answer"),
                                 "answer_by_student", "stuId", BUCKETS)
    s = sharding.bucketed_layout(t.student.select("userId", "stuName", "schoolId", "classId"),
                                 "student_by_id", "userId", BUCKETS)
    return sharding.colocated_join(a, s, "stuId", "userId", buckets=BUCKETS).select(
        "questionId", "stuId", "questionOrder", "answer", "stuName", "schoolId", "classId")


QUERIES.update({
    "answer_key": answer_key,
    "normalize_answer": normalize_answer,
    "score_multichoice": score_multichoice,
    "left_join_on_pred": left_join_on_pred,
    "filter_objective": filter_objective,
    "dim_scan": dim_scan,
    "table_scan": table_scan,
    "row_counts": row_counts,
    "obj_score_export": obj_score_export,
    "question_dimension": question_dimension,
    "union_positional": union_positional,
    "param_query": param_query,
    "student_batch_load": student_batch_load,
    "shard_id": shard_id,
    "shard_set": shard_set,
    "shard_routed_read": shard_routed_read,
    "shard_gather": shard_gather,
    "sharded_roundtrip": sharded_roundtrip,
    "colocated_join": colocated_join,
})


# ------------------------------------------------------------ JDBC round trip
DERBY_DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


def jdbc_roundtrip(spark, sf_dir):
    """The absence table appended to a JDBC database and read back by a
    partitioned JDBC query scan.  The database is Derby in memory, inside the
    Spark JVM (no server, no port), so the check needs nothing outside."""
    import uuid

    from scorekeep.sinks.jdbc import write_jdbc
    from scorekeep.sources.jdbc import jdbc_query
    absent = _tables(spark, sf_dir).absent
    url = f"jdbc:derby:memory:scorekeep_{uuid.uuid4().hex[:12]};create=true"
    write_jdbc(absent, url, "absent_copy", mode="append", driver=DERBY_DRIVER,
               create_table_column_types="paperId VARCHAR(32)")
    lo, hi = absent.agg(F.min("userId"), F.max("userId")).first()
    return jdbc_query(spark, url, "SELECT * FROM absent_copy", driver=DERBY_DRIVER,
                      partition_column="userId", lower_bound=lo or 0, upper_bound=(hi or 0) + 1,
                      num_partitions=4)


QUERIES["jdbc_roundtrip"] = jdbc_roundtrip


def exam_job_runs(spark, sf_dir):
    """The staged job for one exam: rows and points of each output after a first run, after a second one that
    appends, after one that replaces, after one that dies before its commit, and after one that dies while it
    publishes a replacement and is finished by the next job.  Before all that, a run over all exams leaves rows of
    the others, those of one exam without its id; their number after everything is the last row of each table."""
    from scorekeep.plans.job import ExamJob

    class DiesBeforeCommit(ExamJob):
        def _commit(self, detail):
            raise ConnectionError("lost")

    class DiesWhilePublishing(ExamJob):
        def _publish(self, folder, entries):
            if entries["run"] != self.run_id:
                return super()._publish(folder, entries)
            from scorekeep.plans import publish
            publish.publish_files(self.spark, entries["files"][0])
            raise ConnectionError("lost")

    out = scratch_path(spark, "exam-job-runs")
    outputs = (("obj_score", "stuScore"), ("stu_que_detail", "stuScore"), ("stu_que_score", "total"))
    found = []

    def look(label, read):
        parts = [read(name).agg(F.lit(label).alias("run"), F.lit(name).alias("tableName"), F.count(F.lit(1)).alias("n"),
                                F.sum(points).alias("points")) for name, points in outputs]
        path = scratch_path(spark, f"runs-{label}")
        parts[0].unionByName(parts[1]).unionByName(parts[2]).write.parquet(path)
        found.append(spark.read.parquet(path))

    # all exams but 102, the answers of exam 103 without their exam's id
    t = _tables(spark, sf_dir)
    others = t.answer.where("paperExamId <> 102").withColumn(
        "paperExamId", F.when(F.col("paperExamId") != 103, F.col("paperExamId")))
    rest = fixtures.ExamTables(question=t.question, answer=others, absent=t.absent, student=t.student,
                               paper_subject=t.paper_subject, paper=t.paper, subject=t.subject, batch=t.batch)
    ExamJob(spark, rest, out).start()()((3, 1.0))
    for label, redo, kind in (("first", False, ExamJob), ("append", False, ExamJob), ("redo", True, ExamJob),
                              ("died", False, DiesBeforeCommit), ("finished", True, DiesWhilePublishing)):
        job = kind(spark, t, out, paper_id="P0", paper_exam_id=102, redo=redo)
        try:
            job.start()()((3, 1.0))
        except ConnectionError:
            job.recover() if kind is DiesBeforeCommit else ExamJob(spark, t, out).recover()
        look(label, job.read)
    look("others", lambda name: spark.read.option("mergeSchema", "true").parquet(f"{out}/{name}")
         .where("NOT coalesce(paperExamId = 102, false)"))
    whole = found[0]
    for df in found[1:]:
        whole = whole.unionByName(df)
    return whole


QUERIES["exam_job_runs"] = exam_job_runs


# ------------------------------------------------------------ SQL scorer, rejects, sinks read back
def multichoice_sql(spark, sf_dir):
    """The multi-choice scorer called as a function in SQL text (a join in the plan, no Python)."""
    from scorekeep.functions.sql import register_scorer
    t = _tables(spark, sf_dir)
    score = register_scorer(spark, t.question)
    return spark.sql(f"""
        SELECT a.questionId, a.stuId, a.questionOrder, a.answer, {score}(a.questionId, a.answer) AS ruleScore
        FROM {{answer}} a JOIN {{question}} q ON q.id = a.questionId WHERE q.type = 2""",
                     answer=t.answer, question=t.question.select("id", "type"))


def rejected_rules(spark, sf_dir):
    """Questions whose rules cannot be used, after the rules of some are cut short and scores of others spelt out."""
    from scorekeep.functions import rules
    q = _tables(spark, sf_dir).question
    damaged = (F.when(F.col("id") % 5 == 0, F.expr("substring(rules, 1, length(rules) - 5)"))
               .when(F.col("id") % 7 == 0, F.replace("rules", F.lit('"score":3'), F.lit('"score":"three"')))
               .otherwise(F.col("rules")))
    return rules.rejected_rules(q.withColumn("rules", damaged))


def detail_catalog(spark, sf_dir):
    """The detail fact in its typed 41-column target table: part of it inserted by position, the rest by SQL, and
    the table read back, with the type of its scores."""
    import uuid

    from scorekeep.sinks import tables as sink
    name = f"detail_target_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "detail-target")
    detail = question_detail(spark, sf_dir).select(*detail_ops.DETAIL_COLUMNS)
    staged = scratch_path(spark, "detail-staged")
    detail.write.parquet(staged)   # once: both inserts start from the written rows
    detail = spark.read.schema(detail.schema).parquet(staged)
    sink.create_detail_table(spark, name, path)
    try:
        sink.insert_into(detail.where("questionType = 2"), name)
        detail.where("questionType <> 2").createOrReplaceTempView(f"{name}_rest")
        sink.insert_select(spark, name, f"{name}_rest")
        spark.catalog.dropTempView(f"{name}_rest")
        back = spark.table(name)
        schema = back.schema
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")   # external: the rows stay where they are
    back = spark.read.schema(schema).parquet(path)
    return back.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in back.dtypes],
                       F.expr("typeof(stuScore)").alias("scoreType"))


def text_lines(spark, sf_dir):
    """The questions' rule texts written as lines of text files, and scanned."""
    path = scratch_path(spark, "rule-lines")
    _tables(spark, sf_dir).question.select("rules").write.text(path)
    return catalog.text_scan(spark, path)


def file_dump(spark, sf_dir):
    """The student table dumped as files, one folder a paper, and read back."""
    from scorekeep.sinks.files import write_files
    student = _tables(spark, sf_dir).student
    path = scratch_path(spark, "student-dump")
    write_files(student, path, partition_by=["paperId"])
    return spark.read.schema(student.schema).parquet(path).select(student.columns)


def wide_jdbc(spark, sf_dir):
    """The wide sheet in a JDBC table (Derby in memory): staged, moved by one transaction -- the second time it is
    asked for, nothing moves -- and read back by a partitioned scan."""
    import uuid

    from scorekeep.sinks import jdbc
    from scorekeep.sources.jdbc import jdbc_query
    sheet = wide_scores(spark, sf_dir)
    url = f"jdbc:derby:memory:scorekeep_{uuid.uuid4().hex[:12]};create=true"
    jdbc.create_like(sheet, url, "stu_que_score", driver=DERBY_DRIVER)
    for _ in range(2):
        jdbc.write_jdbc(sheet, url, "stu_que_score_new", mode="overwrite", driver=DERBY_DRIVER)
        jdbc.publish_staged(spark, url, "stu_que_score", "stu_que_score_new", "run-1", sheet.columns, driver=DERBY_DRIVER)
    whole = jdbc_query(spark, url, "SELECT * FROM stu_que_score", driver=DERBY_DRIVER)
    lo, hi = whole.agg(F.min("stuId"), F.max("stuId")).first()
    return jdbc_query(spark, url, "SELECT * FROM stu_que_score", driver=DERBY_DRIVER, partition_column="stuId",
                      lower_bound=lo or 0, upper_bound=(hi or 0) + 1, num_partitions=4)


QUERIES.update({
    "multichoice_sql": multichoice_sql,
    "rejected_rules": rejected_rules,
    "detail_catalog": detail_catalog,
    "text_lines": text_lines,
    "file_dump": file_dump,
    "wide_jdbc": wide_jdbc,
})
