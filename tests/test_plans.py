"""Physical-plan shape: broadcasts, pruning, shuffle counts."""

from pyspark.sql import functions as F

from scorekeep import queries
from scorekeep.operators import wide
from tests.conftest import SF_MEDIUM


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    df.count()
    return plan(df)


def test_scoring_broadcasts_dimensions(spark):
    p = formatted(queries.score_answers(spark, SF_MEDIUM))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_large_dimension_falls_back_to_shuffle_join(spark):
    spark.conf.set("scorekeep.broadcast.maxRows", "10")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries.score_answers(spark, SF_MEDIUM)
        p = formatted(df)
        assert "SortMergeJoin" in p
        assert df.count() == 40927
    finally:
        spark.conf.unset("scorekeep.broadcast.maxRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = queries.score_answers(spark, SF_MEDIUM)
    text = df._jdf.queryExecution().executedPlan().toString()
    # lineitem columns not used by the answer projection are not read
    assert "l_extendedprice" not in text and "l_shipdate" not in text
    assert "PushedFilters" in text


def test_routed_read_prunes_partitions(spark):
    df = queries.shard_routed_read(spark, SF_MEDIUM)
    df.count()
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # one database and one table shard are listed, and the numeric key reaches the scan
    filters = next(ln for ln in text.splitlines() if ln.startswith("PartitionFilters"))
    assert "db_shard" in filters and "tb_shard" in filters
    assert "EqualTo(questionId," in next(ln for ln in text.splitlines() if ln.startswith("PushedFilters"))


def test_equality_route_reads_one_database(spark, workdir):
    from scorekeep.operators import sharding
    from scorekeep.sources.fixtures import load
    layout = queries.FIXTURE_LAYOUT
    answers = load(spark, SF_MEDIUM).answer
    path = workdir + "/sharded"
    sharding.write_sharded(answers, path, layout, "overwrite")
    df = sharding.routed_read(spark, path, layout, paperId="P0")
    df.count()
    text = df._jdf.queryExecution().executedPlan().toString()
    from scorekeep.functions.shardhash import shard_index_py
    assert f"(db_shard#" in text and f"= {shard_index_py('P0', 2)})" in text
    assert df.count() == answers.where("paperId = 'P0'").count()
    one = sharding.routed_read(spark, path, layout, paperId="P1", questionId="7")
    assert one.count() == answers.where("paperId = 'P1' AND questionId = 7").count()


def test_gather_uses_dynamic_pruning(spark):
    p = formatted(queries.shard_gather(spark, SF_MEDIUM))
    assert "dynamicpruning" in p.lower()


def test_colocated_join_has_no_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries.colocated_join(spark, SF_MEDIUM)
        p = formatted(df)
        assert "SortMergeJoin" in p
        assert "Exchange" not in p
        assert df.count() == 60000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_wide_scores_single_shuffle(spark, workdir):
    detail = queries.question_detail(spark, SF_MEDIUM)
    path = workdir + "/detail"
    detail.write.parquet(path)
    d = spark.read.parquet(path)
    pos = [f"c{i}" for i in range(1, 21)]
    fused = wide.wide_scores(d, pos)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = wide.wide_scores_pivot_join(d, pos)
        fused.count()
        joined.count()
        assert _exchanges(fused) == 1
        assert _exchanges(joined) == 5   # three aggregates + two sort-merge self-joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_student_partitioning_is_reused(spark, workdir):
    from scorekeep.plans.partitioning import by_student
    detail = spark.read.parquet(_write_detail(spark, workdir))
    w = wide.wide_scores(by_student(detail), ["c1", "c2"])
    w.count()
    assert _exchanges(w) == 1   # the repartition only; the aggregation reuses it


def _write_detail(spark, workdir):
    path = workdir + "/detail2"
    queries.question_detail(spark, SF_MEDIUM).write.parquet(path)
    return path


def test_totals_one_aggregation_of_questions(spark):
    df = queries.paper_totals(spark, SF_MEDIUM)
    df.count()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in p
    assert "Expand" in p          # both grains from one grouping-sets aggregation
    assert df.agg(F.count("*")).collect()[0][0] == 53


def test_spread_only_narrow_inputs(spark):
    from scorekeep.plans.partitioning import spread_if_narrow
    from scorekeep.sources.fixtures import read_table
    from tests.conftest import SF_SMALL
    narrow = read_table(spark, SF_SMALL, "lineitem")
    assert narrow.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    spread = spread_if_narrow(narrow, ["l_orderkey", "l_partkey"])
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert spread.count() == narrow.count()
    wide_input = spark.range(0, 1000, numPartitions=32)
    assert spread_if_narrow(wide_input, ["id"]) is wide_input


def test_pivot_list_is_bounded(spark):
    import pytest
    from scorekeep.sources.fixtures import load
    from tests.conftest import SF_SMALL
    q = load(spark, SF_SMALL).question
    assert wide.pivot_values(q) == [f"c{i}" for i in range(1, 21)]
    with pytest.raises(ValueError):
        wide.pivot_values(q, max_values=5)


def test_hot_key_split_join(spark, workdir):
    """One student holds a third of the rows: the hot key is joined by
    broadcast, the rest by the bucketed join, and the result is exact."""
    from scorekeep.operators.sharding import colocated_join, write_bucketed
    from scorekeep.plans.skew import hot_keys
    rows = [(7, i) for i in range(300)] + [(k, k) for k in range(600)]
    facts = spark.createDataFrame(rows, "stuId long, q long")
    dim = spark.createDataFrame([(k, f"s{k}") for k in range(600)], "userId long, name string")
    a = write_bucketed(facts, "hot_facts", workdir + "/hf", "stuId", 8)
    d = write_bucketed(dim, "hot_dim", workdir + "/hd", "userId", 8)
    assert [r[0] for r in hot_keys(a, "stuId", 8).collect()] == [7]
    joined = colocated_join(a, d, "stuId", "userId", buckets=8)
    plain = facts.join(dim, facts.stuId == dim.userId)
    assert joined.count() == plain.count() == 900
    assert joined.exceptAll(plain.select(*joined.columns)).count() == 0
    assert "Union" in plan(joined)


def test_size_probe_counts_text_bytes(spark):
    from scorekeep.plans.broadcast import ROW_OVERHEAD, TEXT_SLOT, bounded_broadcast, size_probe
    df = spark.createDataFrame([(1, "ab"), (2, "cdef"), (3, None)], "k long, s string")
    n, b = size_probe(df)
    assert n == 3 and b == 3 * (ROW_OVERHEAD + 8 + TEXT_SLOT) + 6
    spark.conf.set("scorekeep.broadcast.maxBytes", str(b - 1))
    try:
        assert "broadcast" not in bounded_broadcast(df)._jdf.queryExecution().analyzed() \
            .toString().lower()
    finally:
        spark.conf.unset("scorekeep.broadcast.maxBytes")
    assert "broadcast" in bounded_broadcast(df)._jdf.queryExecution().analyzed() \
        .toString().lower()


def test_at_scale_aggregation_reuses_student_partitioning(spark):
    """Growing dimensions over the bound: the wide aggregation sits directly
    on the student sort-merge join -- no exchange in between, so the fact is
    shuffled by student once and both aggregation phases reuse it."""
    old_auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("scorekeep.broadcast.maxRows", "100")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = queries.wide_scores(spark, SF_MEDIUM)
        lines = plan(df).splitlines()
        first_join = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
        assert not any("Exchange" in ln for ln in lines[:first_join])
        assert sum("HashAggregate" in ln for ln in lines[:first_join]) == 2
        assert "stuId" in lines[first_join]
        assert df.count() == 11621
    finally:
        spark.conf.unset("scorekeep.broadcast.maxRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_auto)
        spark.conf.set("spark.sql.adaptive.enabled", old_aqe)


def test_bucketed_inputs_make_the_question_join_shuffle_free(spark, workdir):
    """Answer fact and question table bucketed alike on the question id: with
    the question table over the broadcast bound, the scoring join reads the
    buckets side by side and the fact is shuffled only by student."""
    from scorekeep.operators import scoring, sharding
    from scorekeep.sources.fixtures import load
    t = load(spark, SF_MEDIUM)
    a = sharding.write_bucketed(t.answer, "ans_by_question", workdir + "/a", "questionId", 8)
    q = sharding.write_bucketed(t.question, "question_by_id", workdir + "/q", "id", 8)
    old_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("scorekeep.broadcast.maxRows", "100")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = scoring.score_answers(q, a, t.absent)
        lines = plan(df).splitlines()
        join = next(i for i, ln in enumerate(lines) if "SortMergeJoin [questionId" in ln)
        below = lines[join + 1:]
        assert not any("Exchange" in ln for ln in below if "stuId" not in ln and "userId" not in ln)
        assert sum("Exchange hashpartitioning(stuId" in ln for ln in lines) == 1
        assert df.count() == 40927
    finally:
        spark.conf.unset("scorekeep.broadcast.maxRows")
        spark.conf.set("spark.sql.adaptive.enabled", old_aqe)


def test_hot_key_split_left_join_keeps_null_keys(spark, workdir):
    from scorekeep.operators.sharding import colocated_join, write_bucketed
    rows = [(7, i) for i in range(300)] + [(k, k) for k in range(600)] + [(None, -1)]
    facts = spark.createDataFrame(rows, "stuId long, q long")
    dim = spark.createDataFrame([(k, f"s{k}") for k in range(0, 600, 2)],
                                "userId long, name string")
    a = write_bucketed(facts, "hot_left_facts", workdir + "/lf", "stuId", 8)
    d = write_bucketed(dim, "hot_left_dim", workdir + "/ld", "userId", 8)
    joined = colocated_join(a, d, "stuId", "userId", how="left", buckets=8)
    plain = facts.join(dim, facts.stuId == dim.userId, "left")
    assert joined.count() == plain.count() == 901
    assert joined.where("stuId IS NULL").count() == 1
    assert joined.exceptAll(plain.select(*joined.columns)).count() == 0


def test_estimates_speak_for_plain_scans_only(spark, tables_small):
    from scorekeep.plans.broadcast import bounded_broadcast, estimated_bytes, size_probe
    t = tables_small
    assert estimated_bytes(t.student) > 0
    assert estimated_bytes(t.student.where("userId > 3")) is None
    assert estimated_bytes(t.student.join(t.batch, "paperId")) is None
    spark.conf.set("scorekeep.broadcast.maxBytes", "1")
    try:
        assert size_probe(t.student)[0] > 1 << 60   # no job: the estimate is far over the bound
        assert "Broadcast" not in t.answer.join(bounded_broadcast(t.student), t.answer["stuId"] == t.student["userId"])\
            ._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("scorekeep.broadcast.maxBytes")


def test_second_plan_of_a_session_measures_nothing(spark):
    """Sizes are remembered for unchanged files: building the sheet again takes the pivot list's job only."""
    from scorekeep import queries
    from tests.conftest import SF_SMALL
    queries.wide_scores(spark, SF_SMALL)
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    before = set(tracker.getJobIdsForGroup(None))
    queries.wide_scores(spark, SF_SMALL)
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 3 and sc is not None


def test_totals_over_the_product_bound_are_measured(spark, tables_small):
    """Many exams and subjects: their product is over the bound, the totals themselves are not."""
    from scorekeep.operators import detail, scoring, totals
    t = tables_small
    paper, _ = totals.paper_totals_bounded(t.question, t.paper_subject, t.subject)
    scores = scoring.score_answers(t.question, t.answer, t.absent)
    df = detail.question_detail(scores, paper, t.student, totals_bound=(20_000 * 26, 1 << 27))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan.split("pt_paperExamId", 1)[0] + plan


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_answers_are_scored_before_the_absences_join(spark, tables_small):
    """Neither the rule map nor the raw answer goes through the shuffle of the absences' join."""
    from scorekeep.operators import scoring
    t = tables_small
    lines = optimized(scoring.score_answers(t.question, t.answer, t.absent, max_broadcast_rows=0)).splitlines()
    join = next(i for i, ln in enumerate(lines) if "Join LeftOuter" in ln)
    assert "AS stuScore#" in lines[join + 1]


def test_few_shards_are_written_without_a_shuffle(spark, workdir):
    from scorekeep.operators import sharding
    rows = [(f"P{i % 3}", i) for i in range(50)] * 2
    df = spark.createDataFrame(rows, "paperId string, questionId long")
    few, many = sharding.ShardLayout(n_db=2, n_tb=8), sharding.ShardLayout(n_db=2, n_tb=256)
    assert "Rebalance" not in optimized(sharding.shard_rows(df, few))
    assert "Rebalance" in optimized(sharding.shard_rows(df, many))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    for layout in (few, many):
        back = sharding.write_sharded(df, f"{workdir}/{layout.n_tb}", layout)
        want = sharding.with_shards(df, layout).select(back.columns)
        assert back.count() == 100 and back.exceptAll(want).count() == 0
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_detail_catalog_computes_the_detail_once(spark, monkeypatch):
    """Both inserts read written rows; no join runs a second time."""
    from scorekeep.sinks import tables
    from tests.conftest import SF_SMALL
    plans, insert = [], tables.insert_into

    def seen(df, *args, **kwargs):
        plans.append(optimized(df))
        return insert(df, *args, **kwargs)

    monkeypatch.setattr(tables, "insert_into", seen)
    whole = queries.detail_catalog(spark, SF_SMALL).count()
    assert whole == queries.question_detail(spark, SF_SMALL).count()
    assert len(plans) == 1 and "Join" not in plans[0]


def test_small_totals_join_after_the_students(spark, tables_small):
    """The totals' columns are not shuffled with the students, and a student of two papers gives the same rows."""
    from scorekeep.operators import detail, scoring, totals
    t = tables_small
    scores = scoring.score_answers(t.question, t.answer, t.absent)
    paper = totals.paper_totals(t.question, t.paper_subject, t.subject)
    both = t.student.unionByName(t.student.where("userId % 3 = 0").withColumn(
        "paperId", F.when(F.col("paperId") == "P0", "P1").when(F.col("userId") % 2 == 1, "P0")))
    after = detail.question_detail(scores, paper, both)
    before = detail.question_detail(scores, paper, both, max_broadcast_rows=0)
    top = [next(ln for ln in optimized(df).splitlines() if "Join Inner" in ln) for df in (after, before)]
    assert "pt_subjectId" in top[0] and "pt_subjectId" not in top[1]
    assert after.count() == before.count() > 0
    assert after.exceptAll(before).count() == 0


def test_answers_without_an_absence_are_not_shuffled(spark, tables_small):
    """Absences over the broadcast bound: only answers that may have one go through the join's shuffle, and the rows
    are those of the plain join -- null and repeated keys included."""
    from scorekeep.operators import scoring
    t = tables_small
    odd = t.answer.limit(40)
    answer = t.answer.unionByName(odd).unionByName(odd.withColumn("stuId", F.lit(None).cast("long"))).unionByName(
        odd.withColumn("paperId", F.lit(None).cast("string")))
    absent = t.absent.unionByName(t.absent.limit(30).withColumn("dubiousType", F.lit(9))).unionByName(
        t.absent.limit(30).withColumn("userId", F.lit(None).cast("long")))
    plain = [scoring.score_answers(t.question, answer, absent).collect(),
             scoring.left_join_on_predicate(answer, absent).collect()]
    spark.conf.set("scorekeep.broadcast.maxRows", "10")
    spark.conf.set("scorekeep.keyfilter.minRows", "1")
    try:
        split = [scoring.score_answers(t.question, answer, absent), scoring.left_join_on_predicate(answer, absent)]
        for df, want in zip(split, plain, strict=True):
            assert "Union" in optimized(df)
            assert sorted(map(str, df.collect())) == sorted(map(str, want))
        # the rows in the join's shuffle: of a key that no absence has, next to none
        alone = t.answer.withColumn("stuId", F.col("stuId") + (1 << 40))
        from scorekeep.plans.keyfilter import split_by_keys
        keys = t.absent.select("userId").distinct()
        some, none = split_by_keys(t.answer.unionByName(alone), ["stuId"], keys, ["userId"], keys.count())
        n = t.answer.count()
        matching = t.answer.join(keys, F.col("stuId") == F.col("userId"), "left_semi")
        assert some.count() + none.count() == 2 * n
        assert none.join(keys, F.col("stuId") == F.col("userId"), "left_semi").count() == 0
        assert matching.count() <= some.count() < matching.count() + 2 * n * 0.2
    finally:
        spark.conf.unset("scorekeep.broadcast.maxRows")
        spark.conf.unset("scorekeep.keyfilter.minRows")


def test_only_answers_to_objective_questions_are_shuffled(spark):
    """Questions over the broadcast bound: answers that are to none of them stay out of the shuffle, and a part of the
    answers is joined with its absences while it is narrow.  The absences are made distinct once."""
    from scorekeep.operators import scoring
    from scorekeep.plans.keyfilter import rows_that_may_match
    kinds = [(i, f"P{i % 2}", 1 + i % 4, f"N{i}", (i % 5) / 2, "easy", "A", i % 20, None, i % 25)
             for i in range(400)]
    question = spark.createDataFrame(kinds, "id long, paperId string, type long, No string, score double, difficulty string,"
                                     "standardAnswer string, pos long, rules string, subjectId long")
    rows = [(i % 500 if i % 97 else None, i % 700, f"P{i % 2}", "n", 100 + i % 10, "e", f"S{i}", 1, 1, "A" if i % 3 else "N",
             "A", 0, 0, 0, 1, 1) for i in range(4000)]
    answer = spark.createDataFrame(rows, "questionId long, stuId long, paperId string, paperName string, paperExamId long,"
                                   "paperExamName string, stuSeq string, schoolId long, questionOrder long, answer string,"
                                   "fixAnswer string, isDubious int, dubiousType int, ABFlag int, isChoose int, status int")
    missed = [(i % 150 if i % 31 else None, f"P{i % 2}", 100 + i % 10, 1 + i % 5, i % 7 and 1, 1) for i in range(600)]
    absent = spark.createDataFrame(missed, "userId long, paperId string, paperExamId long, dubiousType int, status int,"
                                   "sourceFrom int").distinct()
    want = sorted(map(str, scoring.score_answers(question, answer, absent).collect()))
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key, value in (("scorekeep.broadcast.maxRows", "10"), ("scorekeep.keyfilter.minRows", "1"),
                       ("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        df = scoring.score_answers(question, answer, absent)
        assert sorted(map(str, df.collect())) == want and len(want) > 1000
        lines = optimized(df).splitlines()
        sitting = next(i for i, ln in enumerate(lines) if "Join LeftOuter" in ln and "ab_userId" in ln)
        assert not any("questionScore#" in ln for ln in lines[sitting:sitting + 2])
        objective = question.where("type < 4")
        kept = rows_that_may_match(answer, ["questionId"], objective, ["id"], objective.count())
        matching = answer.join(objective, F.col("questionId") == F.col("id"), "left_semi")
        assert matching.count() <= kept.count() < matching.count() + 0.1 * len(rows)
        assert kept.join(objective, F.col("questionId") == F.col("id"), "left_semi").count() == matching.count()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        distinct = [ln for ln in final.splitlines() if "Exchange hashpartitioning(paperId" in ln]
        assert sum("ReusedExchange" not in ln for ln in distinct) == 1
    finally:
        spark.conf.unset("scorekeep.broadcast.maxRows")
        spark.conf.unset("scorekeep.keyfilter.minRows")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
