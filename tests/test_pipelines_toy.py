"""The pipelines on hand-made rows, expected values worked out by hand."""

import pytest

from scorekeep.operators.detail import question_detail
from scorekeep.operators.scoring import score_answers
from scorekeep.operators.totals import paper_totals
from scorekeep.operators.wide import wide_scores, wide_scores_strict

RULES = '[{"type":"group","values":[{"name":"A","score":1},{"name":"A,C","score":"3"}]}]'
Q_SCHEMA = ("id long, paperId string, paperExamId long, subjectId long, type int, pos int, "
            "questionOrder int, score double, standardAnswer string, No string, "
            "difficulty string, rules string")
A_SCHEMA = ("questionId long, stuId long, paperId string, paperName string, paperExamId long, "
            "paperExamName string, stuSeq string, schoolId long, questionOrder int, "
            "answer string, fixAnswer string, isDubious int, dubiousType int, ABFlag int, "
            "isChoose int, status int")


@pytest.fixture()
def toy(spark):
    q = spark.createDataFrame([
        (1, "P", 100, 1, 1, 1, 1, 2.0, "A", "1", "easy", None),     # single choice
        (2, "P", 100, 1, 2, 2, 2, 3.0, "A", "2", "easy", RULES),    # multi choice
        (3, "P", 100, 2, 3, 3, 3, 1.0, "B", "3", "hard", None),     # true/false
        (4, "P", 100, 2, 4, 4, 4, 5.0, None, "4", "hard", None),    # subjective
        (5, "P", 100, 2, 1, 5, 0, 9.0, "A", "5", "easy", None),     # order 0: not in totals
    ], Q_SCHEMA)

    def ans(qid, stu, answer, fix="X", dub=0, dtype=0, choose=1, status=1):
        return (qid, stu, "P", "Paper", 100, "Exam", f"S{stu}", 9, qid, answer, fix, dub, dtype,
                0, choose, status)

    a = spark.createDataFrame([
        ans(1, 10, "A"),                      # match -> 2.0
        ans(2, 10, "C,A"),                    # rule "A,C" -> 3.0
        ans(3, 10, "A"),                      # mismatch -> 0
        ans(4, 10, "anything"),               # subjective: filtered out
        ans(1, 11, None),                     # null answer -> 0
        ans(2, 11, ""),                       # empty multi-choice answer -> 0
        ans(3, 11, "B", dub=1, dtype=2),      # match, shown as the fixed answer
        ans(1, 12, "A", choose=0),            # not chosen: filtered out
        ans(1, 13, "A", status=0),            # not live: filtered out
        ans(2, 12, "B"),                      # unknown combination -> 0
    ], A_SCHEMA)
    # students 10 and 11 are also absent from another exam, student 10 is also listed for another paper
    absent = spark.createDataFrame(
        [(10, "P", 100, 4, 1, 1), (10, "P", 999, 2, 1, 1), (11, "P", 100, 2, 0, 1), (11, "Q", 100, 3, 1, 1)],
        "userId long, paperId string, paperExamId long, dubiousType int, status int, sourceFrom int")
    ps = spark.createDataFrame([(100, "P", "Paper", "Exam", None, 1)],
                               "id long, paperId string, paperName string, paperExamName string, "
                               "isAB int, isComprehensive int")
    subject = spark.createDataFrame([(1, "Maths", "Ma"), (2, "Physics", "Ph")],
                                    "id long, subjectName string, shortName string")
    student = spark.createDataFrame(
        [(u, p, f"n{u}", 1, "c", 2, "a", 9, "s", 3, "g", "k", "kn", None, None)
         for u, p in ((10, "P"), (10, "Q"), (11, "P"), (12, "P"))],
        "userId long, paperId string, stuName string, cityId long, cityName string, areaId long, "
        "areaName string, schoolId long, schoolName string, gradeId long, gradeName string, "
        "classId string, className string, isRestudy int, classType int")
    return q, a, absent, ps, subject, student


def test_score_answers_cases(toy):
    q, a, absent, *_ = toy
    got = {(r.stuId, r.questionId): r for r in score_answers(q, a, absent).collect()}
    assert set(got) == {(10, 1), (10, 2), (10, 3), (11, 1), (11, 2), (11, 3), (12, 2)}
    assert got[(10, 1)].stuScore == 2.0 and got[(10, 1)].pos == "c1"
    assert got[(10, 2)].stuScore == 3.0
    assert got[(10, 3)].stuScore == 0.0
    assert got[(11, 1)].stuScore == 0.0 and got[(11, 2)].stuScore == 0.0
    assert got[(11, 3)].stuScore == 1.0 and got[(11, 3)].answer == "X"   # shown fixed, raw scored
    assert got[(12, 2)].stuScore == 0.0
    # live absence of student 10: flagged; student 11's absence is not live: kept, no flag
    assert got[(10, 1)].isDubious == 1 and got[(10, 1)].dubiousType == 4
    assert got[(11, 1)].isDubious == 0 and got[(11, 1)].dubiousType is None
    assert got[(12, 2)].sourceScore is None


def test_paper_totals_with_composite(toy):
    q, _, _, ps, subject, _ = toy
    rows = {r.subjectId: r for r in paper_totals(q, ps, subject).collect()}
    assert set(rows) == {1, 2, 100}
    assert (rows[1].objTotal, rows[1].subTotal, rows[1].paperTotal) == (5.0, 0.0, 5.0)
    assert (rows[2].objTotal, rows[2].subTotal, rows[2].paperTotal) == (1.0, 5.0, 6.0)
    composite = rows[100]
    assert (composite.subjectShortName, composite.subjectName) == ("ZH", "Exam")
    assert (composite.objTotal, composite.subTotal, composite.paperTotal) == (6.0, 5.0, 11.0)
    assert composite.isComprehensiveSubject == 0 and rows[1].isComprehensiveSubject == 1
    assert all(r.isAB == 0 for r in rows.values())


def test_detail_and_wide(toy):
    q, a, absent, ps, subject, student = toy
    detail = question_detail(score_answers(q, a, absent), paper_totals(q, ps, subject), student)
    rows = detail.collect()
    assert len(rows) == 7
    assert all(r.isRestudy == 1 and r.classType == 0 and r.questionKnowledges is None
               for r in rows)
    assert {r.subjectShortName for r in rows} == {"Ma", "Ph"}
    sheet = {r.stuId: r for r in wide_scores(detail, ["c1", "c2", "c3"]).collect()}
    s10 = sheet[10]
    assert (s10.c1, s10.c2, s10.c3, s10.total) == (2.0, 3.0, 0.0, 5.0)
    assert s10.objectiveTotal == 5.0 and s10.subjectiveTotal == 0.0
    assert s10.fixTotal == 4.0                      # misconduct: 5 - 1
    assert sheet[11].fixTotal is None and sheet[11].total == 1.0
    assert sheet[12].c1 is None and sheet[12].c2 == 0.0
    strict = {r.stuId for r in wide_scores_strict(detail, ["c1", "c2", "c3"]).collect()}
    assert strict == {10}                           # null dubiousType groups dropped
    rule2 = {r.stuId: r.fixTotal for r in wide_scores(detail, ["c1"], (2, 0.0)).collect()}
    assert rule2[10] == 0.0


def test_output_column_order(toy):
    from scorekeep.operators.detail import DETAIL_COLUMNS
    from scorekeep.operators.scoring import SCORE_COLUMNS
    from scorekeep.operators.totals import TOTAL_COLUMNS
    q, a, absent, ps, subject, student = toy
    scores = score_answers(q, a, absent)
    totals = paper_totals(q, ps, subject)
    assert scores.columns == SCORE_COLUMNS
    assert totals.columns == TOTAL_COLUMNS
    assert question_detail(scores, totals, student).columns == DETAIL_COLUMNS
    assert len(DETAIL_COLUMNS) == 41
