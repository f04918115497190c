"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each text defines the exam views it needs as CTEs over the raw tables
(``part``, ``lineitem``, ``orders``, ``nation``, ``region``) from the same
column expressions the Spark side uses, then computes the query the plain
relational way (joins and GROUP BYs, the answer key as an unnested table).
"""

from __future__ import annotations

from scorekeep.sources.fixtures import duckdb_with

RULE_TYPE_DUCKDB = '[{"type":"VARCHAR","values":[{"name":"VARCHAR","score":"VARCHAR"}]}]'


def norm(x: str) -> str:
    """Answer normaliser in DuckDB SQL."""
    return (f"(CASE WHEN contains({x}, ',') THEN "
            f"array_to_string(list_sort(string_split(lower({x}), ',')), '') ELSE {x} END)")


ANSWER_KEY_CTE = f"""
rule_entries AS (
  SELECT questionId, epos, unnest(entry."values") AS v,
         generate_subscripts(entry."values", 1) AS vpos
  FROM (SELECT questionId, unnest(j) AS entry, generate_subscripts(j, 1) AS epos
        FROM (SELECT id AS questionId, from_json(rules, '{RULE_TYPE_DUCKDB}') AS j
              FROM question WHERE type = 2))
  WHERE lower(entry.type) = 'group'
),
rule_pairs AS (
  SELECT questionId, {norm('v.name')} AS answerKey,
         TRY_CAST(v.score AS FLOAT) AS ruleScore,
         row_number() OVER (PARTITION BY questionId, {norm('v.name')}
                            ORDER BY epos DESC, vpos DESC) AS rn
  FROM rule_entries WHERE v.name IS NOT NULL
),
answer_key AS (
  SELECT questionId, answerKey, ruleScore FROM rule_pairs WHERE rn = 1
)"""

# Scores, in stages: which answers count, what each earns by the kind of its
# question, what the absence list says of the sitting, and then one row each.
SCORES_CTE = f"""
counted AS MATERIALIZED (
  SELECT row_number() OVER () AS line, answer.*, question.subjectId, question.No, question.type, question.score, question.difficulty,
         question.standardAnswer, question.pos
  FROM answer, question
  WHERE question.id = answer.questionId AND question.type < 4
    AND answer.status = 1 AND answer.isChoose > 0
),
earned AS (
  SELECT line, score AS points
  FROM counted WHERE type IN (1, 3) AND answer = standardAnswer
  UNION ALL
  SELECT line, CAST(ruleScore AS DOUBLE)
  FROM counted, answer_key
  WHERE type = 2 AND answer <> '' AND answer_key.questionId = counted.questionId AND answerKey = {norm('answer')}
),
missed AS (
  SELECT userId AS stuId, paperId, paperExamId, dubiousType AS missType, sourceFrom AS missSource
  FROM absent WHERE status = 1
),
scores AS (
  SELECT paperId, paperName, paperExamId, paperExamName, stuId, stuSeq, schoolId, subjectId, questionId,
         questionOrder, No AS questionNo, type AS questionType, score AS questionScore, difficulty,
         CASE WHEN dubiousType > 0 AND counted.isDubious = 1 THEN fixAnswer ELSE answer END AS answer, ABFlag,
         CAST(missType IS NOT NULL AS INTEGER) AS isDubious, missType AS dubiousType,
         COALESCE(points, 0) AS stuScore, missSource AS sourceScore, isChoose, standardAnswer,
         concat('c', pos) AS pos
  FROM counted
  LEFT JOIN earned USING (line)
  LEFT JOIN missed USING (stuId, paperId, paperExamId)
)"""


def with_views(views, ctes=(), body="") -> str:
    head = duckdb_with(*views)
    extra = "".join(",\n" + c.strip() for c in ctes)
    return f"{head}{extra}\n{body}"


def score_answers() -> str:
    return with_views(["question", "answer", "absent"], [ANSWER_KEY_CTE, SCORES_CTE],
                      "SELECT * FROM scores")


QUERIES = {
    "score_answers": score_answers,
}


def oracle_sql() -> dict[str, str]:
    return {name: build() for name, build in QUERIES.items()}


# ---------------------------------------------------------------- E2 totals
# Full marks per exam and subject and per exam, as filtered sums over the numbered
# questions; names and flags are looked up afterwards.
TOTALS_CTES = """
marks AS (
  SELECT paperId, paperExamId, subjectId, GROUPING(subjectId) = 1 AS whole,
         round(coalesce(sum(score) FILTER (type < 4 OR type > 4), 0), 2) AS objTotal,
         round(coalesce(sum(score) FILTER (type = 4), 0), 2) AS subTotal,
         round(sum(score), 2) AS paperTotal
  FROM question WHERE questionOrder >= 1
  GROUP BY GROUPING SETS ((paperId, paperExamId, subjectId), (paperId, paperExamId))
),
exam AS (
  SELECT id AS paperExamId, paperId, paperName, paperExamName, isComprehensive, coalesce(isAB, 0) AS isAB FROM paper_subject
),
by_subject AS (
  SELECT m.paperId, paperName, m.paperExamId, paperExamName, CAST(m.subjectId AS BIGINT) AS subjectId, subjectName,
         shortName AS subjectShortName, objTotal, subTotal, paperTotal, isAB, isComprehensive AS isComprehensiveSubject
  FROM marks m, exam, subject
  WHERE NOT whole AND exam.paperId = m.paperId AND exam.paperExamId = m.paperExamId AND subject.id = m.subjectId
),
by_composite AS (
  SELECT m.paperId, paperName, m.paperExamId, paperExamName, m.paperExamId AS subjectId, paperExamName AS subjectName,
         'ZH' AS subjectShortName, objTotal, subTotal, paperTotal, isAB, 0 AS isComprehensiveSubject
  FROM marks m, exam
  WHERE whole AND exam.paperId = m.paperId AND exam.paperExamId = m.paperExamId AND isComprehensive = 1
),
totals AS (SELECT * FROM by_subject UNION ALL SELECT * FROM by_composite)"""

# Students of a paper's import batches; where a paper has several, only those of a listed exam.
ENROLLED_CTE = """
batches AS (SELECT paperId, id AS batchId, count(*) OVER (PARTITION BY paperId) AS n FROM (SELECT DISTINCT paperId, id FROM batch)),
enrolled AS (
  SELECT student.* FROM student SEMI JOIN batches
    ON batches.paperId = student.paperId AND batches.batchId = student.batchId
    AND (n = 1 OR (student.paperId, student.paperExamId) IN (SELECT (paperId, id) FROM paper_subject))
)"""

DETAIL_CTE = """
detail AS (
  SELECT t.paperId, t.paperName, s.paperExamId, t.paperExamName, stuId, stuSeq, t.isAB AS abFlag, isChoose, isDubious,
         dubiousType, answer, standardAnswer, questionId, questionNo, questionOrder, questionType, questionScore,
         stuScore, difficulty, pos, s.subjectId, t.subjectName, t.subjectShortName,
         e.* EXCLUDE (userId, paperId, paperExamId, batchId, isRestudy, classType),
         coalesce(e.isRestudy, 1) AS isRestudy, coalesce(e.classType, 0) AS classType,
         t.objTotal AS paperObTotal, t.subTotal AS paperSubTotal, t.paperTotal,
         CAST(NULL AS VARCHAR) AS questionKnowledges, t.isComprehensiveSubject
  FROM totals t, enrolled e, scores s
  WHERE t.paperExamId = s.paperExamId AND t.subjectId = s.subjectId
    AND e.userId = s.stuId AND e.paperId = s.paperId
)"""

DETAIL_VIEWS = ["question", "answer", "absent", "paper_subject", "subject", "student", "batch"]
DETAIL_CTES = [ANSWER_KEY_CTE, SCORES_CTE, TOTALS_CTES, ENROLLED_CTE, DETAIL_CTE]

# The fixture gives question positions 1..20 (pos = 1 + p_partkey % 20).
POSITIONS = [f"c{i}" for i in range(1, 21)]
WIDE_KEYS = "paperId, paperName, paperExamId, paperExamName, stuId, stuSeq, dubiousType"
STRICT_FILTER = " AND ".join(f"{k.strip()} IS NOT NULL" for k in WIDE_KEYS.split(","))


def _f(x: str) -> str:
    return f"COALESCE(CAST({x} AS FLOAT), CAST(0 AS FLOAT))"


def _fix(total: str) -> str:
    """Rule 3 with a deduction of 1: only for dubious type 4, not below 0, null stays null."""
    return (f"CASE WHEN dubiousType = 4 AND {total} IS NOT NULL THEN "
            f"greatest(CAST({total} AS FLOAT) - CAST(1.0 AS FLOAT), CAST(0 AS FLOAT)) END")


def _wide(where: str = "") -> str:
    cells = ",\n    ".join(f"SUM(CASE WHEN pos = '{p}' THEN stuScore END) AS {p}"
                            for p in POSITIONS)
    types = ",\n    ".join(f"SUM(CASE WHEN questionType = {t} THEN stuScore END) AS t{t}"
                            for t in (1, 2, 3, 4))
    agg = (f"SELECT {WIDE_KEYS},\n    {cells},\n    SUM(stuScore) AS total,\n    {types}\n"
           f"  FROM detail {where} GROUP BY {WIDE_KEYS}")
    cols = ", ".join(POSITIONS)
    return (f"SELECT {WIDE_KEYS}, {cols}, total,\n"
            f"  ({_f('0')} + {_f('0')}) + {_f('t4')} AS subjectiveTotal,\n"
            f"  ({_f('t1')} + {_f('t2')}) + {_f('t3')} AS objectiveTotal,\n"
            f"  0 AS sourceScore,\n  {_fix('total')} AS fixTotal\nFROM ({agg}) w")


def paper_totals() -> str:
    return with_views(["question", "paper_subject", "subject"], [TOTALS_CTES],
                      "SELECT * FROM totals")


def composite_totals() -> str:
    return with_views(["question", "paper_subject", "subject"], [TOTALS_CTES],
                      "SELECT * FROM by_composite")


def question_detail() -> str:
    return with_views(DETAIL_VIEWS, DETAIL_CTES, "SELECT * FROM detail")


def wide_scores() -> str:
    return with_views(DETAIL_VIEWS, DETAIL_CTES, _wide())


def wide_scores_strict() -> str:
    return with_views(DETAIL_VIEWS, DETAIL_CTES, _wide(f"WHERE {STRICT_FILTER}"))


def student_total() -> str:
    return with_views(DETAIL_VIEWS, DETAIL_CTES,
                      f"SELECT {WIDE_KEYS}, SUM(stuScore) AS total FROM detail GROUP BY {WIDE_KEYS}")


def pivot_position() -> str:
    cells = ", ".join(f"SUM(CASE WHEN pos = '{p}' THEN stuScore END) AS {p}" for p in POSITIONS)
    return with_views(DETAIL_VIEWS, DETAIL_CTES,
                      f"SELECT {WIDE_KEYS}, {cells} FROM detail GROUP BY {WIDE_KEYS}")


def pivot_type() -> str:
    cells = ", ".join(f'SUM(CASE WHEN questionType = {t} THEN stuScore END) AS "{t}"'
                      for t in (1, 2, 3, 4))
    return with_views(DETAIL_VIEWS, DETAIL_CTES,
                      f"SELECT {WIDE_KEYS}, {cells} FROM detail GROUP BY {WIDE_KEYS}")


def objective_total() -> str:
    types = ", ".join(f"SUM(CASE WHEN questionType = {t} THEN stuScore END) AS t{t}"
                      for t in (1, 2, 3, 4))
    return with_views(DETAIL_VIEWS, DETAIL_CTES,
                      f"SELECT {WIDE_KEYS},\n"
                      f"  ({_f('0')} + {_f('0')}) + {_f('t4')} AS subjectiveTotal,\n"
                      f"  ({_f('t1')} + {_f('t2')}) + {_f('t3')} AS objectiveTotal\n"
                      f"FROM (SELECT {WIDE_KEYS}, {types} FROM detail GROUP BY {WIDE_KEYS}) p")


def violation_fix() -> str:
    return with_views(DETAIL_VIEWS, DETAIL_CTES,
                      f"SELECT {WIDE_KEYS}, total, {_fix('total')} AS fixTotal\n"
                      f"FROM (SELECT {WIDE_KEYS}, SUM(stuScore) AS total FROM detail "
                      f"GROUP BY {WIDE_KEYS}) s")


QUERIES.update({
    "paper_totals": paper_totals,
    "composite_totals": composite_totals,
    "question_detail": question_detail,
    "wide_scores": wide_scores,
    "wide_scores_strict": wide_scores_strict,
    "wide_scores_pivot_join": wide_scores_strict,
    "student_total": student_total,
    "pivot_position": pivot_position,
    "pivot_type": pivot_type,
    "objective_total": objective_total,
    "violation_fix": violation_fix,
})


# ---------------------------------------------------------- other operators
from scorekeep.sources import fixtures as _fx  # noqa: E402


def _all_columns(view: str) -> list[str]:
    return [name for name, _ in _fx.VIEWS[view].columns]


def answer_key() -> str:
    return with_views(["question"], [ANSWER_KEY_CTE],
                      "SELECT questionId, answerKey, ruleScore FROM answer_key")


def normalize_answer() -> str:
    return with_views(["answer"], [], f"SELECT questionId, stuId, questionOrder, answer, "
                                      f"{norm('answer')} AS answerKey FROM answer")


def score_multichoice() -> str:
    return with_views(["question", "answer"], [ANSWER_KEY_CTE], f"""
SELECT a.questionId, a.stuId, a.questionOrder, a.answer,
  CAST(CASE WHEN a.answer IS NULL OR a.answer = '' THEN 0
            ELSE COALESCE(k.ruleScore, 0) END AS FLOAT) AS ruleScore
FROM answer a JOIN question q ON (q.id = a.questionId AND q.type = 2)
LEFT JOIN answer_key k ON (k.questionId = a.questionId AND k.answerKey = {norm('a.answer')})""")


def left_join_on_pred() -> str:
    return with_views(["answer", "absent"], ["""
missed AS (SELECT userId AS stuId, paperId, paperExamId, dubiousType AS missType, sourceFrom
           FROM absent WHERE status = 1)"""], """
SELECT questionId, stuId, questionOrder, answer, dubiousType AS answerDubiousType,
  missType AS dubiousType, CAST(missType IS NOT NULL AS INTEGER) AS isDubious, sourceFrom AS sourceScore
FROM answer LEFT JOIN missed USING (stuId, paperId, paperExamId)""")


def filter_objective() -> str:
    return with_views(["question"], [], "SELECT id, paperId, paperExamId, type, score "
                                        "FROM question WHERE CAST(type AS INTEGER) != 4")


def dim_scan() -> str:
    return with_views(["question"], [], "SELECT * FROM question")


def table_scan() -> str:
    return with_views(["student"], [], "SELECT * FROM student")


def row_counts() -> str:
    names = list(_fx.VIEWS)
    body = "\nUNION ALL ".join(f"SELECT '{n}' AS tableName, COUNT(*) AS n FROM {n}"
                               for n in names)
    return with_views(names, [], body)


def obj_score_export() -> str:
    from scorekeep.operators.export import DEFAULT_WRITER
    return with_views(["question", "answer", "absent"], [ANSWER_KEY_CTE, SCORES_CTE], f"""
SELECT paperId, paperName, paperExamId, paperExamName, stuId, stuSeq, schoolId, questionId,
  questionOrder, answer, ABFlag, stuScore AS questionScore, 0 AS sourceScore, 1 AS status,
  '{DEFAULT_WRITER}' AS lastModifier, '{DEFAULT_WRITER}' AS creator
FROM scores""")


def question_dimension() -> str:
    # every table by itself: its live rows, its columns under its name, and the keys that meet
    def live(view: str, name: str, *keys: str) -> str:
        own = [f"{c} AS {name}_{c}" for c in _all_columns(view)]
        return f"live_{view} AS (SELECT {', '.join([*own, *keys])} FROM {view} WHERE status = 1)"

    names = ", ".join(f"{name}_{c}" for view, name in (("question", "question"), ("paper_subject", "paperSubject"), ("paper", "paper"))
                      for c in _all_columns(view))
    return with_views(["question", "paper_subject", "paper"], [
        live("question", "question", "paperExamId AS exam"), live("paper_subject", "paperSubject", "id AS exam", "paperId AS sheet"),
        live("paper", "paper", "id AS sheet")],
        f"SELECT {names} FROM live_question INNER JOIN live_paper_subject USING (exam) INNER JOIN live_paper USING (sheet)")


def param_query() -> str:
    return with_views(["question", "answer"], [], """
SELECT a.stuId, a.questionId, a.questionOrder, a.answer, q.type AS questionType,
       q.score AS questionScore
FROM answer a JOIN question q ON q.id = a.questionId
WHERE a.isChoose > 0 AND q.type < 4 AND a.status = 1""")


def student_batch_load() -> str:
    cols = ", ".join(f"s.{c}" for c in _all_columns("student"))
    return with_views(["student", "batch", "paper_subject"], ["""
batches AS (SELECT DISTINCT paperId, id AS batchId FROM batch)""", """
multi AS (SELECT paperId FROM batches GROUP BY paperId HAVING COUNT(*) > 1)""", """
exams AS (SELECT DISTINCT paperId, id AS paperExamId FROM paper_subject WHERE status = 1)"""],
        f"""
SELECT {cols} FROM student s
WHERE EXISTS (SELECT 1 FROM batches b WHERE b.paperId = s.paperId AND b.batchId = s.batchId)
  AND (s.paperId NOT IN (SELECT paperId FROM multi)
       OR EXISTS (SELECT 1 FROM exams e
                  WHERE e.paperId = s.paperId AND e.paperExamId = s.paperExamId))""")


def _jhash(x: str) -> str:
    h = (f"list_reduce(list_transform(string_split(CAST({x} AS VARCHAR), ''), "
         f"lambda ch: unicode(ch)::BIGINT), lambda acc, u: (acc * 31 + u) % 4294967296, "
         f"0::BIGINT)")
    return f"(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END)"


def shard_sql(x: str, n: int) -> str:
    h = _jhash(x)
    return (f"CAST(CASE WHEN {h} = -2147483648 THEN {-(2147483648 % n)} "
            f"ELSE abs({h}) % {n} END AS INTEGER)")


def shard_id() -> str:
    return with_views(["answer"], [], f"""
SELECT questionId, stuId, questionOrder, paperId, {shard_sql('paperId', 2)} AS db_shard,
  {shard_sql('questionId', 8)} AS tb_shard FROM answer""")


def shard_set() -> str:
    return with_views(["question"], [], f"""
SELECT DISTINCT paperId, {shard_sql('paperId', 2)} AS db_shard, {shard_sql('id', 8)} AS tb_shard
FROM question WHERE type < 4""")


def shard_routed_read() -> str:
    return with_views(["answer"], [], """
SELECT * FROM answer
WHERE (questionId, paperId) = (SELECT min((questionId, paperId)) FROM answer)""")


def shard_gather() -> str:
    return with_views(["answer", "question"], [], """
SELECT * FROM answer WHERE questionId IN (SELECT id FROM question WHERE CAST(type AS INTEGER) != 4)""")


def sharded_roundtrip() -> str:
    return with_views(["answer"], [], "SELECT * FROM answer")


def colocated_join() -> str:
    return with_views(["answer", "student"], [], """
SELECT a.questionId, a.stuId, a.questionOrder, a.answer, s.stuName, s.schoolId, s.classId
FROM answer a JOIN student s ON (a.stuId = s.userId)""")


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
    "union_positional": paper_totals,
    "param_query": param_query,
    "student_batch_load": student_batch_load,
    "shard_id": shard_id,
    "shard_set": shard_set,
    "shard_routed_read": shard_routed_read,
    "shard_gather": shard_gather,
    "sharded_roundtrip": sharded_roundtrip,
    "colocated_join": colocated_join,
})


def jdbc_roundtrip() -> str:
    return with_views(["absent"], [], "SELECT * FROM absent")


QUERIES["jdbc_roundtrip"] = jdbc_roundtrip


def one_exam_with(paper: str, exam: int) -> str:
    """``WITH`` clause of the views limited to one exam (all their columns)."""
    of_exam = {"question": "paperExamId", "answer": "paperExamId", "absent": "paperExamId", "paper_subject": "id"}
    parts = [f"{name}_all AS (\n{_fx.VIEWS[name].sql()}\n)" for name in DETAIL_VIEWS]
    for name in DETAIL_VIEWS:
        where = f" WHERE paperId = '{paper}'" if name in (*of_exam, "student") else ""
        where += f" AND {of_exam[name]} = {exam}" if name in of_exam else ""
        parts.append(f"{name} AS (SELECT * FROM {name}_all{where})")
    return "WITH " + ",\n".join([*parts, *(c.strip() for c in DETAIL_CTES)])


def _job_counts(prefix: str) -> str:
    return f"""
  SELECT 'obj_score' AS tableName, count(*) AS n, sum(stuScore) AS points FROM {prefix}scores
  UNION ALL SELECT 'stu_que_detail', count(*), sum(stuScore) FROM {prefix}detail
  UNION ALL SELECT 'stu_que_score', count(*), sum(total)
    FROM (SELECT {WIDE_KEYS}, sum(stuScore) AS total FROM {prefix}detail GROUP BY {WIDE_KEYS})"""


def exam_job_runs() -> str:
    one = one_exam_with("P0", 102) + f",\nonce AS ({_job_counts('')})\nSELECT * FROM once"
    # the other exams, the answers of one without their exam's id
    rest = [f"answer_all AS (\n{_fx.VIEWS['answer'].sql()}\n)",
            *(f"{n} AS (\n{_fx.VIEWS[n].sql()}\n)" for n in DETAIL_VIEWS if n != "answer"),
            "answer AS (SELECT * REPLACE (nullif(paperExamId, 103) AS paperExamId) FROM answer_all WHERE paperExamId <> 102)",
            *(c.strip() for c in DETAIL_CTES)]
    others = "WITH " + ",\n".join(rest) + f",\nonce AS ({_job_counts('')})\nSELECT * FROM once"
    return f"""
SELECT run, tableName, n * times AS n, points * times AS points
FROM ({one}) AS own,
  (VALUES ('first', 1), ('append', 2), ('redo', 1), ('died', 1), ('finished', 1)) runs(run, times)
UNION ALL
SELECT 'others', tableName, n, points FROM ({others}) AS rest"""


QUERIES["exam_job_runs"] = exam_job_runs


def rejected_rules() -> str:
    return with_views(["question"], ["""
damaged AS (SELECT id AS questionId, CASE WHEN id % 5 = 0 THEN left(rules, length(rules) - 5)
              WHEN id % 7 = 0 THEN replace(rules, '"score":3', '"score":"three"') ELSE rules END AS rules
            FROM question WHERE type = 2)"""], """
SELECT questionId, rules, CASE WHEN json_valid(rules) THEN 'score is no number' ELSE 'unreadable' END AS reason
FROM damaged WHERE NOT json_valid(rules) OR contains(rules, '"three"')""")


def detail_catalog() -> str:
    from scorekeep.fixed_values import DETAIL_TARGET_COLUMNS
    from scorekeep.operators.detail import DETAIL_COLUMNS
    kinds = {"STRING": "VARCHAR", "INT": "INTEGER"}
    columns = [f"CAST({c} AS {kinds[t]}) AS {name}" if t in kinds else f"CAST(CAST({c} AS {t}) AS DOUBLE) AS {name}"
               for c, (name, t) in zip(DETAIL_COLUMNS, DETAIL_TARGET_COLUMNS, strict=True)]
    return with_views(DETAIL_VIEWS, DETAIL_CTES,
                      f"SELECT {', '.join(columns)}, 'decimal(12,4)' AS scoreType FROM detail")


def text_lines() -> str:
    return with_views(["question"], [], "SELECT rules AS value FROM question")


QUERIES.update({
    "multichoice_sql": score_multichoice,
    "rejected_rules": rejected_rules,
    "detail_catalog": detail_catalog,
    "text_lines": text_lines,
    "file_dump": table_scan,
    "wide_jdbc": wide_scores,
})
