"""Codes, names and formats whose values must equal the
original job's for the results to be right.  They are stated here once,
in plain text, and imported everywhere else."""

# Fixed values ---------------------------------------------------------------

# Question type codes: 1, 2 and 3 are objective (machine-marked), 4 is subjective.
OBJECTIVE_TYPES = (1, 2, 3)
MULTI_CHOICE_TYPE = 2            # objective, scored by the question's answer rules
SUBJECTIVE_TYPE = 4

# Row states and flags.
LIVE_STATUS = 1                  # status = 1 marks a live row
VIOLATION_DUBIOUS_TYPE = 4       # dubiousType = 4 marks misconduct
COMPOSITE_FLAG = 1               # isComprehensive = 1: a composite exam with its own total row
COMPOSITE_SHORT_NAME = "ZH"      # short name of a composite exam's own total row

# Default misconduct rule: (rule type, amount); rule type 2 zeroes the total,
# 3 deducts the amount (not below 0), any other keeps the total.
DEFAULT_VIOLATION_RULE = (3, 1.0)

# Answer rules: JSON array of {"type": ..., "values": [{"name": ..., "score": ...}]};
# only entries whose type equals this word, ignoring case, are used.
RULE_GROUP_TYPE = "group"

# Pivot formats: position cells are named "c" + position; the type pivot
# uses the text values "1".."4".
POSITION_PREFIX = "c"
TYPE_PIVOT_VALUES = ["1", "2", "3", "4"]

# JDBC reads fetch this many rows per round trip by default.
DEFAULT_FETCH_SIZE = 1000

# Shard layout of the answer tables: databases by paperId, tables by questionId.
SHARD_DATABASES = 2
SHARD_TABLES = 256

# The student-question detail target table: 41 columns by position
# (names as in the target, scores as decimal(12,4)).
DETAIL_TARGET_COLUMNS = [
    ("paperId", "STRING"), ("paperName", "STRING"), ("paperExamId", "STRING"),
    ("paperExamName", "STRING"), ("stuId", "STRING"), ("stuSeq", "STRING"),
    ("ABFlag", "INT"), ("isChoose", "INT"), ("isDubious", "INT"), ("dubiousType", "INT"),
    ("stuAnswer", "STRING"), ("standardAnswer", "STRING"), ("questionId", "STRING"),
    ("questionNo", "STRING"), ("questionOrder", "INT"), ("questionType", "INT"),
    ("score", "DECIMAL(12,4)"), ("stuScore", "DECIMAL(12,4)"), ("difficulty", "STRING"),
    ("pos", "STRING"), ("subjectId", "STRING"), ("subjectName", "STRING"),
    ("subjectShortName", "STRING"), ("userName", "STRING"), ("cityId", "STRING"),
    ("cityName", "STRING"), ("areaId", "STRING"), ("areaName", "STRING"),
    ("schoolId", "STRING"), ("schoolName", "STRING"), ("gradeId", "STRING"),
    ("gradeName", "STRING"), ("classId", "STRING"), ("className", "STRING"),
    ("studentType", "INT"), ("WLType", "INT"), ("objTotal", "DECIMAL(12,4)"),
    ("subTotal", "DECIMAL(12,4)"), ("paperTotal", "DECIMAL(12,4)"),
    ("questionKnowledges", "STRING"), ("isComprehensiveSubject", "INT"),
]
