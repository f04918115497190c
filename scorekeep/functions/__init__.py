"""Column functions: every one is a built-in Spark expression, so it stays
inside whole-stage code generation and needs no Python worker."""

from scorekeep.functions.answers import display_answer, normalize_answer
from scorekeep.functions.audit import with_audit_columns
from scorekeep.functions.rules import answer_key, rule_maps
from scorekeep.functions.shardhash import java_string_hash, shard_index
from scorekeep.functions.violation import fix_violation, float_sum

__all__ = [
    "answer_key", "display_answer", "fix_violation", "float_sum", "java_string_hash",
    "normalize_answer", "rule_maps", "shard_index", "with_audit_columns",
]
