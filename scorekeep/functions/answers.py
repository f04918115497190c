"""Answer text handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_answer(col) -> Column:
    """Canonical form of a choice answer, used as the rule-lookup key.

    Only an answer that contains a comma is rewritten: it is lower-cased,
    split on commas, the parts sorted and concatenated (``C,A`` -> ``ac``).
    Anything else is returned unchanged, case included (``AC`` stays ``AC``).
    Parts are not trimmed or de-duplicated (``A, B`` -> `` ba``).  Empty parts
    vanish in the concatenation, so keeping or dropping trailing empties gives
    the same key.
    """
    c = _c(col)
    parts = F.sort_array(F.split(F.lower(c), ",", -1))
    return F.when(c.contains(","), F.array_join(parts, "")).otherwise(c)


def display_answer(answer="answer", fix_answer="fixAnswer", is_dubious="isDubious",
                   dubious_type="dubiousType") -> Column:
    """Answer shown to users: the corrected answer when the row is flagged
    dubious with a positive dubious type, else the raw answer.  Scoring always
    uses the raw answer."""
    return (F.when((_c(is_dubious) == 1) & (_c(dubious_type) > 0), _c(fix_answer))
            .otherwise(_c(answer)))
