"""Unseen identifiers, against rules of their own."""

from pyspark.sql import functions as F

from scorekeep.llm import personal_data

PLACES = ["call aaa now", "mail bbb today", "ask ccc there", "write ddd soon", "reach eee here", "tell fff please"]


def _spans(df):
    return {r.doc_id: r.spans for r in personal_data.personal_data(df).select("doc_id", personal_data._listed(F.col("spans")).alias("spans")).collect()}


def test_a_value_in_many_sure_patterns_is_found(docs_of):
    rows = [(100 * p + i, f"{before} u{p}x{i}@mail.org {after}") for p, (before, after) in enumerate(x.rsplit(" ", 1) for x in PLACES) for i in range(100)]
    hot = "user99(at)mail.org"
    rows += [(1000 + p, f"{before} {hot} {after}") for p, (before, after) in enumerate(x.rsplit(" ", 1) for x in PLACES)]
    found = _spans(docs_of(rows))
    for doc_id, text in rows[-len(PLACES):]:
        at = text.index(hot)
        assert found[doc_id] == f"email:{at}:{at + len(hot)}"


def test_addresses_without_digits_and_numbers_beside_seeds_are_found(docs_of):
    rows = [(i, f"please write to user{i}@mail.example.com today") for i in range(40)]
    rows += [(100, "please write to anna(at)mail.example.org today"), (101, "please write to jane@localhost today")]
    rows += [(200 + i, f"host 10.0.0.{i} +1 555 123 4{i:03d} now") for i in range(40)]
    rows += [(300, "host 161.17.88.162 555-0142 now")]
    found = _spans(docs_of(rows))
    assert (found[100], found[101], found[300]) == ("email:16:40", "email:16:30", "ip:5:18,phone:19:27")
