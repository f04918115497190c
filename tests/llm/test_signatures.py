"""Signatures of the n-gram join: packed where they are made, hot ones left out there or by a join."""

import pytest

from scorekeep.llm import ngram_jaccard as nj
from tests.llm.conftest import words


def _members(docs):
    classes = docs.mapInArrow(nj._classifier(3, 80), "doc_id long, n_shingles long, node long, sketch binary, signatures array<long>")
    return nj._members(docs.select("doc_id", "text"), classes, 3, 80)


def test_signing_and_packing_take_one_worker(spark, docs_of):
    plan = _members(docs_of([(1, "a b c d"), (2, "e f g")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2  # of the texts, and of the packed rows


@pytest.mark.parametrize("sent", [0, 1000])
def test_hot_signatures_are_met_apart(spark, docs_of, monkeypatch, sent):
    base = [words(seed, 40) for seed in range(4)]
    docs = docs_of([(i, " ".join([*base[i % 4], f"end{i}"])) for i in range(40)] + [(None, "x y z"), (99, None)])

    def found():
        return {(r.node, r.center, r.n, r.signature if r.signature >= 0 else 0) for r in _members(docs).select("node", "center", "n", "signature").collect()}

    plain = {(node, center, n) for node, center, n, _ in found()}
    monkeypatch.setattr(nj, "HOT", 5)
    monkeypatch.setattr(nj, "CLASSES", 1)
    monkeypatch.setattr(nj, "HOT_SENT", sent)
    crowded = found()
    assert {(node, center, n) for node, center, n, _ in crowded} == plain
    assert all(n <= 5 for _, _, n, signature in crowded if signature)
