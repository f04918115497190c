"""Texts with thousands of finds, long lists of middling lengths, many unrelated vectors: against plain versions."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from scorekeep.llm import packing, personal_data
from scorekeep.llm.embedding_dedup import near_embeddings


def test_thousands_of_finds_in_a_text(spark, docs_of):
    text = " ".join(f"é{i % 3} ask p{i}@h{i % 7}.example, or 10.0.{i % 256}.{i % 99}" for i in range(3000))
    found = personal_data.personal_data(docs_of([(1, text, "en")]))
    base, hidden, plain = found.crossJoin(docs_of([(1, text, "en")]).select("text")).select(
        "base", personal_data.masked(F.col("text"), F.col("base")), personal_data._without(F.col("text"), F.col("base"))).first()
    expected = sorted([(m.start(), 0, m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
                      + [(m.start(), 1, m.end(), m[0]) for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", text)])
    assert [tuple(s) for s in base] == expected and len(base) == 6000
    assert hidden == re.sub(r"10\.0\.\d+\.\d+", "[IP]", re.sub(r"p\d+@h\d\.example", "[EMAIL]", text))
    assert plain == re.sub(r"p\d+@h\d\.example|10\.0\.\d+\.\d+", lambda m: "\n" * len(m[0]), text)


def test_overlapping_spans_share_a_replacement(spark):
    spans = [(0, 0, 4, "abcd"), (2, 3, 3, "c"), (3, 1, 6, "def"), (8, 2, 9, "i")] + [(10 + 2 * i, 0, 11 + 2 * i, "x") for i in range(600)]
    df = spark.createDataFrame([("abcdefghij" + "x " * 600, spans)], "text string, spans array<struct<start:int,kind:int,end:int,value:string>>")
    hidden, plain = df.select(personal_data.masked(F.col("text"), F.col("spans")), personal_data._without(F.col("text"), F.col("spans"))).first()
    assert hidden == "[EMAIL]gh[CARD]j" + "[EMAIL] " * 600
    assert plain == "\n" * 6 + "gh\nj" + "\n " * 600


def test_local_search_on_middling_lengths():
    r = random.Random(2000)
    lengths = [r.randint(1000, 1600) for _ in range(2000)]
    began = time.monotonic()
    bins = packing.local_search(packing.best_fit(lengths, 4096), lengths, 4096)
    assert time.monotonic() - began < 60
    assert sorted(i for b in bins for i in b) == list(range(2000)) and max(sum(lengths[i] for i in b) for b in bins) <= 4096
    assert packing.fewest(lengths, 4096) <= len(bins) <= 660  # best fit: 691


def test_fewest_is_a_bound():
    r = random.Random(3)

    def plain(left, rooms):  # the fewest bins, all ways tried
        if not left:
            return len(rooms)
        n, rest = left[0], left[1:]
        ways = [plain(rest, [*rooms, 10 - n])] + [plain(rest, [*rooms[:k], x - n, *rooms[k + 1:]]) for k, x in enumerate(rooms) if x >= n]
        return min(ways)

    assert packing.fewest([], 10) == 0
    for _ in range(40):
        lengths = [r.randint(1, 10) for _ in range(r.randint(1, 6))]
        best = plain(lengths, [])
        assert packing.fewest(lengths, 10) <= best <= len(packing.local_search(packing.best_fit(lengths, 10), lengths, 10))


def test_links_among_many_unrelated_vectors(spark):
    draw = np.random.default_rng(7)
    x = draw.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = draw.normal(size=(1000, 64))  # the first thousand have a copy, of cosine 0.98 to 0.999
    turn -= (turn * x[:1000]).sum(axis=1, keepdims=True) * x[:1000]
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = draw.uniform(0.98, 0.999, (1000, 1))
    x = np.concatenate((x, cosine * x[:1000] + np.sqrt(1 - cosine ** 2) * turn, np.repeat(x[2000:2001], 700, axis=0) + draw.normal(size=(700, 64)) * 1e-3))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    rows = [(i, 1, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in near_embeddings(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()}
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= true).all() and found.sum() >= 0.97 * true.sum()
    assert (found[:1000] >= 1).mean() >= 0.95  # planted pairs by themselves, not outweighed by the large group
    assert {got[i].component_id for i in range(4000, 4700)} == {2000}
