"""Near copies by fingerprint bands, among unrelated texts of the same bands."""

import numpy as np

from scorekeep.llm import edit_fingerprint as ef
from scorekeep.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def _flipped(draw, bits, n):
    out = bits.copy()
    out[draw.choice(ef.BITS, n, replace=False)] ^= 1
    return out


def _found(spark, rows):
    df = spark.createDataFrame([(i, np.packbits(b).tobytes().hex()) for i, b in rows], "doc_id long, fingerprint string")
    return {r.doc_id: r.component_id for r in ef.near_duplicates(df).collect()}


def test_unrelated_texts_in_a_band_hide_no_pair(spark):
    draw = np.random.default_rng(5)
    places = ef._banding.__globals__.get("_sampled", lambda: np.stack(
        [np.sort(g.choice(ef.BITS, ef.BAND_BITS, replace=False)) for g in [np.random.Generator(np.random.PCG64(11))] for _ in range(ef.BANDS)]))()
    rows, expected = [], {}
    for p in range(10):
        one = draw.integers(0, 2, ef.BITS).astype(np.uint8)
        for band in range(ef.BANDS):  # an unrelated text with a smaller id in every band
            other = draw.integers(0, 2, ef.BITS).astype(np.uint8)
            other[places[band]] = one[places[band]]
            rows.append((len(rows), other))
        rows += [(10_000 + 2 * p, one), (10_001 + 2 * p, _flipped(draw, one, 10))]
        expected[10_001 + 2 * p] = 10_000 + 2 * p
    assert _found(spark, rows) == {i: expected.get(i, i) for i, _ in rows}


def test_a_hot_value_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ef, "BLOCK", 4, raising=False)
    draw = np.random.default_rng(6)
    center = draw.integers(0, 2, ef.BITS).astype(np.uint8)
    rows = [(i, _flipped(draw, center, 20)) for i in range(60)] + [(60, 1 - center)]
    assert _found(spark, rows) == {i: 0 if i < 60 else 60 for i, _ in rows}


def test_the_query_has_components(spark):
    got = QUERIES["op9_document_fingerprints"](spark, SF_SMALL).select("doc_id", "fingerprint", "component_id").collect()
    bits = [np.unpackbits(np.frombuffer(bytes.fromhex(r.fingerprint), np.uint8)) for r in got]
    same = {r.fingerprint: min(x.doc_id for x in got if x.fingerprint == r.fingerprint) for r in got}
    assert len(bits) == len(got) and all(r.component_id <= same[r.fingerprint] for r in got)
    assert sum(r.component_id != r.doc_id for r in got) > 0
