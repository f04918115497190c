"""Near copies by fingerprint: what is written between the steps."""

from scorekeep.llm import edit_fingerprint as ef


def test_fingerprints_are_met_as_bytes(spark, monkeypatch):
    seen, write = {}, ef.written

    def noted(df, what):
        seen[what] = dict(df.dtypes)
        return write(df, what)

    monkeypatch.setattr(ef, "written", noted)
    one, other = "0f" * (ef.BITS // 8), "f3" * (ef.BITS // 8)
    rows = [(1, one, "a"), (2, one, "b"), (2, one, "c"), (3, other, None), (4, "00" * (ef.BITS // 8), "d"), (None, one, "e"), (5, None, "f")]
    got = ef.near_duplicates(spark.createDataFrame(rows, "doc_id long, fingerprint string, bits string")).collect()
    assert sorted(((r.doc_id or 0), r.bits or "", r.component_id) for r in got) == [
        (0, "e", None), (1, "a", 1), (2, "b", 1), (2, "c", 1), (3, "", 3), (4, "d", 4), (5, "f", 5)]
    assert seen["nodes"]["bits"] == seen["components"]["bits"] == "binary"
    assert all("string" not in types.values() for types in seen.values())
