"""Every label is learned, or there is an error."""

import pytest

from scorekeep.llm import language_id


def test_no_label_is_left_out_silently(docs_of, monkeypatch):
    docs = docs_of([(i, f"{'abc'[i % 3] * 4} {'abc'[i % 3] * 2}", "xyz"[i % 3]) for i in range(30)])
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    assert language_id.fit(docs).languages == ["x", "y", "z"]
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 different values of lang"):
        language_id.fit(docs)
