"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from scorekeep.llm import url_filter
from scorekeep.llm.byte_bpe import op13_byte_bpe
from scorekeep.llm.edit_fingerprint import op9_document_fingerprints
from scorekeep.llm.embedding_dedup import op5_embedding_dedup
from scorekeep.llm.html_text import op3_html_text
from scorekeep.llm.language_id import op4_language_id
from scorekeep.llm.ngram_jaccard import op7_ngram_jaccard
from scorekeep.llm.packing import op10_best_fit_packing
from scorekeep.llm.personal_data import op6_personal_data
from scorekeep.llm.run_detection import op12_periodic_runs
from scorekeep.llm.sentencepiece_codec import op8_sentencepiece
from scorekeep.llm.substring_dedup import op1_substring_dedup
from scorekeep.llm.token_alignment import op11_cross_tokenizer

QUERIES: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (
    op1_substring_dedup, url_filter.op2_url_filter, op3_html_text, op4_language_id, op5_embedding_dedup, op6_personal_data,
    op7_ngram_jaccard, op8_sentencepiece, op9_document_fingerprints, op10_best_fit_packing,
    op11_cross_tokenizer, op12_periodic_runs, op13_byte_bpe)}

ORACLE_SQL: dict[str, str] = {"op2_url_filter": url_filter.ORACLE_SQL}
