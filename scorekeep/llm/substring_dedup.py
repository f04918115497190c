"""Substring dedup over sliding spans of sentences.

A sentence ends after a word that closes with . ! or ? (further marks may follow) or at a line break; one of
more than LONG words is also cut after words that a hash of the word picks, so that text without full stops
has boundaries that depend on nothing but the words themselves.  From every sentence starts one span: the
next SENTENCES sentences, and as many more as it takes to have WORDS words.  Besides, every sentence is cut into
pieces before the word with the smallest hash of each WINDOW words, and from every piece starts a span of
the pieces that it takes to have PIECE_WORDS words; so each repeated passage of over 50 words holds a whole span,
wherever it lies.  Spans are hashed and met globally; a span that some smaller doc_id has, or that stands further left in the same document, is not the
first, and its words go.  Every removed word stays at its first place, since the first of all
spans that hold it is never removed as that span.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scorekeep.llm.common import SMALL, over_slices, written
from scorekeep.llm.words import BASE, U, Words, mix, powers, raw_bytes, scan

SENTENCES = 3
WORDS = 12
LONG = 20
#: Words of a window, and least words of a span of pieces.  Windows that lie in a passage pick the same words in
#: every text, so all of its words but WINDOW - 1 on either side are picked alike: of 51 words, one of 7 to 14
#: begins a span that ends, PIECE_WORDS words on, by a picked word of 36 to 43 at the latest.
WINDOW = 8
PIECE_WORDS = 22
#: long_words from which on no sentence is cut.
UNCUT = 10**9


def _sentence_starts(words: Words, long_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the words that begin a sentence, and of those that begin a piece, over all texts of the batch."""
    data, n = words.data, len(words.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(data))
    stops = (data == 46) | (data == 33) | (data == 63)
    letters = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    last_stop, last_letter = (np.maximum.accumulate(np.where(x, at, -1))[words.end - 1] for x in (stops, letters))
    closes = (last_stop >= words.start) & (last_stop > last_letter)
    lines = np.cumsum(data == 10)
    closes[:-1] |= lines[words.start[1:]] > lines[words.end[:-1] - 1]
    begins = np.concatenate(([True], closes[:-1]))
    begins[words.first[:-1][words.first[:-1] < n]] = True
    pieces = begins | _smallest(words.hash, begins)
    starts = np.flatnonzero(begins)
    long = np.repeat(np.diff(np.append(starts, n)) > long_words, np.diff(np.append(starts, n)))
    begins[1:] |= (long & (words.hash % U(8) == 0))[:-1]
    return np.flatnonzero(begins), np.flatnonzero(pieces) if long_words < UNCUT else np.zeros(0, np.int64)


def _smallest(hashed: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Words with the smallest hash of WINDOW words in a row of one sentence."""
    n, out = len(hashed) - WINDOW + 1, np.zeros(len(hashed), bool)
    if n < 1:
        return out
    low, at = hashed[:n].copy(), np.arange(n)
    for d in range(1, WINDOW):
        less = hashed[d:n + d] < low
        low[less] = hashed[d:n + d][less]
        at[less] = np.flatnonzero(less) + d
    sentence = np.cumsum(begins)
    out[at[sentence[:n] == sentence[WINDOW - 1:]]] = True
    return out


def spans(words: Words, sentences: int, least_words: int, long_words: int) -> tuple[np.ndarray, ...]:
    """Sentence starts (as word indices), and of every span the first word, the exclusive end and the hash, in
    the order of words."""
    n = len(words.start)
    starts, pieces = _sentence_starts(words, long_words)

    def ended(starts: np.ndarray, count: int, least: int) -> np.ndarray:
        first = np.searchsorted(starts, words.first)
        text_end = np.repeat(first[1:], np.diff(first))
        ends = np.append(starts, n)
        stop = np.maximum(np.arange(len(starts)) + count, np.searchsorted(ends, starts + least))
        fits = stop <= text_end
        return starts[fits] * (n + 1) + ends[stop[fits]]

    # a span of sentences may be one of pieces, too
    both = np.unique(np.concatenate((ended(starts, sentences, least_words), ended(pieces, 1, PIECE_WORDS))))
    begin, end = both // (n + 1), both % (n + 1)
    # a polynomial of the words' hashes, from prefix sums; the power of the first word is divided out
    power = powers(n + 1)
    total = np.concatenate((np.zeros(1, U), np.cumsum(words.hash * power[:n])))
    back = powers(n + 1, pow(BASE, -1, 2**64))[begin]
    return starts, begin, end, mix((total[end] - total[begin]) * back + (end - begin).astype(U))


def _listing(*sizes: int):
    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = scan(part.column("text"))
        _, begin, _, hashed = spans(words, *sizes)
        text = np.searchsorted(words.first, begin, "right") - 1
        ids = part.column("doc_id").take(pa.array(text))
        yield pa.RecordBatch.from_arrays([pa.array(hashed.view(np.int64)), ids], names=["span", "doc_id"])

    return over_slices(rows, most=SMALL)


def _removal(*sizes: int):
    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = scan(part.column("text"))
        raw, edge = raw_bytes(part.column("text"))
        starts, begin, end, hashed = spans(words, *sizes)
        hashed = hashed.view(np.int64)
        of_span, of_start = np.searchsorted(begin, words.first), np.searchsorted(starts, words.first)
        texts, counts, gone = [], [], []
        for i, repeats in enumerate(part.column("repeats").to_pylist()):
            a, b, word, stop = of_span[i], of_span[i + 1], words.first[i], words.first[i + 1]
            own = hashed[a:b]
            bad = np.ones(b - a, bool)
            _, earliest = np.unique(own, return_index=True)
            bad[earliest] = False
            if repeats:
                bad |= np.isin(own, np.array(repeats, np.int64))
            counts.append(int(of_start[i + 1] - of_start[i]))
            if not bad.any():
                gone.append(0)
                texts.append(part.column("text")[i].as_py())
                continue
            step = np.zeros(stop - word + 1, np.int64)
            np.add.at(step, begin[a:b][bad] - word, 1)
            np.add.at(step, end[a:b][bad] - word, -1)
            cover = np.cumsum(step[:-1]) > 0
            gone.append(int(np.logical_or.reduceat(cover, starts[of_start[i]:of_start[i + 1]] - word).sum()))
            cut = np.append(words.start[word:stop], edge[i + 1])
            cut[0] = edge[i]
            turns = np.flatnonzero(np.diff(np.concatenate(([True], cover, [True])).astype(np.int8)))
            texts.append(b"".join(raw[cut[j]:cut[k]].tobytes() for j, k in zip(turns[::2], turns[1::2], strict=True)).decode("utf-8", "replace"))
        table = part.drop_columns(["repeats", "text"]) if part.num_columns > 2 else None
        columns = [] if table is None else table.columns
        names = [] if table is None else table.schema.names
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
            names=[*names, "text", "n_sentences", "n_removed"])

    return over_slices(rows, most=SMALL)


def substring_dedup(documents: DataFrame, sentences: int = SENTENCES, least_words: int = WORDS, long_words: int = LONG,
                    id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Remove words that a repeated span covers, but for the span's first place.

    Returns doc_id, text (without the removed words), n_sentences and n_removed (sentences removed in whole or in
    part), one row per row of documents.  First is the smallest doc_id, then the leftmost place.  Sentences are compared by their words
    (A-Z lower-cased, any ASCII white space).  Texts that are null stay null; empty ones and those of too few
    sentences and words have no span and stay as they are.  Rows with a null id keep what other documents
    repeat (they are compared only within themselves).  Rows that share an id count as one document: spans are
    not removed for being in another of them.  Columns other than id and text are not read, but for those of
    carry, which come back in a struct `carried`.
    """
    carried = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried")] if carry else []
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), *carried, F.col(text_col).alias("text"))
    listed = (docs.select("doc_id", "text").where("doc_id is not null")
              .mapInArrow(_listing(sentences, least_words, long_words), "span long, doc_id long"))
    # partial sums meet a hot span in every task before the shuffle
    shared = written(listed.groupBy("span").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("most"))
                     .where("keeper < most").select("span", "keeper"), "spans")
    repeats = written(listed.join(shared, "span").where("doc_id <> keeper").groupBy("doc_id")
                      .agg(F.collect_set("span").alias("repeats")), "repeats")
    schema = StructType([*docs.schema.fields]).add("n_sentences", "long").add("n_removed", "long")
    return docs.join(repeats, "doc_id", "left").select(*docs.columns, "repeats").mapInArrow(
        _removal(sentences, least_words, long_words), schema)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without sentences of repeated spans."""
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
