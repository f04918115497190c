"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features are the 1- to 3-grams of characters of the lower-cased text, hashed to DIM places.  A text's weights
are (1 + log count) * idf, scaled to length 1; idf comes from all training documents.  The weights are learned
by follow-the-regularised-leader (FTRL-proximal) with L1 and L2 penalties from a bounded sample of labelled
rows (SAMPLE a language at most), and a temperature fitted on a held-back part of the sample
calibrates the scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import over_slices, released
from scorekeep.llm.words import U, mix

DIM = 1 << 15
ORDERS = 3
#: Labelled rows of a language that the classifier is fitted on, and languages learned, at most.
SAMPLE = 400
LANGUAGES = 200
PASSES = 5
#: FTRL-proximal: learning rate, its offset, and the penalties.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.05
UNKNOWN = "und"
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return text is not None and any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and how often each occurs."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    grams, total = [], np.zeros(len(codes), U)
    for n in range(1, ORDERS + 1):
        total = total[: len(codes) - n + 1] * U(0x100000001B3) + codes[n - 1:]
        grams.append((total * U(0x9E3779B97F4A7C15) + U(n * 0xC2B2AE3D27D4EB4F % 2**64)) >> U(49))
    count = np.bincount(np.concatenate(grams).astype(np.int64), minlength=DIM)
    found = np.flatnonzero(count)
    return found, count[found]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIM x languages, float32
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        x = (1 + np.log(count)) * self.idf[found]
        return x / max(float(np.sqrt(x @ x)), 1e-12)

    def logits(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.vector(found, count) @ self.weights[found] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        z = self.logits(*gram_counts(text)) / self.temperature
        p = np.exp(z - z.max())
        k = int(p.argmax())
        return self.languages[k], float(p[k] / p.sum())


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: how many texts have each feature, and how many texts there are."""
    seen, n = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            seen[gram_counts(text.as_py())[0]] += 1
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1)), pa.array(np.append(seen, n))], names=["feature", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [gram_counts(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("draw"), pa.array([r[0].astype(np.uint16).tobytes() for r in rows], pa.binary()),
             pa.array([r[1].astype(np.uint32).tobytes() for r in rows], pa.binary())],
            names=["lang", "draw", "found", "count"])


def _ftrl(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """Fit weights and bias; a weight whose gradient sum stays within the L1 penalty is zero."""
    k = len(model.languages)
    z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))  # the last row is the bias

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    draw = np.random.Generator(np.random.PCG64(7))
    for _ in range(PASSES):
        for i in draw.permutation(len(rows)):
            label, found, count = rows[i]
            at = np.append(found, DIM)
            x = np.append(model.vector(found, count), 1.0)
            w = weights(z[at], n[at])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p[None, :]
            square = g * g
            z[at] += g - (np.sqrt(n[at] + square) - np.sqrt(n[at])) / ALPHA * w
            n[at] += square
    w = weights(z, n)
    model.weights, model.bias = w[:DIM].astype(np.float32), w[DIM]


def _calibrate(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """The temperature under which the held-back rows are likeliest."""
    if not rows:
        return
    z = np.stack([model.logits(f, c) for _, f, c in rows])
    label = np.array([y for y, _, _ in rows])

    def loss(t: float) -> float:
        s = z / t
        s -= s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), label]))

    grid = np.exp(np.linspace(np.log(1e-3), np.log(20), 200))
    model.temperature = float(grid[int(np.argmin([loss(t) for t in grid]))])


def fit(labelled: DataFrame) -> Model:
    """Learn from rows doc_id, text, lang; rows with a null id, text or lang or a text without letters are left out.

    The sample takes of each language the share of rows, picked by a hash of the id, that gives about SAMPLE;
    every language is learned.  More than LANGUAGES of them are an error, since each takes DIM weights of the driver.
    """
    rows = labelled.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    shares = rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(shares) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different values of lang to learn from")
    languages = sorted(r["lang"] for r in shares)
    if not languages:
        return Model([], np.zeros(DIM), np.zeros((DIM, 0), np.float32), np.zeros(0))
    sums = np.zeros(DIM + 1)
    for r in rows.select("text").mapInArrow(released(_document_frequencies), "feature long, n long").groupBy("feature").agg(
            F.sum("n").alias("n")).collect():
        sums[r["feature"]] = r["n"]
    idf = np.log((1 + sums[DIM]) / (1 + sums[:DIM])) + 1
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
    share = F.create_map(*[F.lit(x) for r in shares for x in (r["lang"], SAMPLE / r["count"])])
    sample = (rows.select("text", "lang", draw.alias("draw")).where(F.col("draw") < share[F.col("lang")])
              .mapInArrow(released(_features), "lang string, draw double, found binary, count binary").collect())
    place = {lang: i for i, lang in enumerate(languages)}
    sample = sorted(sample, key=lambda r: (r["lang"], r["draw"], r["found"]))
    data = [(place[r["lang"]], np.frombuffer(r["found"], np.uint16).astype(np.int64), np.frombuffer(r["count"], np.uint32).astype(float))
            for r in sample]
    model = Model(languages, idf, np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages)))
    _ftrl(model, [r for i, r in enumerate(data) if i % 5] or data)
    _calibrate(model, [r for i, r in enumerate(data) if not i % 5])
    return model


def _predicting(model: Model):
    def predict(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [model.predict(t) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("held_out"), pa.array([g[0] for g in got], pa.string()),
             pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return over_slices(predict)


def held_out(doc_id: Column | str) -> Column:
    """Documents kept from learning: crc32 of the id as text leaves 2 on division by 4 (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _keeping(model: Model, least: float, text_col: str):
    def told(text: str | None) -> bool:
        lang, score = model.predict(text)
        return score == 0 if lang == UNKNOWN else score > least  # und may be a label

    def keep(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield part.filter(pa.array([told(t) for t in part.column(text_col).to_pylist()], pa.bool_()))

    return over_slices(keep, text_col)


def _learned(documents: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[DataFrame, Model]:
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                            F.col(lang_col).cast("string").alias("lang")).withColumn("held_out", held_out("doc_id"))
    return docs, fit(docs.where(~F.col("held_out")))


def known_languages(documents: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows of documents whose language is told with a probability over `least`, all columns as they are.

    Learns as identify_languages does; each row is judged by its own text, whatever its id.  Texts that are null or
    have no letter go, also where there was nothing to learn from; then all other rows stay.
    """
    _, model = _learned(documents, id_col, text_col, lang_col)
    lettered = documents.where(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    return lettered.mapInArrow(_keeping(model, least, text_col), documents.schema)


def identify_languages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score (probability of lang_pred) of every row.

    Learns from the rows that are not held out.  Text alone decides a prediction: equal texts get equal ones.
    A null text, or one without a letter, is `und` with score 0, as is every row when there is nothing
    to learn from.
    """
    docs, model = _learned(documents, id_col, text_col, lang_col)
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _predicting(model), "doc_id long, held_out boolean, lang_pred string, score double")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return identify_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
