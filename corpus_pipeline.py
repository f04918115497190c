"""A corpus from documents: five stages, each written as Parquet and reread as the next one's documents.

Every stage but the last returns the columns of documents, with n_chars counted anew where it changes texts.
Decisions are taken row by row: rows with a null doc_id, and different texts that share one, are documents of their own.
Rows with the same doc_id and text (null counts as an id) are copies of one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import small_or_shuffled, written
from scorekeep.llm.language_id import known_languages
from scorekeep.llm.ngram_jaccard import ngram_jaccard_join
from scorekeep.llm.packing import pack_documents
from scorekeep.llm.personal_data import masked, personal_data
from scorekeep.llm.substring_dedup import substring_dedup

#: A document goes if its language is unknown, or the likeliest is no likelier than this.
LEAST_SCORE = 0.3
#: Rows that go to a Python worker at once.  The operators cut them into slices of some megabytes anyway; Spark's default of
#: 10,000 only keeps more texts in memory, in the executor and in its workers.
BATCH_ROWS = 2000
#: Bytes of rows that go there at once, for long texts; a batch lies in the executor's own memory and in the worker's.
BATCH_BYTES = 1_000_000


def _fresh(docs: DataFrame, name: str) -> str:
    """The name, with underscores until no column of docs has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _small_batches(spark) -> None:
    """From now on the session sends at most BATCH_ROWS rows, of about BATCH_BYTES together, to a Python worker at once."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(name).removesuffix("b")  # a unit other than bytes is a larger one
        if not now.isdecimal() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key that is the same for rows of the same doc_id and text only, and its name.

    It is the doc_id where this has one text.  Rows with a null doc_id or one of several texts get a hash of both, from 2**62 on, so
    that documents with an id of their own come first."""
    _small_batches(docs.sparkSession)
    key, several = _fresh(docs, "row_key"), _fresh(docs, "several")
    texts = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"))
    shared = written(texts.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high")
                     .select("doc_id", F.lit(True).alias(several)), "shared")
    marked = docs.join(small_or_shuffled(shared, shared.count()), "doc_id", "left")
    hashed = F.lit(2**62) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**62))
    own = F.when(F.col("doc_id").isNull() | F.coalesce(several, F.lit(False)), hashed).otherwise(F.col("doc_id").cast("long"))
    return marked.select(*docs.columns, own.alias(key)), key


def keep_known_languages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters, or that fit no language, go.

    Where there was no language to learn, all texts with letters stay."""
    _small_batches(docs.sparkSession)
    return known_languages(docs, LEAST_SCORE)


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 0.8-similar sets of 5-word shingles: the smallest doc_id (one row of it)."""
    keyed, key = _keyed(docs)
    groups = written(ngram_jaccard_join(keyed, id_col=key).select(F.col("doc_id").alias(key), "component_id"), "groups")
    gone = written(groups.where(f"{key} <> component_id").select(key).distinct(), "gone")
    repeated = written(groups.groupBy(key).count().where("count > 1").select(key), "repeated")
    gone, repeated = small_or_shuffled(gone, gone.count()), small_or_shuffled(repeated, repeated.count())
    kept = keyed.join(gone, key, "left_anti")
    again = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return kept.join(repeated, key, "left_anti").select(docs.columns).unionAll(again.select(docs.columns))


def _with_text(docs: DataFrame, text) -> DataFrame:
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))


def drop_repeated_spans(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentences of repeated spans; documents left without words go."""
    keyed, key = _keyed(docs)
    texts = substring_dedup(keyed, id_col=key, carry=[c for c in docs.columns if c != "text"]).where(r"n_removed = 0 OR text RLIKE '\\S'")
    return _with_text(texts.select("carried.*", "text"), F.col("text")).select(docs.columns)


def mask_personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind in brackets."""
    keyed, key = _keyed(docs)
    spans = _fresh(docs, "spans")
    found = (personal_data(keyed, id_col=key).where("size(spans) > 0")
             .select(F.col("doc_id").alias(key), F.col("spans").alias(spans)).dropDuplicates([key]))
    text = F.when(F.col(spans).isNotNull(), masked(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    return _with_text(keyed.join(found, key, "left"), text).select(docs.columns)


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    import public_tokenizers

    _small_batches(docs.sparkSession)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", drop_repeated_spans),
    ("personal_data", mask_personal_data),
    ("best_fit_packing", pack),
]

#: SQL can't train the classifier or run the tokenizer; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The pieces that the last stage packs from the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
