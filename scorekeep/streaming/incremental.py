"""Stream-static scoring of newly arriving answer rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scorekeep.operators.scoring import score_answers
from scorekeep.sources import fixtures


def answer_stream(spark: SparkSession, source_dir: str, schema_dir: str,
                  source_table: str = "lineitem",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Answer rows from parquet files of the answer's source table that
    appear in ``source_dir``.  The file schema is fixed up front, taken from
    the table in ``schema_dir`` (a stream does not infer schemas)."""
    schema = fixtures.read_table(spark, schema_dir, source_table).schema
    reader = (spark.readStream.schema(schema)
              .option("pathGlobFilter", f"{source_table}*.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return fixtures.view_of(reader.parquet(source_dir), "answer")


def score_stream(answers: DataFrame, question: DataFrame, absent: DataFrame) -> DataFrame:
    """E1 over a streaming answer frame; the dimensions are static."""
    return score_answers(question, answers, absent)


def start_incremental_scoring(scores: DataFrame, sink_path: str, checkpoint: str,
                              available_now: bool = True) -> StreamingQuery:
    writer = (scores.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(sink_path)
