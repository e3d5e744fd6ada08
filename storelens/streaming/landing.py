"""CSV drop folder -> cleaned landing table, as a streaming query."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from storelens.plans.ingest import clean_apps, clean_reviews
from storelens.sources.csv import normalize_header
from storelens.sources.schemas import APPS_RAW, APPS_RENAME, REVIEWS_RAW

_KINDS = {
    "apps": (APPS_RAW, APPS_RENAME, clean_apps),
    "reviews": (REVIEWS_RAW, {}, clean_reviews),
}


def stream_landing(spark: SparkSession, source_dir: str, kind: str, target_dir: str,
                   checkpoint_dir: str, available_now: bool = True,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a query that cleans every CSV file arriving in ``source_dir``
    (``kind`` = 'apps' or 'reviews') and appends the rows to Parquet files
    in ``target_dir``.  ``available_now`` processes the backlog in bounded
    batches and stops; otherwise the query keeps polling.  Both folders and
    the checkpoint must be on shared storage.  Every file's header has to hold
    the raw column names in their order: a stream can't unite files by name as
    the batch reader does, and fails on another header."""
    schema, rename, clean = _KINDS[kind]
    reader = (spark.readStream.schema(schema)
              .option("header", True).option("quote", '"').option("escape", '"')
              # a file whose header differs from the schema fails instead of
              # being read by position; the text stays as written
              .option("enforceSchema", False)
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = normalize_header(reader.csv(source_dir), rename)
    writer = (clean(raw).writeStream.format("parquet")
              .option("path", target_dir)
              .option("checkpointLocation", checkpoint_dir)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
