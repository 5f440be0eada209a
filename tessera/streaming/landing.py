"""ST1: land crawled pages in batches of 20 as a Structured Streaming job.

Files dropped into ``src`` (one page per file, named by its URL key) are
read as whole texts, at most ``batch_size`` files per micro-batch; each
micro-batch becomes one folder ``batch=<n>`` of extracted records.  The
folder is written with ``overwrite`` for its own batch id, so a retried
micro-batch replaces its output instead of duplicating it (idempotent
sink); progress lives in the streaming checkpoint, so a restarted job
resumes where it stopped.  Keys are decoded (``a%20b`` is ``a b``, as in
``scan_page_folders``) and only collide inside a folder, which is one
micro-batch: of the files of one key the one modified last is kept (of equal
times that of the last path), also when the batch is retried, so no streaming
state is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import extract as ex

BATCH_SIZE = 20


def page_records(df: DataFrame, batch_no) -> DataFrame:
    """X4 + X6 on a micro-batch of ``(value, file_path, modified)`` rows."""
    path = F.url_decode(F.regexp_replace(F.col("file_path"), r"\+", "%2B"))
    pages = (df.select(F.regexp_extract(path, r"([^/]+)\.html$", 1).alias("url_key"), "value", F.struct("modified", "file_path").alias("_age"))
             .groupBy("url_key").agg(F.max_by("value", "_age").alias("html")))
    fields = ex.extract(pages, ex.PAGE_FIELDS, keep=("url_key",))
    return fields.select(F.lit(batch_no).cast("long").alias("batch"), "url_key", "lang", "title", "h1",
                         F.size("nav_links").cast("long").alias("n_links"), "_errors")


def start_landing(spark: SparkSession, src: str, out: str, checkpoint: str,
                  batch_size: int = BATCH_SIZE, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    stream = (spark.readStream.format("text")
              .option("wholetext", True)
              .option("pathGlobFilter", "*.html")
              .option("maxFilesPerTrigger", batch_size)
              .load(src)
              .select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("modified")))

    def sink(batch_df: DataFrame, epoch_id: int) -> None:
        recs = page_records(batch_df, epoch_id + 1)
        recs.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={epoch_id + 1}")

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
