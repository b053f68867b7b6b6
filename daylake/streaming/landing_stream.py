"""Load days as their parts land: Structured Streaming file source + ``foreachBatch``.

The reference has no stream; its only late-data mechanism is reloading the
last N days.  This is the same batch operator (``load_days``) driven by file
arrival instead of a schedule: each micro-batch names the days that got new
part files and those days are loaded again in full (a day load is an
idempotent replace, so a day whose parts arrive over several batches ends up
complete).  The stream's progress lives in a checkpoint folder below the
shared root, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.plans.load import load_days
from daylake.sources.catalog import Catalog
from daylake.sources.landing import source_dir

DAY = "load_date"


def start_landing_stream(spark: SparkSession, lake: str, landing: str, catalog: Catalog,
                         source: str, checkpoint: str, *, available_now: bool = True,
                         processing_time: str = "1 minute"):
    """Start the stream; returns the ``StreamingQuery``.

    ``available_now=True`` processes every file that has landed and stops
    (a run-once trigger for a scheduler); otherwise it polls every
    ``processing_time``.
    """
    # A row per file, of which only the folder's day is asked: no file is opened.
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
                           T.StructField(DAY, T.DateType())])
    arrivals = (spark.readStream.format("binaryFile").schema(schema)
                .load(source_dir(landing, source)).select(DAY).where(F.col(DAY).isNotNull()))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # One row per landed day of this batch (bounded by the days that got files).
        days = [str(r[DAY]) for r in batch.select(DAY).distinct().collect()]
        if days:
            run = f"stream-{source}-{batch_id}-{uuid.uuid4().hex[:8]}"
            report = load_days(spark, lake, landing, catalog, source, days, run_id=run)
            failed = report.where("status <> 'loaded'").select(F.col(DAY).cast("string"), "error").limit(5).collect()
            if failed:
                # The batch is not committed: the stream stops here and tries these days again when it is started again.
                raise RuntimeError("; ".join(f"{source} {day}: {error}" for day, error in failed))

    writer = arrivals.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()
