"""Customer cleaning on a streaming DataFrame.

C1 - C5 are row-wise expressions, so the batch functions apply unchanged
to a stream.  Keyed de-duplication (C6) becomes
``dropDuplicatesWithinWatermark``: the first record of each key within the
event-time watermark wins, and the state of a key is dropped once the
watermark passes it, so state stays bounded on an unbounded stream.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from baobab.operators import cleaning
from baobab.session import ensure_checkpoint_dir


def clean_customer_stream(
    stream: DataFrame,
    event_time: str,
    watermark: str = "1 day",
    key: str = "customer_id",
    as_of: str | _dt.date | None = None,
) -> DataFrame:
    """C1 -> C5 per record, then de-duplication by key within the watermark.

    Records with a NULL key are one key, as in the batch form."""
    rows = cleaning.cleaned_columns(stream, as_of=as_of)
    return rows.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([key])


def clean_drops(
    spark: SparkSession, drops: list[DataFrame], folder: str, event_time: str, watermark: str, as_of: str | _dt.date | None = None
) -> DataFrame:
    """Clean deliveries that arrive one after the other; the rows of the sink.

    Each delivery is written beside the earlier ones under ``folder`` and the job
    started anew on its checkpoint there, as after a restart: it takes up the new
    files alone, and a key that an earlier run has let through is not repeated.
    Running it once more without a delivery changes nothing."""
    source, sink, state = (f"{folder.rstrip('/')}/{x}" for x in ("deliveries", "clean", "state"))
    for drop in drops:
        drop.write.mode("append").parquet(source)
        schema = drop.schema
        job = run_clean_customer_job(
            spark, source, schema, sink, event_time, watermark, checkpoint_dir=state, source_format="parquet", as_of=as_of
        )
        job.awaitTermination()
    return spark.read.parquet(sink)


def run_clean_customer_job(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    sink_dir: str,
    event_time: str,
    watermark: str = "1 day",
    checkpoint_dir: str | None = None,
    source_format: str = "csv",
    as_of: str | _dt.date | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Incrementally clean new customer files into a parquet table.

    The query's progress (files seen, de-duplication state) lives in
    ``checkpoint_dir`` (default: ``<spark.checkpoint.dir>/clean_customers``
    on the cluster's shared storage), so a restarted job resumes where it
    stopped and the file sink commits each batch exactly once.  ``once``
    processes what is available and stops (``availableNow``).
    """
    if checkpoint_dir is None:
        checkpoint_dir = ensure_checkpoint_dir(spark).rstrip("/") + "/clean_customers"
    stream = spark.readStream.schema(schema).format(source_format).load(source_dir)
    out = clean_customer_stream(stream, event_time, watermark, as_of=as_of)
    writer = (
        out.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
