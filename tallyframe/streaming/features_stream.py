"""Incremental feature job over a folder of arriving statement files.

Filings land as Parquet files (both flags of a filing in the same file, as a
filing carries this year's and last year's figures together).  A Structured
Streaming query picks up new files; each micro-batch is an ordinary static
DataFrame, so ``foreachBatch`` runs the same plan as the batch job
(pairing -> inflation -> catalogue features) on just the new rows.

Each batch is written to its own ``batch_id=<n>`` folder with overwrite, so a
batch replayed after a failure replaces its own output instead of appending
twice; the stream's checkpoint, a folder that every start of the job names alike,
records which files were processed.  A key filed again in a later file stands in
the later batch too: readers take the row with the largest ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyframe.catalog import Catalog
from tallyframe.operators.features import available_features, compute_features
from tallyframe.plans.pipelines import paired_statements


def batch_features(batch: DataFrame, catalog: Catalog, index: DataFrame | None = None) -> DataFrame:
    """Features of one batch of flagged statements (keys with a flag-0 row)."""
    names, _ = available_features(catalog, batch.columns, need_prev=False)
    return compute_features(paired_statements(batch, catalog, names, index), catalog, names)


def start_feature_stream(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str,
                         checkpoint: str, catalog: Catalog | None = None, index: DataFrame | None = None,
                         available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental job; returns the running query (``awaitTermination()`` to wait)."""
    catalog = catalog or Catalog.default()
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = batch_features(batch, catalog, index)
        out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
