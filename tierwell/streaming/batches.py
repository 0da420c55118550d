"""Staging exports arriving as files, loaded with Structured Streaming.

The original warehouse loads each export batch with a script run. Here a file stream
over the staging folder hands every micro-batch to ``foreachBatch``, which
runs the same history load (gate, rejects, touched-keys-only merge) and
writes the next ODS snapshot. The load clock of a micro-batch is a function
of its epoch id, so a micro-batch that is replayed after a failure stamps the
same ``effective_from`` and the version dedupe makes the replay a no-op; its
rejects lie under the epoch's name and are replaced. The effect is exactly
once for both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import gate, history
from ..sources.store import SnapshotStore, write_batch
from ..specs import EntitySpec


def load_stream(spark: SparkSession, staging_path: str, spec: EntitySpec, store: SnapshotStore,
                clock: Callable[[int], str], checkpoint_location: str, fmt: str = "parquet",
                available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery`` (call ``awaitTermination``)."""
    def each(batch: DataFrame, epoch_id: int) -> None:
        load_epoch(batch, epoch_id, spec, store, clock)

    reader = spark.readStream.schema(spec.schema).format(fmt).load(staging_path)
    writer = (reader.writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def load_epoch(batch: DataFrame, epoch_id: int, spec: EntitySpec, store: SnapshotStore,
               clock: Callable[[int], str]) -> None:
    """Load one micro-batch; loading it again changes nothing."""
    table = f"ods_{spec.name}"
    batch = batch.select(*spec.columns)
    current = store.read(table)
    base = current if current is not None else history.empty_ods(batch.sparkSession, spec)
    write_batch(gate.rejected_rows(batch, spec.required), store.base,
                f"rejected_stg_{spec.name}", f"epoch-{epoch_id}")
    new = history.load_history(base, batch, spec, clock(epoch_id),
                               touched_only=current is not None)
    store.write(table, new)
