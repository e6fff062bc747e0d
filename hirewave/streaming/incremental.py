"""Incremental silver sync as a Structured Streaming job.

"Sync only the dates not yet in silver" is what a file source stream does:
the stream's checkpoint remembers which raw files were processed.  With
``trigger(availableNow=True)`` each run processes everything new and stops.

Inside ``foreachBatch`` only the *touched dates* matter: those whole raw
partitions are re-read (a literal filter on their dates),
run through the batch job and dynamically overwritten.  Writing just the
batch rows would drop the earlier rows of a date that arrives in two
files; re-reading the whole date keeps dedup and ids per date correct.
Late files need no watermark — a late file simply redoes its date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hirewave.functions import rules
from hirewave.plans import jobs
from hirewave.session import shared_dir
from hirewave.sources import ledger, listing, partitions

P = rules.PARTITION_COLUMNS


def start_sync(spark: SparkSession, raw_root: str, raw_schema: StructType, companies: DataFrame,
               silver_root: str, checkpoint_location: str, exploded_root: str | None = None,
               available_now: bool = True, validation_root: str | None = None, tables: tuple[str, str] | None = None):
    """Start the stream; returns the StreamingQuery (caller awaits it).

    With ``validation_root`` a batch writes validation rows and its id to the
    ledger that the batch job keeps there, as its last step.  A batch that is
    replayed after that step changes nothing, and a touched date whose files
    are already synced as they are (by either of the two) is not redone.
    """
    out = jobs.Outputs(silver_root, exploded_root, validation_root, tables)

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        spark, run = batch.sparkSession, f"{checkpoint_location}#{epoch_id}"
        if out.ledger_root and ledger.has_run(spark, out.ledger_root, run):
            return
        touched = [tuple(r) for r in batch.select(*P).distinct().collect()]  # bounded by the calendar
        shared_dir(spark)
        files = listing.list_files(spark, raw_root, touched)
        states = listing.date_states(files).checkpoint()
        done = ledger.synced(spark, out.ledger_root) if out.ledger_root else None
        todo = states.select(*P) if done is None else ledger.changed_dates(states, done)
        jobs.sync_dates(spark, raw_root, files, states, todo, companies, out, run)

    stream = (spark.readStream.schema(raw_schema)
              .option("basePath", raw_root)
              .parquet(raw_root))
    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def sync_once(spark: SparkSession, raw_root: str, raw_schema: StructType, companies: DataFrame,
              silver_root: str, checkpoint_location: str, exploded_root: str | None = None,
              validation_root: str | None = None, tables: tuple[str, str] | None = None) -> DataFrame:
    """Process what is new and stop; the unexploded table."""
    q = start_sync(spark, raw_root, raw_schema, companies, silver_root, checkpoint_location, exploded_root,
                   validation_root=validation_root, tables=tables)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.table(tables[0]) if tables else partitions.read_partitioned(spark, silver_root)
