"""Paged ingest with Structured Streaming.

Pages land as JSON files (``{result: [...], nextPageId}``) in a landing
directory. A file stream reads them ``batch_bytes`` (or, if stated,
``pages_per_batch`` files) per micro-batch and ``foreachBatch`` shapes each
batch and appends it to the target table with schema alignment. Without a page
schema the fields are found in each batch, so new ones reach the table.

* Resume: the stream checkpoint records which files were consumed, so an
  interrupted run continues with the next page on restart (no state table
  to keep in step).
* Reset: a date range gets its own checkpoint folder; a new range starts fresh.
* Exactly once: rows carry the run (from the checkpoint path, one per date
  range; the table's only partition column) and the batch id. A batch is
  appended; a batch replayed after a failure between write and commit finds
  its earlier rows and rewrites just its run's partition without them, so
  it is never counted twice. Partitions grow with runs, not micro-batches.
* Quarantine: what the table cannot take goes to ``<table>_errors`` as it came,
  with run and batch id and exactly once too, and the rest loads: pages that
  are not one whole JSON object or list (or do not fit the page schema), and
  rows with a value their column cannot hold. A batch whose fields clash (names
  that differ in case alone) or whose shaping fails on its data goes there whole.
* A finished run is left with one set of files per micro-batch;
  ``compact_run`` rewrites its partition in files of even size.
* A write that fails for other reasons fails the batch; the checkpoint does
  not advance past it.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import delete_folder
from ledgerline.sinks.tables import (SchemaMismatch, align_append_once, append_errors, append_fitting,
                                     overwrite_partitions, with_corrupt_column)
from ledgerline.sources.landing import is_json, listed_items, rows_inferred, staged_check

BATCH_COLUMN = "_batch_id"
RUN_COLUMN = "_run"
PROGRESS_SECONDS = 1
#: Landed bytes per micro-batch unless the caller states another bound.
BATCH_BYTES = 1 << 30


#: Conditions by which Spark names the data, not a machine or the program, as the cause of a failure.
DATA_CONDITIONS = ("USER_RAISED_EXCEPTION", "CAST_INVALID_INPUT", "CAST_OVERFLOW", "NUMERIC_VALUE_OUT_OF_RANGE",
                   "CANNOT_PARSE_TIMESTAMP", "DATETIME_OVERFLOW", "ARITHMETIC_OVERFLOW", "DUPLICATED_MAP_KEY",
                   "COLUMN_ALREADY_EXISTS", "AMBIGUOUS_REFERENCE", "AMBIGUOUS_COLUMN_OR_FIELD", "DATATYPE_MISMATCH")


def caused_by_data(error: Exception) -> bool:
    """Whether another attempt at the same batch must fail the same way."""
    return isinstance(error, SchemaMismatch) or (
        isinstance(error, (PySparkException, Py4JJavaError)) and any(f"[{c}" in str(error) for c in DATA_CONDITIONS))


def page_stream(spark: SparkSession, landing_dir: str, pages_per_batch: int | None = None,
                batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The landed pages as a stream of text lines."""
    reader = spark.readStream
    reader = (reader.option("maxFilesPerTrigger", pages_per_batch) if pages_per_batch
              else reader.option("maxBytesPerTrigger", batch_bytes))
    return reader.text(landing_dir).filter(F.trim("value") != "")


def load_pages(pages: DataFrame, table: str, stage: str, page_schema: T.StructType | str | None = None,
               shape: Callable[[DataFrame], DataFrame] | None = None, key: str = "result",
               tags: Mapping[str, object] | None = None, may_be_replay: bool = True) -> dict:
    """Append the rows of page texts (``value``) to ``table`` and the rest to ``<table>_errors``.

    The pages are read once, into ``stage``. ``tags`` ({run column: run, batch
    column: id}) make both appends exactly once. Returns how many pages and
    rows did not fit.
    """
    spark = pages.sparkSession
    value = F.col("value")
    if page_schema is not None:
        schema = T.StructType.fromDDL(page_schema) if isinstance(page_schema, str) else page_schema
        parsed = F.from_json(value, with_corrupt_column(schema, "_corrupt"), {"columnNameOfCorruptRecord": "_corrupt"})
        checked = pages.select(value, is_json(value).alias("_whole"), parsed.alias("_page"))
        good, bad, counts = staged_check(checked, F.col("_whole") & F.col("_page._corrupt").isNull(), value,
                                         posixpath.join(stage, "pages"))
        rows = good.select(F.inline(F.col(f"_page.{key}")))
        received = good.select(value.alias("record"))
    else:
        good, bad, counts = staged_check(pages.select(value), is_json(value), value, posixpath.join(stage, "pages"))
        items = listed_items(good, key)
        received = items.select(F.col("item").alias("record"))
    misfits = 0
    try:
        if page_schema is None:
            rows = rows_inferred(items, posixpath.join(stage, "rows"))
        if rows.columns:
            wrong = append_fitting(shape(rows) if shape is not None else rows, table, tags, may_be_replay)
            misfits = wrong.n
            bad = bad if not misfits else bad.unionByName(wrong.records)
    except Exception as e:
        if not caused_by_data(e):
            raise
        misfits = received.count()
        bad = bad.unionByName(received)
    if counts["rejected"] or misfits:
        append_errors(bad, f"{table}_errors", tags, may_be_replay)
    return {"pages": counts["rejected"], "rows": misfits}


def batch_writer(table: str, shape: Callable[[DataFrame], DataFrame] | None = None, run: str = "run",
                 stage: str | None = None, page_schema: T.StructType | str | None = None):
    """The ``foreachBatch`` function: an exactly-once aligned append tagged with
    the run (one per checkpoint) and the batch id (X5). With ``stage`` the batch
    holds page texts, without it rows.

    Only the first batch a query runs after a (re)start can be a replay (a
    failed batch stops the query), so only that one is checked against the
    tables; later batches of the same query are appended directly.
    """
    started = {"first": True}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tags = {RUN_COLUMN: run, BATCH_COLUMN: batch_id}
        if stage is None:
            shaped = shape(batch) if shape is not None else batch
            align_append_once(shaped, table, RUN_COLUMN, run, BATCH_COLUMN, batch_id, may_be_replay=started["first"])
        else:
            own = posixpath.join(stage, f"{batch_id}-{uuid.uuid4().hex}")
            load_pages(batch, table, own, page_schema, shape, tags=tags, may_be_replay=started["first"])
            delete_folder(batch.sparkSession, own)
        started["first"] = False
    return write_batch


def run_key(checkpoint: str) -> str:
    """Short stable name of a checkpoint, used as the run partition value."""
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:16]


def checkpoint_for(root: str, table: str, range_key: str) -> str:
    """One checkpoint per (table, date range)."""
    return posixpath.join(root, "_checkpoints", table.replace(".", "__"), range_key)


def run_paged_ingest(spark: SparkSession, landing_dir: str, page_schema: T.StructType | str | None,
                     table: str, checkpoint: str,
                     shape: Callable[[DataFrame], DataFrame] | None = None,
                     pages_per_batch: int | None = None, batch_bytes: int = BATCH_BYTES) -> list[dict]:
    """Consume every page available now, ``batch_bytes`` (or
    ``pages_per_batch`` files) per micro-batch, and stop. Returns the per-batch
    progress (batch id, landed rows)."""
    pages = page_stream(spark, landing_dir, pages_per_batch, batch_bytes)
    query = (pages.writeStream
             .foreachBatch(batch_writer(table, shape, run_key(checkpoint), f"{checkpoint}-stage", page_schema))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    progress = {}

    def note():
        # Spark keeps only the latest entries, so they are taken while it runs
        progress.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress})

    while not query.awaitTermination(PROGRESS_SECONDS):
        note()
    note()
    if query.exception() is not None:
        raise query.exception()
    return [{"batch_id": b, "rows": n} for b, n in sorted(progress.items())]


def compact_run(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Rewrite the partition of a finished run in files of even size (one
    shuffle of that run's rows, sized by AQE; other runs are not read)."""
    mine = spark.table(table).filter(F.col(RUN_COLUMN) == F.lit(run_key(checkpoint)))
    overwrite_partitions(mine.hint("rebalance"), table)


def table_rows(spark: SparkSession, table: str) -> DataFrame:
    """The ingested rows without the bookkeeping column."""
    return spark.table(table).drop(RUN_COLUMN, BATCH_COLUMN)
