"""Loading and rewriting catalog tables (parquet).

Rules that keep rewrites safe on parquet tables:

* A table is never overwritten in place. Rewrites write fresh folders, to
  which the catalog is then pointed (``storage``): a failed job leaves the old
  table untouched, readers see the old or the new files, and what a crash cuts
  short is finished by the next call that looks the table up (``exists``).
* Loads are lossless (``conform``): a value that the target column cannot hold
  exactly fails the load or, with ``evolve``, widens the column; an unknown
  column fails or is added; a missing one becomes null.
* Slice rewrites (a day, a key) write the slice once, straight into the files
  its partitions are then pointed to; the rest of the table is neither read
  nor written. Partitions that the new slice lacks are dropped.
* The layout of a table (partition and clustering columns) survives rewrites.
"""

from __future__ import annotations

import math
import posixpath
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.errors import SchemaMismatch
from ledgerline.operators.relational import kept, will_broadcast
from ledgerline.session import counted, scratch
from ledgerline.sinks import storage as S
from ledgerline.sinks.storage import partition_columns
from ledgerline.sources.landing import is_json, staged_check

WRITE_MODES = ("overwrite", "append", "empty")


class TableNotEmpty(RuntimeError):
    """Raised by mode ``empty`` when the target already holds rows."""


class TooManyBadRecords(RuntimeError):
    """Raised when a load holds more malformed records than its cap."""


LOAD_ERRORS = (PySparkException, Py4JJavaError, TableNotEmpty, SchemaMismatch)


def _spark(df_or_spark) -> SparkSession:
    return df_or_spark if isinstance(df_or_spark, SparkSession) else df_or_spark.sparkSession


def exists(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` is there, after finishing a rewrite that a crash cut short."""
    return S.settle(spark, table)


def cluster_columns(spark: SparkSession, table: str) -> list[str]:
    found = S.properties(spark, table).get(S.CLUSTER_PROPERTY)
    return found.split(",") if found else []


def drop_table(spark: SparkSession, table: str) -> None:
    """The table and what is left of rewrites of it; it stays dropped."""
    S.drop(spark, table)


def gathered(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of a partition brought to few tasks, so that it gets few files instead of one from
    every task; AQE splits a large partition over tasks and joins small ones in one."""
    return df.hint("rebalance", *parts) if parts else df


#: A task that loads stored rows unshuffled has about so many bytes for each partition's file.
FILE_BYTES = 4 << 20


def _by_splits(df: DataFrame, parts: Sequence[str]) -> DataFrame | None:
    """Stored rows (a scan, nothing else) that are so many beside their partitions that a task which
    reads some splits fills a file of each: gathering them would give no fewer files. None for others."""
    spark, plan = _spark(df), df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    size, least = int(plan.stats().sizeInBytes()), max(2, spark.sparkContext.defaultParallelism)
    # an unpruned partitioned table has no size
    if plan.nodeName() != "LogicalRelation" or not least * FILE_BYTES <= size < 1 << 60:
        return None
    tasks = size // (FILE_BYTES * max(1, df.select(*[f"`{c}`" for c in parts]).distinct().count()))
    return df.coalesce(tasks) if tasks >= least else None


def _laid_out(df: DataFrame, partition_by: Sequence[str] | None, cluster_by: Sequence[str] | None) -> DataFrame:
    """K7: rows in ranges of the clustering columns (within partitions, if there are any), so
    files hold narrow ranges and a filter on these columns skips most of them. Ranges are cut
    by sampling; a range with many rows of one value is split by the columns that follow."""
    if not cluster_by:
        spread = _by_splits(df, partition_by) if partition_by else None
        return gathered(df, partition_by or ()) if spread is None else spread
    order = [*(partition_by or ()), *cluster_by]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _create(df: DataFrame, table: str, partition_by: Sequence[str] | None,
            cluster_by: Sequence[str] | None, files: str | None = None, laid_out: bool = False) -> None:
    rows = df if laid_out else _laid_out(df, partition_by, cluster_by)
    S.create(rows, table, partition_by, cluster_by, files)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] | None = None,
                  cluster_by: Sequence[str] | None = None, laid_out: bool = False) -> None:
    """K8: create or replace ``table`` with ``df`` (which may read ``table``).

    The result is written to a fresh folder first; only after that job has
    succeeded is the catalog pointed to it. ``laid_out``: the rows come in the
    table's own order of partitions, as a scan of it gives them, and need no
    gathering.
    """
    spark = _spark(df)
    if not exists(spark, table):
        _create(df, table, partition_by, cluster_by)
        return
    parts, clusters = partition_columns(spark, table), cluster_columns(spark, table)
    partition_by = parts if partition_by is None else list(partition_by)
    cluster_by = [c for c in (clusters if cluster_by is None else cluster_by) if c in df.columns]
    old = spark.table(table).schema
    new = {f.name: f.dataType for f in df.schema.fields}
    same = new == {f.name: f.dataType for f in old.fields}
    rows = df.select(*[f"`{n}`" for n in old.names]) if same else df
    if not (laid_out and same and partition_by == parts and not cluster_by):
        rows = _laid_out(rows, partition_by, cluster_by)
    if not same or partition_by != parts or cluster_by != clusters:
        S.succeed(rows, table, partition_by, cluster_by)
        return
    _switched([rows], table, parts)


def _switched(pieces: Iterable[DataFrame], table: str, parts: Sequence[str]) -> None:
    """Point ``table`` to the rows of all ``pieces``, which are written one after the other."""
    spark = None
    for rows in pieces:
        if spark is None:
            spark = _spark(rows)
            folder = S.fresh(S.adopt(spark, table))
        writer = rows.write.mode("append")
        (writer.partitionBy(*parts) if parts else writer).parquet(folder)
    if parts:
        S.switch_partitions(spark, table, folder, {})
    else:
        S.switch_table(spark, table, folder)


def write(df: DataFrame, table: str, mode: str = "overwrite",
          partition_by: Sequence[str] | None = None,
          cluster_by: Sequence[str] | None = None, evolve: bool = False, laid_out: bool = False) -> None:
    """K1 overwrite, K2 append, K3 ``empty`` (only into an absent or empty
    table), K7 clustering columns.

    Rows for an existing table are conformed to it (``conform``): without
    ``evolve`` unknown columns and values the columns cannot hold fail the
    load; with it the table gains the columns and widens the types. ``laid_out``:
    the rows come gathered by the table's partitions (``gathered`` while they
    were narrower, say).
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, got {mode!r}")
    spark = _spark(df)
    if not exists(spark, table):
        _create(df, table, partition_by, cluster_by, laid_out=laid_out)
        return
    if mode == "overwrite":
        replace_table(df, table, partition_by, cluster_by, laid_out)
        return
    if mode == "empty" and not spark.table(table).isEmpty():
        raise TableNotEmpty(table)
    _append(conform(df, table, evolve), table, laid_out)


def _append(rows: DataFrame, table: str, laid_out: bool = False) -> None:
    """Append rows that have the table's columns."""
    parts = () if laid_out else partition_columns(_spark(rows), table)
    gathered(rows, parts).write.mode("append").insertInto(table)


# --- conforming a batch to its table -------------------------------------------

def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both, None where only a
    checked conversion (text to number, say) could bring them together."""
    if a.simpleString() == b.simpleString() or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            both = common_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
            if both is None:
                return None
            fields[f.name] = both
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        item = common_type(a.elementType, b.elementType)
        return None if item is None else T.ArrayType(item)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
            return T.LongType()
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return None


def _converted(c: Column, have: T.DataType, want: T.DataType, name: str) -> tuple[Column, Column]:
    """``c`` as type ``want`` and whether that changed no value; neither ever raises on data."""
    always = F.lit(True)
    if have.simpleString() == want.simpleString():
        return c, always
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want), always
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        lost = [n for n in types if n not in want.names]
        if lost:
            raise SchemaMismatch(f"{name} has fields that its column lacks: {lost}")
        parts = {f.name: _converted(c.getField(f.name), types[f.name], f.dataType, f"{name}.{f.name}")
                 if f.name in types else (F.lit(None).cast(f.dataType), always) for f in want.fields}
        return (F.when(c.isNotNull(), F.struct(*[v.alias(n) for n, (v, _) in parts.items()])),
                reduce(and_, [fits for _, fits in parts.values()], always))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        def item(x: Column) -> tuple[Column, Column]:
            return _converted(x, have.elementType, want.elementType, name)

        return F.transform(c, lambda x: item(x)[0]), F.coalesce(F.forall(c, lambda x: item(x)[1]), always)
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(want, T.StringType):
        return (F.to_json(c) if isinstance(have, nested) else c.cast("string")), always
    if isinstance(have, nested) or isinstance(want, nested):
        raise SchemaMismatch(f"{name}: {have.simpleString()} does not fit {want.simpleString()}")
    if isinstance(have, T.StringType):
        v = F.trim(c).try_cast(want)
        return v, c.isNull() | v.isNotNull()
    try:
        v = c.try_cast(want)
        fits = v.isNotNull() & v.try_cast(have).eqNullSafe(c)
        if isinstance(have, (T.FloatType, T.DoubleType)) or isinstance(want, (T.FloatType, T.DoubleType)):
            # casts between BIGINT and DOUBLE saturate at 2^63
            fits = fits & (~F.lit(isinstance(have, T.IntegralType) or isinstance(want, T.IntegralType))
                           | (F.abs(c.cast("double")) < F.lit(2.0 ** 63)))
    except PySparkException as e:
        raise SchemaMismatch(f"{name}: {have.simpleString()} does not fit {want.simpleString()}") from e
    return v, c.isNull() | fits


def _exactly(c: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    """``c`` as type ``want``; a value that would change fails the job."""
    if have.simpleString() == want.simpleString():
        return c
    v, fits = _converted(c, have, want, name)
    shown = F.to_json(c) if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
    return F.when(fits, v).otherwise(F.raise_error(F.concat(
        F.lit(f"value does not fit {name} {want.simpleString()}: "), shown)).cast(want))


def conform(df: DataFrame, table: str, evolve: bool = False,
            new_type=lambda t: t.simpleString(), fits: str | None = None) -> DataFrame:
    """``df`` in the columns, order and types of ``table``, no value changed.

    Missing columns become null. With ``evolve`` unknown columns are added
    (``new_type`` gives their DDL type) and columns are widened where both
    types have a common one; widening rewrites the table once, since Parquet
    tables cannot alter a column's type. Without it, and where there is no
    common type, a value must convert exactly or the job fails; with ``fits``
    it does not fail, but a column of that name tells whether the row fits,
    beside the row as it came (JSON text in ``record``).
    """
    spark = _spark(df)
    current = {f.name: f.dataType for f in spark.table(table).schema.fields}
    unknown = [f for f in df.schema.fields if f.name not in current]
    if unknown and not evolve:
        raise SchemaMismatch(f"{table} has no column {[f.name for f in unknown]}")
    if evolve:
        fixed = partition_columns(spark, table)
        wide = {}
        for f in df.schema.fields:
            if f.name in current and f.name not in fixed:
                both = common_type(current[f.name], f.dataType)
                if both is not None and both.simpleString() != current[f.name].simpleString():
                    wide[f.name] = both
        if wide:
            replace_table(spark.table(table).select(*[
                _exactly(F.col(f"`{n}`"), t, wide.get(n, t), n).alias(n) for n, t in current.items()]), table)
        if unknown:
            cols = ", ".join(f"`{f.name}` "
                             + ("STRING" if isinstance(f.dataType, T.NullType) else new_type(f.dataType))
                             for f in unknown)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
        if wide or unknown:
            spark.catalog.refreshTable(table)
    have = {f.name: f.dataType for f in df.schema.fields}
    fields = spark.table(table).schema.fields
    if fits is None:
        return df.select(*[
            (_exactly(F.col(f"`{f.name}`"), have[f.name], f.dataType, f.name) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])
    made = {f.name: _converted(F.col(f"`{f.name}`"), have[f.name], f.dataType, f.name) if f.name in have
            else (F.lit(None).cast(f.dataType), F.lit(True)) for f in fields}
    return df.select(*[v.alias(n) for n, (v, _) in made.items()],
                     reduce(and_, [ok for _, ok in made.values()]).alias(fits),
                     F.to_json(F.struct(*[F.col(f"`{n}`") for n in have])).alias("record"))


def write_or_dead_letter(df: DataFrame, table: str, mode: str = "overwrite",
                         partition_by: Sequence[str] | None = None, evolve: bool = False,
                         received: DataFrame | None = None) -> bool:
    """K4: load the batch; if the load fails or is refused, load the whole
    batch into ``<table>_errors`` (a refused ``empty`` load is appended there,
    other modes stay). ``received`` is the batch before its values were
    converted, for batches that cannot be computed in their final types.
    Returns True when the main load succeeded. Failures of the error load
    propagate. The batch is computed again for the error load instead of being
    copied before every load."""
    try:
        write(df, table, mode, partition_by, evolve=evolve)
        return True
    except LOAD_ERRORS:
        write(df if received is None else received, f"{table}_errors",
              "append" if mode == "empty" else mode, evolve=True)
        return False


def with_corrupt_column(schema: T.StructType, name: str = "_corrupt_record") -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(name, T.StringType())])


def load_json_capped(spark: SparkSession, path: str, schema: T.StructType | str, table: str,
                     mode: str = "append", cap: int | None = None, max_share: float | None = None) -> dict:
    """K5: load JSON lines under ``schema`` tolerating up to ``cap`` malformed
    lines, or a share of up to ``max_share`` of all lines (the caller states at
    least one; a share means the same at every size). Good rows go to
    ``table``, malformed lines to ``<table>_bad_records``; above the limit
    nothing is loaded. The lines are read once: they are counted while they are
    written, parsed, to a stage. A line counts as malformed if it is not one
    whole JSON object or list or if a value does not have its type."""
    if cap is None and max_share is None:
        raise ValueError("state the tolerated bad records: cap or max_share")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    lines = spark.read.text(path)
    parsed = F.from_json("value", with_corrupt_column(schema),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = lines.select("value", is_json(F.col("value")).alias("whole"), parsed.alias("r"))
    stage = scratch(spark, "capped")
    good, bad, n = staged_check(rows.select("value", "whole", "r.*"),
                                F.col("whole") & F.col("_corrupt_record").isNull(), F.col("value"), stage,
                                drop=["value", "whole", "_corrupt_record"])
    try:
        if (cap is not None and n["rejected"] > cap) or (max_share is not None and n["rejected"] > max_share * n["rows"]):
            raise TooManyBadRecords(f"{n['rejected']} malformed of {n['rows']} records in {path} "
                                    f"(cap {cap}, share {max_share})")
        write(good.select(*[f"`{f.name}`" for f in schema.fields]), table, mode)
        if n["rejected"]:
            write(bad, f"{table}_bad_records", "append")
    finally:
        S.delete_folder(spark, stage)
    return {"bad_records": n["rejected"]}


def spark_ddl_type(dtype: T.DataType) -> str:
    """K9: column type for a new table column, from the incoming values' type:
    string, boolean, integer, float, timestamp; anything else is stored as
    (JSON) text."""
    if isinstance(dtype, T.StringType):
        return "STRING"
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, T.IntegralType):
        return "BIGINT"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "DOUBLE"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dtype, T.DateType):
        return "DATE"
    return "STRING"


# --- rewrites --------------------------------------------------------------

def distinct(df: DataFrame) -> DataFrame:
    """Full-row distinct; map columns (not comparable in Spark) are compared
    through their JSON text and kept as maps."""
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    if not maps:
        return df.distinct()
    keyed = df.withColumns({f"__k_{m}": F.to_json(F.col(m)) for m in maps})
    keys = [c for c in keyed.columns if c not in maps]
    return keyed.dropDuplicates(keys).drop(*[f"__k_{m}" for m in maps])


#: Whole rows are compared so many at a time, which bounds what their shuffles take on disk.
SLICE_ROWS = 40_000_000


def _slices(rows: int) -> int:
    return max(1, math.ceil(rows / SLICE_ROWS))


def _slice(df: DataFrame, k: int, n: int, fp: Column) -> DataFrame:
    """The k-th of n slices of ``df`` by its rows' fingerprints: equal rows are in one."""
    return df if n == 1 else df.filter(F.pmod(fp, F.lit(n)) == k)


def dedup_table(spark: SparkSession, table: str) -> None:
    """M1: rewrite the whole table without duplicate rows (once, for a table
    that has them; ``append_distinct`` keeps it that way without rewrites). Equal
    rows have equal fingerprints, so a table in which no two are equal stays as
    it is: eight bytes per row are compared instead of whole rows. A large one is
    written slice by slice, and then switched as a whole."""
    slices = 1
    if exists(spark, table) and _hashes_tell(spark.table(table).schema):
        rows = spark.table(table)
        fp = fingerprint(rows.schema)
        n, most = rows.groupBy(fp.alias("fp")).count().agg(F.sum("count"), F.max("count")).first()
        if (most or 0) < 2:
            return
        slices = 1 if cluster_columns(spark, table) else _slices(n)
    if slices == 1:
        replace_table(distinct(spark.table(table)), table)
        return
    parts = partition_columns(spark, table)
    _switched((_laid_out(distinct(_slice(rows, k, slices, fp)), parts, None) for k in range(slices)), table, parts)


def _hashes_tell(schema: T.StructType) -> bool:
    """Whether rows that a distinct takes for equal have equal fingerprints for certain: lists and
    maps are hashed as text (-0.0 and 0.0 differ there), collated text as it is."""
    kinds = schema.simpleString()
    return not any(k in kinds for k in ("array<", "map<", "collate"))


#: Column with the fingerprint of its row, in tables that ``append_distinct`` keeps.
FINGERPRINT = "_row_fp"


def _leaf_hashes(c: Column, kind: T.DataType, name: str, seed: int) -> list[Column]:
    """One hash per value below ``c``, each of its path and value; 0 for a null."""
    if isinstance(kind, T.StructType):
        own = [h for f in kind.fields for h in _leaf_hashes(c.getField(f.name), f.dataType, f"{name}.{f.name}", seed)]
        return [F.when(c.isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(seed), F.lit(name))), *own]
    value = F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType)) else c
    return [F.when(c.isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(seed), F.lit(name), value))]


def fingerprint(schema: T.StructType, columns: Sequence[str] | None = None, seed: int = 0) -> Column:
    """64 bits of a row: its values' hashes, each with the column's name, put together by XOR.

    Neither the order of columns nor a further column that is null changes it,
    so it survives columns added to a table.
    """
    fields = [f for f in schema.fields if columns is None or f.name in columns]
    hashes = [h for f in fields for h in _leaf_hashes(F.col(f"`{f.name}`"), f.dataType, f.name, seed)]
    return reduce(lambda x, y: x.bitwiseXOR(y), hashes, F.lit(0).cast("bigint"))


def table_rows(spark: SparkSession, table: str) -> DataFrame:
    """The table without the columns that rewrites keep beside its rows."""
    return spark.table(table).drop(FINGERPRINT, KEY_BUCKET)


def _in_partitions(rows: DataFrame, parts: Sequence[str]) -> Column:
    """Filter on the partitions that ``rows`` touches, as literals, so that a scan leaves the others out.

    Their values come to the driver, as the catalog's list of partitions does.
    """
    touched = rows.select(*parts).distinct().collect()
    if len(parts) == 1:
        c, values = F.col(parts[0]), [r[0] for r in touched]
        known = [v for v in values if v is not None]
        found = c.isin(known) if known else F.lit(False)
        return found | c.isNull() if len(known) < len(values) else found
    return reduce(or_, [reduce(and_, [F.col(p).eqNullSafe(F.lit(r[p])) for p in parts]) for r in touched], F.lit(False))


def append_distinct(df: DataFrame, table: str, stage: str) -> None:
    """M1 as an append: the rows of ``df`` that ``table`` lacks, each once.

    The table keeps a fingerprint of every row, so a batch is compared with
    eight bytes per stored row, and with whole rows (null-safe, every column)
    only where fingerprints are equal. Partitions that the batch does not touch
    are not read, none is rewritten. A table without fingerprints gets them, and
    loses its duplicates, in one rewrite; so does one whose types widen.

    All values are computed, and conformed, before the first row is appended.
    Whole rows are shuffled once to be compared. A batch of more than
    ``SLICE_ROWS`` rows (with the stored ones it meets) is compared and appended
    slice by slice; one that is cut short can be appended again.
    """
    spark = _spark(df)
    if not exists(spark, table):
        rows = distinct(df)
        _create(rows.withColumn(FINGERPRINT, fingerprint(rows.schema)), table, None, None)
        return
    before = dict(spark.table(table).dtypes)
    rows = conform(df, table, evolve=True)
    kinds = dict(spark.table(table).dtypes)
    names = [c for c in kinds if c != FINGERPRINT]
    own = spark.table(table).select(*[f"`{c}`" for c in names]).schema
    if FINGERPRINT not in before or any(kinds[c] != before[c] for c in before):
        old = distinct(spark.table(table).select(*[f"`{c}`" for c in names]))
        replace_table(old.withColumn(FINGERPRINT, fingerprint(own)), table)
    rows, counts = rows.select(*[f"`{c}`" for c in names]), Observation()
    # copies within the batch go with those of stored rows, where they have equal fingerprints for certain
    batch = (rows if _hashes_tell(own) else distinct(rows)).withColumn(FINGERPRINT, fingerprint(own))
    folder, found = posixpath.join(stage, "batch"), posixpath.join(stage, "suspects")
    batch.observe(counts, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    batch = spark.read.schema(batch.schema).parquet(folder)
    stored, n = spark.table(table), counted(counts).get("rows", 0)
    parts = partition_columns(spark, table)
    if parts:
        stored = stored.filter(_in_partitions(batch, parts))
    suspects = stored.select(FINGERPRINT).join(batch.select(FINGERPRINT), FINGERPRINT, "left_semi").distinct()
    suspects.write.parquet(found)
    suspects = spark.read.schema(suspects.schema).parquet(found)
    old = None
    if not suspects.isEmpty():
        # too many to broadcast: stored rows are not shuffled once more for them
        few = will_broadcast(suspects)
        old = stored.join(F.broadcast(suspects), FINGERPRINT, "left_semi") if few else stored
        n += 0 if few else stored.count()
    slices, fp = _slices(n), F.col(FINGERPRINT)
    for k in range(slices):
        new = _new_rows(_slice(batch, k, slices, fp), None if old is None else _slice(old, k, slices, fp), [FINGERPRINT, *names])
        _append(new.select(*[f"`{c}`" for c in stored.columns]), table)
    for path in (folder, found):
        S.delete_folder(spark, path)


def _new_rows(rows: DataFrame, old: DataFrame | None, names: Sequence[str]) -> DataFrame:
    """The distinct ``rows`` without an equal one in ``old``: null-safe on every one of ``names``.

    Rows of both sides meet in one shuffle. Maps are compared through their JSON text.
    """
    if old is None:
        return distinct(rows)
    maps = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.MapType)]
    cols = [F.col(f"`{c}`") for c in names]
    both = rows.select(*cols, F.lit(True).alias("__new")).union(old.select(*cols, F.lit(False).alias("__new")))
    keys = [F.to_json(F.col(f"`{c}`")).alias(f"__k_{c}") if c in maps else F.col(f"`{c}`") for c in names]
    kept_maps = [F.first(F.col(f"`{c}`")).alias(c) for c in maps]
    return both.groupBy(*keys).agg(F.bool_and("__new").alias("__new"), *kept_maps).filter("__new").select(*cols)


def _without_equal(rows: DataFrame, old: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows without an equal one in ``old``: null-safe on every one of ``names``."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    shown = lambda n: F.to_json(F.col(f"`{n}`")) if isinstance(kinds[n], T.MapType) else F.col(f"`{n}`")
    right = old.select(*[shown(n).alias(f"__{k}") for k, n in enumerate(names)])
    same = reduce(and_, [shown(n).eqNullSafe(F.col(f"__{k}")) for k, n in enumerate(names)])
    return rows.join(right, same, "left_anti")


def distinct_of(rows: DataFrame) -> DataFrame:
    """Full-row distinct of stored ``rows`` (files, read several times) that have few copies.

    Hashes of all rows are shuffled to find the equal ones; only rows with such
    a hash are compared as whole rows. If there are too many of these hashes to
    broadcast, it is the plain distinct.
    """
    if not _hashes_tell(rows.schema):
        return distinct(rows)
    marked = rows.withColumn("__fp", fingerprint(rows.schema))
    twice = kept(marked.groupBy("__fp").count().filter("count > 1").select("__fp"))
    if twice.isEmpty():
        return rows
    if not will_broadcast(twice):
        return distinct(rows)
    alone = marked.join(twice, "__fp", "left_anti").drop("__fp")
    return alone.unionByName(distinct(marked.join(twice, "__fp", "left_semi").drop("__fp")))


def rows_not_in(rows: DataFrame, stored: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Rows without a copy in ``stored``: equal (null-safe) ``keys`` and equal
    128-bit fingerprints of the whole row. Only the partitions of ``stored``
    that ``rows`` touches are read. Of both, hashes are shuffled to find the
    stored rows that have a copy; whole rows are compared with the keys and
    hashes of those, and shuffled only if they are too many to broadcast."""
    marks = {f"__fp{k}": fingerprint(rows.schema, seed=k + 1) for k in range(2)}
    near = stored.select(*[f"`{c}`" for c in rows.columns]).filter(_in_partitions(rows, [partition]))
    new = rows.withColumns(marks)
    old = kept(near.withColumns(marks).select(*keys, *marks).join(new.select(*marks), list(marks), "left_semi"))
    if old.isEmpty():
        return rows
    return _without_equal(new, old, [*keys, *marks]).drop(*marks)


def overwrite_partitions(df: DataFrame, table: str, evolve: bool = False, laid_out: bool = False) -> None:
    """Replace exactly the partitions present in ``df``: they are written to a
    fresh folder and then pointed there one by one. ``laid_out``: as in ``write``."""
    spark = _spark(df)
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} is not partitioned: its rows outside the batch would go")
    rows = conform(df, table, evolve)
    folder = S.fresh(S.adopt(spark, table))
    clusters = cluster_columns(spark, table)
    rows = rows if laid_out and not clusters else _laid_out(rows, parts, clusters)
    rows.write.partitionBy(*parts).parquet(folder)
    S.switch_partitions(spark, table, folder, None)


def dedup_slice(spark: SparkSession, table: str, where: str) -> None:
    """M2/M3: de-duplicate the rows matching ``where``; other rows untouched
    (even if they hold duplicates).

    When the table is partitioned and ``where`` reads only partition
    columns, the slice's partitions are rewritten in place (dynamic
    overwrite); otherwise the table is rebuilt through a stage table.
    """
    t = spark.table(table)
    in_slice = t.filter(where)
    if _reads_only_partitions(spark, table, where):
        # one partition is written by the tasks of the distinct; several are gathered after it
        one = len(in_slice.select(*partition_columns(spark, table)).distinct().take(2)) < 2
        overwrite_partitions(distinct(in_slice), table, laid_out=one)
    else:
        rest = t.filter(f"NOT coalesce({where}, false)")
        replace_table(rest.unionByName(distinct(in_slice)), table)


def _reads_only_partitions(spark: SparkSession, table: str, where: str) -> bool:
    parts = partition_columns(spark, table)
    if not parts:
        return False
    # The predicate reads only partition columns iff it resolves against a
    # frame that has nothing else: a projection of the table would not do,
    # since the analyzer resolves filter references to projected-away columns.
    # ``.schema`` forces analysis also where DataFrames are analysed lazily.
    fields = [f for f in spark.table(table).schema.fields if f.name in parts]
    try:
        spark.createDataFrame([], T.StructType(fields)).filter(where).schema
        return True
    except PySparkException:
        return False


def replace_slice(df: DataFrame, table: str, values: Mapping[str, object],
                  partition_by: Sequence[str] | None = None) -> None:
    """M4: delete the rows with ``values`` from ``table`` and insert ``df``
    (an empty result leaves the slice empty). Rows outside the slice never
    change: where the slice is made of whole partitions, ``df`` is written
    once, into the files that its partitions are then pointed to; else the
    table is rebuilt from the rows outside and ``df``. The result is counted
    while it is written; rows outside the slice refuse the whole result."""
    spark = _spark(df)
    inside = reduce(and_, [F.col(k).eqNullSafe(F.lit(v)) for k, v in values.items()])
    counts = Observation()
    there = exists(spark, table)
    parts = partition_columns(spark, table) if there else list(partition_by or values)
    files = S.adopt(spark, table) if there else S.files_folder(spark, table)
    folder, whole = S.fresh(files), set(values) <= set(parts)
    rows = conform(df, table) if there else df
    # columns of which the slice fixes the value need no gathering
    writer = gathered(rows, [p for p in parts if p not in values] if whole else ()).observe(counts, F.count_if(~inside).alias("outside")).write
    (writer.partitionBy(*parts) if whole else writer).parquet(folder)
    if counted(counts).get("outside"):
        S.delete_folder(spark, folder)
        raise ValueError(f"rows outside the slice {dict(values)} in the result for {table}")
    if whole:
        if not there:
            _create(df.limit(0), table, parts, None, files)
        S.switch_partitions(spark, table, folder, values)
        return
    old = spark.table(table)
    # the rows outside stay in the order of their files: the slice alone is gathered
    slice_ = gathered(spark.read.schema(old.schema).parquet(folder), parts)
    replace_table(old.filter(~inside).unionByName(slice_), table, laid_out=True)
    S.delete_folder(spark, folder)


#: Partition column and property of tables whose partitions are buckets of their key.
KEY_BUCKET, BUCKETS_PROPERTY = "_key_bucket", "ledgerline.key_buckets"


def _key_buckets(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """The key and the number of buckets of a table that is partitioned by them."""
    noted = S.properties(spark, table).get(BUCKETS_PROPERTY)
    if noted is None:
        return None
    n, _, keys = noted.partition(":")
    return keys.split(","), int(n)


def _with_bucket(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return rows.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int"))


def replace_keys(df: DataFrame, table: str, keys: Sequence[str],
                 partition_by: Sequence[str] | None = None, buckets: int | None = None) -> None:
    """M5: delete the table rows whose ``keys`` occur in ``df``, append ``df``.

    A new table is partitioned by the first key (or ``partition_by``), or, with
    ``buckets``, by a hash of the key into so many partitions, for keys that
    make no natural partition. Where the table's partition columns are among
    the keys, or are buckets of some of them, only the partitions that the
    batch touches are read and written; a bucket's rows are written by the
    tasks that read them, so a hot one is no single task's. Otherwise the table
    is rebuilt as (rows without a new key) and the batch.
    """
    spark = _spark(df)
    if not exists(spark, table):
        if buckets is None:
            _create(df, table, list(partition_by or keys[:1]), None)
        else:
            _create(_with_bucket(df, keys, buckets), table, [KEY_BUCKET], None)
            S.set_properties(spark, table, ledgerline__key_buckets=f"{buckets}:{','.join(keys)}")
        return
    parts, bucketed = partition_columns(spark, table), _key_buckets(spark, table)
    old = spark.table(table)
    rows = conform(df, table)
    if bucketed:
        rows = _with_bucket(rows, *bucketed)
    by_partition = set(bucketed[0]) <= set(keys) if bucketed else parts and set(parts) <= set(keys)
    new_keys = rows.select(*keys).distinct()
    if by_partition:
        touched = old.filter(_in_partitions(rows, parts))
        overwrite_partitions(touched.join(new_keys, list(keys), "left_anti").unionByName(rows), table)
    else:
        replace_table(old.join(new_keys, list(keys), "left_anti").unionByName(rows), table)


# --- state ----------------------------------------------------------------

def read_state(spark: SparkSession, table: str, default: int = 1) -> int:
    """The one-row resume state, ``default`` when absent or empty."""
    if not exists(spark, table):
        return default
    row = spark.table(table).select("page_id").limit(1).collect()
    return int(row[0][0]) if row and row[0][0] is not None else default


def save_state(spark: SparkSession, table: str, page_id: int) -> None:
    state = spark.range(1).select(F.lit(int(page_id)).cast("bigint").alias("page_id"))
    write(state, table, "overwrite")


# --- aligned append ----------------------------------------------------------

def align_to_table(df: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    """The K6 alignment of ``df`` to an existing ``table``: list columns as
    comma text (T6), records as JSON text, new columns added to the table
    with ``ALTER TABLE .. ADD COLUMNS`` (type from K9), missing ones null, in
    the table's column order. Returns the aligned frame and the added names."""
    current = _spark(df).table(table).columns
    added = [c for c in df.columns if c not in current]
    return conform(df, table, evolve=True, new_type=spark_ddl_type), added


def _shape_for_table(df: DataFrame) -> DataFrame:
    from ledgerline.functions.shape import flatten_lists

    df = flatten_lists(df)
    return df.select(*[(F.to_json(F.col(f"`{f.name}`")).alias(f.name)
                        if isinstance(f.dataType, (T.StructType, T.MapType)) else F.col(f"`{f.name}`"))
                       for f in df.schema.fields])


def align_append(df: DataFrame, table: str, partition_by: Sequence[str] | None = None,
                 replace_partitions: bool = False) -> list[str]:
    """K6: append ``df`` to ``table`` whose schema may differ.

    List columns become comma text (T6); columns new to the table are added
    with ``ALTER TABLE .. ADD COLUMNS`` (type from K9; records are stored as
    JSON text) and keep their values; table columns missing from ``df`` are
    null; rows are written in the table's column order. An absent table is
    created from the first batch. With ``replace_partitions`` the batch
    replaces the partitions it touches. Returns the added column names.
    """
    spark = _spark(df)
    df = _shape_for_table(df)
    if not exists(spark, table):
        _create(df, table, partition_by, None)
        return list(df.columns)
    aligned, added = align_to_table(df, table)
    if replace_partitions:
        overwrite_partitions(aligned, table)
    else:
        _append(aligned, table)
    return added


@dataclass
class Misfits:
    """Rows that a table could not take: how many, and each as JSON text in ``record``."""

    n: int
    records: DataFrame | None


def append_fitting(df: DataFrame, table: str, tags: Mapping[str, object] | None = None,
                   may_be_replay: bool = True) -> Misfits:
    """K6 for the rows whose values fit the table's columns; the others are returned.

    Rows are counted while they are appended; only if some did not fit is the
    batch computed again, for those. ``tags`` (run column, batch column) make
    the append exactly once, as in ``align_append_once``.
    """
    df = _shape_for_table(df)
    if not exists(_spark(df), table):
        _append_tagged(df, table, tags, may_be_replay)
        return Misfits(0, None)
    made = conform(df, table, evolve=True, new_type=spark_ddl_type, fits="_fits")
    wrong = Observation()
    names = [c for c in made.columns if c not in ("_fits", "record") and c not in (tags or {})]
    fitting = made.observe(wrong, F.count_if(~F.col("_fits")).alias("n")).filter(F.col("_fits")).select(
        *[f"`{c}`" for c in names])
    _append_tagged(fitting, table, tags, may_be_replay)
    return Misfits(counted(wrong).get("n", 0), made.filter(~F.col("_fits")).select("record"))


def append_errors(records: DataFrame, table: str, tags: Mapping[str, object] | None = None,
                  may_be_replay: bool = True) -> None:
    """K4 for what arrived as text in ``record``: appended with its tags, exactly once if it has any."""
    _append_tagged(records, table, tags, may_be_replay)


def _append_tagged(df: DataFrame, table: str, tags: Mapping[str, object] | None, may_be_replay: bool) -> None:
    if tags is None:
        align_append(df, table)
        return
    (run_col, run), (batch_col, batch_id) = tags.items()
    align_append_once(df, table, run_col, run, batch_col, batch_id, may_be_replay)


def align_append_once(df: DataFrame, table: str, run_col: str, run: str,
                      batch_col: str, batch_id: int, may_be_replay: bool = True) -> bool:
    """K6 for one stream micro-batch, exactly once.

    The table is partitioned by run only; the batch id is a column. Normally
    the batch is appended. If rows of this (run, batch id) are already there
    (the batch was written but its commit was not recorded, so the stream
    replays it), the run's partition is rewritten without the earlier copy
    (dynamic overwrite of that one partition). ``may_be_replay=False``
    skips that check when the caller knows the batch is new. Returns True on
    a replay.
    """
    spark = _spark(df)
    df = _shape_for_table(df).withColumns({batch_col: F.lit(batch_id).cast("bigint"),
                                           run_col: F.lit(run)})
    if not exists(spark, table):
        _create(df, table, [run_col], None)
        return False
    mine = (F.col(run_col) == F.lit(run)) & (F.col(batch_col) == F.lit(batch_id))
    replay = may_be_replay and not spark.table(table).filter(mine).isEmpty()
    aligned, _ = align_to_table(df, table)
    if not replay:
        aligned.write.mode("append").insertInto(table)
        return False
    kept = spark.table(table).filter((F.col(run_col) == F.lit(run)) & ~mine)
    overwrite_partitions(kept.unionByName(aligned), table)
    return True
