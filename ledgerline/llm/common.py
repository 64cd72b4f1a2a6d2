"""Helpers shared by the training-data operators.

* ``table`` reads one of the driver's tables with only the columns it needs.
* ``written`` cuts lineage with a Parquet table in the shared folder named by
  ``spark.checkpoint.dir``: every executor can read it back, so a lost executor
  costs a re-read, never a wrong or partial result.
* ``components`` labels connected components with large-star / small-star
  rounds, each a pair of joins; no list of neighbours is ever collected.
* ``fold`` is crc32 of an id's decimal text, the contract's deterministic split.
"""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return posixpath.join(shared_dir(spark), "ledgerline-llm", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back with its own schema."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(column: str | Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts``; null for a null id."""
    c = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(parts))


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Nothing to do if ``PYTHONPATH`` (which workers inherit) already has it;
    otherwise its modules go out as a zip, the way ``--py-files`` would.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in paths or getattr(sc, "_ledgerline_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="ledgerline-code-"), "ledgerline.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "ledgerline")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    sc._ledgerline_shipped = True


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for ``fn(columns: dict[str, list]) -> dict[str, list]`` per record batch."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, f.type)
                     for x, f in zip((out[f.name] for f in target), target)], schema=target)

    return df.mapInArrow(run, schema)


def arrow_rows(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for rows that each give many: ``fn(row: dict) -> dict[str, list]``, one batch per row."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                out = fn(batch.slice(k, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding it."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def hash_sample(df: DataFrame, column: str, rows: int, of: int, spare: int = 2) -> DataFrame:
    """The ``rows`` rows of smallest hash ``column``; about ``spare`` times as many reach the ordering.

    ``of`` is the number of rows the hash ranges over; where it is large, a
    share by hash goes first, so that what meets in one place stays bounded.
    """
    df = hash_share(df, column, rows, of, spare)
    return df.orderBy(F.pmod(F.col(column), F.lit(1 << 20)), column).limit(rows)


def hash_share(df: DataFrame, column: str, rows: int, of: int, spare: int = 2) -> DataFrame:
    """A share by hash ``column`` that leaves about ``spare`` times ``rows`` of ``of`` rows, so that what
    a later limit gathers in one place stays bounded; all rows if there are no more."""
    share = spare * rows / max(1, of)
    if share >= 1:
        return df
    return df.where(F.pmod(F.col(column), F.lit(1 << 20)) < F.lit(max(1, round(share * (1 << 20)))))


def text_key(text: Column) -> Column:
    """128 bits of a text, as two longs in hex; null for null."""
    raw = text.cast("string")
    return F.concat(F.hex(F.xxhash64(raw, F.lit(1))), F.hex(F.xxhash64(raw, F.lit(2))))


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _by_row(docs: DataFrame, named: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_key) is (left_semi) or is not (left_anti) among ``named`` (doc_id, __text)."""
    text, other_id, other_text = (free(docs, n) for n in ("_text", "_other_id", "_other_text"))
    named = named.select(F.col("doc_id").alias(other_id), F.col("__text").alias(other_text))
    same = F.col("doc_id").eqNullSafe(F.col(other_id)) & F.col(text).eqNullSafe(F.col(other_text))
    return docs.withColumn(text, text_key(F.col("text"))).join(named, same, how).select(
        *[f"`{c}`" for c in docs.columns])


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_key) is not among ``rejected`` (doc_id, __text); nulls compare equal."""
    return _by_row(docs, written(rejected.distinct(), "rejected"), "left_anti")


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_key) is among ``kept`` (doc_id, __text), each of these once."""
    found = _by_row(docs, written(kept.distinct(), "kept"), "left_semi")
    nth = free(docs, "_nth")
    same = Window.partitionBy("doc_id", text_key(F.col("text"))).orderBy(F.lit(0))
    return found.withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1).drop(nth)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node reachable.

    Alternates large-star (link every larger neighbour to the smallest
    neighbour) and small-star (link the smaller neighbours and the node to the
    smallest) until the edges are stars. Rounds grow with the logarithm of the
    component size; a hub's rows meet only partial aggregation and plain joins,
    which AQE splits. No edges give no rows; loops and null ends are ignored.
    """
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = written(ordered, "edges")
    mark = _mark(current)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(
            "u", F.least("u", "low").alias("low"))
        large = written(both.join(low, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("low").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v").distinct()
        current = written(small, "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"),
                    F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def arrow_groups(df: DataFrame, keys: list[str], order: list[str], fn, schema: str) -> DataFrame:
    """``fn(key, table) -> dict[str, list]`` for the rows of every distinct key (nulls are a key).

    One shuffle by the keys and a sort; a task holds one group and one batch at
    a time, so groups must be bounded by the caller, however many there are.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now: tuple = ()

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                out = fn(now, pa.Table.from_batches(held))
                held.clear()
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, f.type)
                     for x, f in zip((out[f.name] for f in target), target)], schema=target)

        for batch in batches:
            own = list(zip(*[batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]))
            cuts = [i for i in range(1, len(own)) if own[i] != own[i - 1]]
            for a, b in zip([0, *cuts], [*cuts, len(own)]):
                if b > a:
                    if held and own[a] != now:
                        yield from flush()
                    now = own[a]
                    held.append(batch.slice(a, b - a))
        yield from flush()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "numbered") -> DataFrame:
    """``rows`` with ``pos`` (from 0 within ``group``, by ``order``, nulls first) and ``n`` (the group's rows).

    One range shuffle and a written table; a group of any size is spread over
    many partitions, whose offsets are summed (one row per partition and group).
    """
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumns(
        {"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    held = written(spread, name)
    runs = held.groupBy("__part", F.col(group).alias("__group")).agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    own = Window.partitionBy("__group")
    runs = runs.withColumns({
        "n": F.sum("__rows").over(own),
        "__before": F.sum("__rows").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))})
    runs = written(runs.withColumnRenamed("__part", "__of"), name + "-runs")
    same = (F.col("__part") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group"))
    pos = F.col("__row") - F.col("__first") + F.coalesce("__before", F.lit(0))
    return held.join(runs, same).select(*rows.columns, pos.alias("pos"), "n")
