"""Id selection and request planning as DataFrame operators.

Which ids, pages and request combinations are needed is data work; the
requests themselves are a transport concern outside this library.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.relational import kept
from ledgerline.schemas import SOURCE_FLAG_VALUES, SOURCE_INTEGRATIONS


def live_ids(df: DataFrame, id_col: str, status_col: str = "statusString",
             live: str = "live") -> DataFrame:
    """Distinct non-null ids of live items."""
    return df.filter(F.col(status_col) == live).select(id_col).dropna().distinct()


def distinct_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Distinct non-null ids."""
    return df.select(id_col).dropna().distinct()


def ids_created_since(df: DataFrame, ts_col: str, as_of: dt.date, id_col: str = "id") -> DataFrame:
    """P5: distinct ids whose creation day is ``as_of`` or later (a filter the scan can push down)."""
    midnight = F.lit(dt.datetime.combine(as_of, dt.time())).cast(df.schema[ts_col].dataType)
    return df.filter(F.col(ts_col) >= midnight).select(id_col).distinct()


def nested_path_distinct(df: DataFrame, path: str, alias: str | None = None) -> DataFrame:
    """Distinct non-null values at a nested path (e.g. ``lead.firstSource.adSource.adSourceId``)."""
    name = alias or path.split(".")[-1]
    return df.select(F.col(path).alias(name)).where(F.col(name).isNotNull()).distinct()


def first_ids(df: DataFrame, id_col: str, n: int = 9) -> DataFrame:
    """L2: the first ``n`` ids in id order (a top-n, not a sort of everything)."""
    return df.select(id_col).orderBy(id_col).limit(n)


def only_new_ids(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``existing`` (left anti join)."""
    return df.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def sync_gap(spark: SparkSession, total: int, loaded: int, page_size: int = 100) -> DataFrame:
    """Pages to fetch when the service reports ``total`` rows and the
    table holds ``loaded``: ``1 .. missing // page_size + 1``, newest page
    first; none when nothing is missing."""
    missing = max(0, int(total) - int(loaded))
    last = missing // page_size + 1 if missing > 0 else 0
    return spark.range(1, last + 1).select(F.col("id").alias("page")).orderBy(F.desc("page"))


def number_rows(ids: DataFrame, id_col: str, partitions: int | None = None) -> DataFrame:
    """Consecutive 0-based numbers of the distinct ids in id order (a dense
    rank), without a single-partition window.

    Ids are range-partitioned and sorted within partitions; each row's number
    is its partition's offset (a running sum over one count per partition,
    a table as small as the partition count) plus its position in the
    partition. The ranged ids are written once so both uses see one layout.
    """
    mid = F.monotonically_increasing_id()
    distinct = ids.select(F.col(id_col).alias("_id")).distinct()
    # without a fixed count AQE may merge adjacent ranges; they stay in order
    by_range = (distinct.repartitionByRange(partitions, "_id") if partitions
                else distinct.repartitionByRange("_id"))
    ranged = kept(by_range.sortWithinPartitions("_id")
                  .withColumn("_mid", mid)
                  .withColumn("_part", F.shiftright(F.col("_mid"), 33))
                  .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("_mid"))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_part")
                  .select(F.col("_id").alias(id_col), (F.col("_off") + F.col("_pos")).alias("rn")))


def chunk_ids(ids: DataFrame, id_col: str, size: int) -> DataFrame:
    """R2/A5: consecutive chunks of ``size`` ids in id order, each as
    ``chunk`` number and the ids joined with ``,``."""
    numbered = number_rows(ids, id_col)
    return (numbered.groupBy(F.floor(F.col("rn") / size).cast("bigint").alias("chunk"))
                    .agg(F.array_join(F.array_sort(F.collect_list(id_col)), ",").alias("ids")))


def source_combinations() -> Column:
    """The fixed request grid: integration × include_disregarded × include_organic."""
    return F.array(*[
        F.struct(F.lit(i).alias("integration_type"), F.lit(d).alias("include_disregarded"),
                 F.lit(o).alias("include_organic"))
        for i in SOURCE_INTEGRATIONS for d in SOURCE_FLAG_VALUES for o in SOURCE_FLAG_VALUES])


def request_grid(chunks: DataFrame) -> DataFrame:
    """Every chunk with each of the 24 combinations, generated per row
    (no join: the grid is a fixed list)."""
    return chunks.select("*", F.inline(source_combinations()))


def per_id_requests(ids: DataFrame, id_col: str, template: str) -> DataFrame:
    """One request path per id (``template`` uses ``%s``); no ids, no requests."""
    return ids.select(F.col(id_col), F.format_string(template, F.col(id_col).cast("string"))
                      .alias("request"))


class BrokenChain(RuntimeError):
    """Raised when the pages of a request do not lead from one first page to one last page."""


def chain_breaks(pages: DataFrame, request: Sequence[str], page: str, next_page: str) -> DataFrame:
    """What is wrong with the page chains of ``pages``, one row per fault.

    Every page but the last of a request names its successor in ``next_page``.
    Faults (``request`` columns, ``fault``, ``page``): a successor that is not
    there (missing), a last page beside the first of them (another end), a
    first page beside the first of them (another start), a request whose pages
    form a ring (no start, no end). Copies of a page count once; null request
    values are values.
    """
    names = [f"__r{k}" for k in range(len(request))]
    own = pages.select(*[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(request, names)],
                       F.col(f"`{page}`").cast("string").alias("at"),
                       F.col(f"`{next_page}`").cast("string").alias("next")).distinct()
    # each page is there once as itself and once as it is named; one aggregation pairs both up
    both = own.select(*names, F.col("at").alias("page"), F.lit(1).alias("there"), F.lit(0).alias("named"),
                      F.col("next").isNull().cast("int").alias("last")).unionByName(
        own.filter(F.col("next").isNotNull()).select(
            *names, F.col("next").alias("page"), F.lit(0).alias("there"), F.lit(1).alias("named"), F.lit(0).alias("last")))
    seen = both.groupBy(*names, "page").agg(*[F.max(c).alias(c) for c in ("there", "named", "last")])
    found = seen.select(*names, "page", F.explode(F.array_compact(F.array(
        F.when(F.col("there") == 0, F.lit("missing")),
        F.when((F.col("there") == 1) & (F.col("named") == 0), F.lit("start")),
        F.when(F.col("last") == 1, F.lit("end")), F.lit("page")))).alias("what"))
    # per request: the least page of each kind, and how many there are; no list of pages is built
    kinds = found.groupBy(*names, "what").agg(F.count(F.lit(1)).alias("n"), F.max("page").alias("most"))
    several = kinds.filter(F.col("what").isin("start", "end") & (F.col("n") > 1)).select(
        *names, F.concat(F.lit("another "), F.col("what")).alias("fault"), F.col("most").alias("page"))
    missing = found.filter(F.col("what") == "missing").select(*names, F.col("what").alias("fault"), "page")
    rings = kinds.groupBy(*names).agg(F.max("most").alias("page"), *[
        F.max((F.col("what") == k).cast("int")).alias(k) for k in ("start", "end", "missing")]).filter(
        "start = 0 OR (end = 0 AND missing = 0)").select(
        *names, F.when(F.col("start") == 0, F.lit("no start")).otherwise(F.lit("no end")).alias("fault"), "page")
    faults = missing.unionByName(several).unionByName(rings)
    return faults.select(*[F.col(n).alias(c) for c, n in zip(request, names)], "fault", "page")


def check_chains(pages: DataFrame, request: Sequence[str], page: str, next_page: str, shown: int = 10) -> None:
    """Raise ``BrokenChain`` if ``chain_breaks`` finds any, naming the first ``shown`` of them."""
    faults = chain_breaks(pages, request, page, next_page).orderBy("fault", *request, "page").limit(shown).collect()
    if faults:
        raise BrokenChain("; ".join(
            f"{r['fault']}: page {r['page']} of {', '.join(f'{c}={r[c]}' for c in request) or 'the landing'}" for r in faults))
