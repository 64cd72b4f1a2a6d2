"""K-d tree sharding at distributed weighted medians (DataFrame functions only).

Every document is a point of metadata dimensions (bytes, lines, spaces), all of
them functions of its text, weighted by its size. A cell is split at the
weighted median along the dimension that is widest relative to the whole
table, until each cell is one leaf of the target bytes. A coordinate is the
dimension's value followed by 32 bits of the text's hash, so equal texts are
one point and stay together and no dimension runs out of distinct values.

The exact weighted median is found by radix descent: byte sums per 16-bit
digit of the coordinate are partially aggregated (at most 65,536 sums a cell),
the digit that holds the median is followed, four times. Only one row per cell
and round reaches the driver; the rows themselves are a narrow table in the
shared folder, the text is read once and never shuffled.

If the point at the median weighs more than ``hot_share`` of its cell (a text
copied very often), that point is split too, by the hash of the document id;
lighter points go whole to the side that leaves the halves most equal.

Cases: a null text has size 1 and no lines; null ids are an ordinary value;
rows that repeat both id and text stay together; an empty table gives no rows;
fewer points than shards leaves shards empty. Other input columns are read only
if named in ``keep`` and must not be called like a result column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written

SHARDS = 8
HOT_SHARE = 0.01
DIGIT = 16
DIMENSIONS = ("bytes", "lines", "spaces")


def text_dimensions(text: Column) -> dict[str, Column]:
    """Metadata dimensions of a text, each a non-negative number below 2**31."""
    own = F.coalesce(text, F.lit(""))
    return {"bytes": F.octet_length(own).cast("long"),
            "lines": (F.length(own) - F.length(F.translate(own, "\n", ""))).cast("long"),
            "spaces": (F.length(own) - F.length(F.translate(own, " ", ""))).cast("long")}


def _inline(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A few driver-side rows (at most one per cell) as a DataFrame of longs and doubles."""
    structs = [F.struct(*[(F.lit(v).cast("double") if isinstance(v, float) else F.lit(v).cast("long"))
                          .alias(k) for k, v in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _descend(spark: SparkSession, points: DataFrame, column: str, cells: list[dict]) -> list[dict]:
    """For each cell the value of ``column`` at which the weight reaches its target.

    ``points``: (cell, column, size). ``cells``: dicts with cell and target.
    Adds value, below (weight of smaller values) and at (weight of the value).
    """
    found = [{"cell": c["cell"], "target": float(c["target"]), "prefix": 0, "below": 0.0} for c in cells]
    for shift in (48, 32, 16, 0):
        state = F.broadcast(_inline(spark, found))
        inside = points.join(state, "cell")
        if shift < 48:
            inside = inside.where(F.shiftright(F.col(column), shift + DIGIT) == F.col("prefix"))
        sums = inside.groupBy("cell", F.shiftright(F.col(column), shift).alias("digit")).agg(
            F.sum("size").alias("weight"), F.first("target").alias("target"), F.first("below").alias("below"))
        order = Window.partitionBy("cell").orderBy("digit")
        upto = F.col("below") + F.sum("weight").over(order)
        last = F.lead("digit").over(order).isNull()
        hit = (sums.withColumn("upto", upto).withColumn("last", last)
               .where((F.col("upto") >= F.col("target")) | F.col("last"))
               .groupBy("cell").agg(F.min_by(F.struct("digit", "upto", "weight"), "digit").alias("x")))
        rows = {r["cell"]: r["x"] for r in hit.collect()}
        for f in found:
            x = rows[f["cell"]]
            f |= {"prefix": int(x["digit"]), "below": float(x["upto"] - x["weight"]), "at": float(x["weight"])}
        at = {f["cell"]: f.pop("at") for f in found}
    return [c | {"value": f["prefix"], "below": f["below"], "at": at[f["cell"]]}
            for c, f in zip(cells, found)]


def _cuts(spark: SparkSession, points: DataFrame, cells: list[dict], dims: Sequence[str],
          root: dict[str, float], hot_share: float) -> list[dict]:
    """One cut per cell of more than one leaf: points beyond (value, tie) go right."""
    spans = {r["cell"]: r for r in points.groupBy("cell").agg(
        F.sum("size").alias("size"),
        *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))]).collect()}
    open_ = []
    for c in cells:
        if c["leaves"] > 1 and c["cell"] in spans:
            s = spans[c["cell"]]
            width = [(s[f"max_{d}"] - s[f"min_{d}"]) / (root[d] or 1.0) for d in dims]
            half = c["leaves"] // 2
            open_.append(c | {"dim": max(range(len(dims)), key=lambda k: (width[k], -k)), "half": half,
                              "size": float(s["size"]), "target": s["size"] * half / c["leaves"]})
    if not open_:
        return []
    chosen = _along(spark, points, open_, dims)
    cuts = _descend(spark, chosen, "key", open_)
    heavy = []
    for c in cuts:
        left, right = c["target"] - c["below"], c["below"] + c["at"] - c["target"]
        c["tie"] = (1 << 62) * 2 - 1 if right <= left else -1  # the whole point left, or right
        if c["at"] > hot_share * c["size"]:
            heavy.append(c)
    if heavy:
        narrow = chosen.join(F.broadcast(_inline(spark, [{"cell": c["cell"], "value": c["value"]} for c in heavy])),
                             "cell").where("key = value")
        for c, t in zip(heavy, _descend(spark, narrow, "tie_key",
                                        [{"cell": c["cell"], "target": c["target"] - c["below"]} for c in heavy])):
            nearer = t["below"] + t["at"] - t["target"] <= t["target"] - t["below"]
            c["tie"] = t["value"] if nearer else t["value"] - 1
    return cuts


def _along(spark: SparkSession, points: DataFrame, cells: list[dict], dims: Sequence[str]) -> DataFrame:
    """Points of the given cells with their coordinate along the cell's dimension."""
    which = F.broadcast(_inline(spark, [{"cell": c["cell"], "dim": c["dim"]} for c in cells]))
    value = F.element_at(F.array(*[F.col(d) for d in dims]), (F.col("dim") + 1).cast("int"))
    return points.join(which, "cell").withColumn(
        "key", F.shiftleft(value, 32).bitwiseOR(F.col("text_hash")))


def kdtree_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None,
                  id_column: str = "doc_id", text_column: str = "text", hot_share: float = HOT_SHARE,
                  keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, *keep): every row in one shard.

    Leaves are ``shards`` many, or as many as ``target_bytes`` asks for. Slots
    number the rows of a shard from 0 without gaps.
    """
    spark = docs.sparkSession
    text = F.col(text_column).cast("string")
    dims = text_dimensions(text)
    tie = F.shiftrightunsigned(F.xxhash64(F.col(id_column)), 1)
    points = written(docs.select(
        F.col(id_column).alias("doc_id"), *keep,
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *[c.alias(f"__{n}") for n, c in dims.items()],
        F.xxhash64(text).bitwiseAND(F.lit((1 << 32) - 1)).alias("text_hash"), tie.alias("tie_key"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"),
        F.lit(0).cast("long").alias("cell")), "points")
    names = [f"__{n}" for n in dims]
    whole = points.agg(F.sum("size").alias("size"), *[(F.max(d) - F.min(d)).alias(d) for d in names]).first()
    leaves = shards if target_bytes is None else max(1, math.ceil((whole["size"] or 0) / target_bytes))
    root = {d: float(whole[d] or 0) for d in names}
    cells = [{"cell": 0, "leaves": leaves}]
    while whole["size"] and any(c["leaves"] > 1 for c in cells):
        cuts = _cuts(spark, points, cells, names, root, hot_share)
        if not cuts:
            break
        state = F.broadcast(_inline(spark, [{"cell": c["cell"], "dim": c["dim"], "value": c["value"],
                                             "tie": c["tie"], "half": c["half"]} for c in cuts]))
        value = F.element_at(F.array(*[F.col(d) for d in names]), (F.col("dim") + 1).cast("int"))
        key = F.shiftleft(value, 32).bitwiseOR(F.col("text_hash"))
        right = (key > F.col("value")) | ((key == F.col("value")) & (F.col("tie_key") > F.col("tie")))
        points = written(points.join(state, "cell", "left").withColumn(
            "cell", F.when(right, F.col("cell") + F.col("half")).otherwise(F.col("cell"))
        ).drop("dim", "value", "tie", "half"), "points")
        done = {c["cell"] for c in cuts}
        cells = [c for c in cells if c["cell"] not in done] + [
            {"cell": c["cell"] + shift, "leaves": n} for c in cuts
            for shift, n in ((0, c["half"]), (c["half"], c["leaves"] - c["half"]))]
    within = Window.partitionBy("cell", "part").orderBy("pos")
    sizes = points.groupBy("cell", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("cell", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = points.withColumn("nth", F.row_number().over(within)).join(starts, ["cell", "part"])
    return numbered.select("doc_id", *keep, "size", "text_crc32", F.col("cell").cast("int").alias("shard"),
                           (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``: law ``bytes``, eight shards."""
    placed = kdtree_shards(table(spark, sf_dir, "documents", "doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
