"""Embedding near-duplicates by dual traversal of cover trees.

Vectors of one label are compared by cosine; on unit vectors that is a
Euclidean threshold, so ball bounds hold. The work is dealt out in two layers:

* Across tasks: large labels get pivots (a bounded number in all). A vector's
  home is the cell of its nearest pivot, whose covering radius is measured; it
  visits another, lower cell only if its distance to that pivot is at most the
  cell's radius plus the threshold. Cells are cut into blocks of ``BLOCK`` rows
  and a task compares one home block with one block of visitors, so no label or
  cell has to fit into a task.
* Inside a task: home rows and visitors each form a cover tree of nested levels
  with halving radii. The two trees are walked together; a pair of nodes is
  dropped when its centres are farther apart than both covering radii plus the
  threshold. Pairs of leaves are compared exactly, in double precision.

Copies (equal vectors of one label) are one row with a count. A task returns
one row per vector class: how many vectors it links to, and its smallest linked
relative in this task; no list of pairs leaves a task.

Cases: vectors that are null, empty, zero or hold null or non-finite components,
and vectors without a label, link with nothing and are their own component;
vectors of different length never link; repeated rows count as vectors of their
own; a null id keeps its row (its component is the smallest id it reaches, null
if none); empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import arrow_map, components, ship, table, written

THRESHOLD = 0.93
BLOCK = 1024
PIVOTS = 1024           # in all labels together
PIVOT_LABELS = 256
LEAF = 24
_SLACK = 1e-6  # far above the rounding of a distance


class CoverTree:
    """Nested levels over rows of unit vectors; node arrays: centre, covering radius, children or rows."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.rows: list[np.ndarray] = []
        if len(x):
            far = _distance(x, x[:1])[:, 0]
            todo = [(self._node(np.arange(len(x)), 0, far), float(far.max()), far)]
            while todo:
                node, reach, far = todo.pop()
                rows = self.rows[node]
                if len(rows) <= leaf or self.radius[node] <= _SLACK:
                    continue
                # the next level halves the radius; the node's centre is its own child (nesting)
                half, left, kids = reach / 2, rows, []
                centre = self.centre[node]
                while len(left):
                    near = far <= half
                    if not near.any():
                        near[np.flatnonzero(left == centre)] = True
                    kids.append(self._node(left[near], centre, far[near]))
                    todo.append((kids[-1], half, far[near]))
                    left = left[~near]
                    if len(left):
                        centre = int(left[0])
                        far = _distance(x[left], x[centre:centre + 1])[:, 0]
                self.children[node] = np.array(kids)

    def _node(self, rows: np.ndarray, centre: int, far: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(float(far.max()) if len(far) else 0.0)
        self.children.append(None)
        self.rows.append(rows)
        return len(self.centre) - 1


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def dual_traversal(a: CoverTree, b: CoverTree, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (of a, of b) of all pairs with cosine >= threshold; each pair once.

    With ``a is b`` unordered pairs of different rows.
    """
    if not len(a.x) or not len(b.x):
        return
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + _SLACK
    radius_a, radius_b = np.array(a.radius), np.array(b.radius)
    centre_a, centre_b = np.array(a.centre), np.array(b.centre)
    todo = [(0, 0)]
    while todo:
        m, n = todo.pop()
        kids_a, kids_b = a.children[m], b.children[n]
        if kids_a is None and kids_b is None:
            rows, cols = a.rows[m], b.rows[n]
            hit = (a.x[rows] @ b.x[cols].T) >= threshold
            i, j = np.nonzero(hit)
            i, j = rows[i], cols[j]
            if a is b and m == n:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        if a is b and m == n:  # unordered pairs of children, each with itself too
            first, second = kids_a, kids_a
        elif kids_b is None or kids_a is not None and radius_a[m] >= radius_b[n]:
            first, second = kids_a, np.array([n])
        else:
            first, second = np.array([m]), kids_b
        apart = _distance(a.x[centre_a[first]], b.x[centre_b[second]])
        near = apart <= radius_a[first][:, None] + radius_b[second][None, :] + reach
        if a is b and m == n:
            near = np.triu(near)
        todo.extend(zip(first[np.nonzero(near)[0]].tolist(), second[np.nonzero(near)[1]].tolist()))


def _roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest row number reachable from each row over the pairs."""
    root = np.arange(n)
    if pairs:
        i, j = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        while True:
            low = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            root = np.minimum(root, root[root])
            if (root == before).all():
                break
    return root


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _task(threshold: float):
    def compare(rows: pa.Table) -> pa.Table:
        cls, n = rows["cls"].to_numpy(), rows["n"].to_numpy()
        x, visitor = _unit(_matrix(rows["emb"])), rows["side"].to_numpy() == 1
        home, guests = np.flatnonzero(~visitor), np.flatnonzero(visitor)
        tree = CoverTree(x[home])
        other = CoverTree(x[guests]) if len(guests) else tree
        links, pairs = np.zeros(len(cls), np.int64), []
        for i, j in dual_traversal(tree, other, threshold):
            i, j = home[i], (guests if len(guests) else home)[j]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            pairs.append((i, j))
        root = _roots(len(cls), pairs)
        return pa.table({"a": cls, "b": cls[root], "links": links})
    return compare


def linked(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id",
           vector_column: str = "embedding", label_column: str = "label", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    ship(spark)
    emb, label = F.col(vector_column), F.col(label_column)
    bad = F.exists(emb, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.coalesce(label.isNotNull() & (F.size(emb) > 0) & ~bad & F.exists(emb, lambda v: v != 0), F.lit(False))
    rows = written(vectors.select(F.col(id_column).alias("vec_id"), usable.alias("usable"),
                                  F.when(usable, F.xxhash64(label, emb)).alias("k1"),
                                  F.when(usable, F.xxhash64(F.lit(2), emb, label)).alias("k2"),
                                  label.alias("label"), emb.alias("emb")), "vectors")
    classes = written(rows.where("usable").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("emb").alias("emb"),
        F.first("label").cast("string").alias("label"))
        .withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("emb")), "classes")
    found = written(_compare(classes, threshold, block), "found")
    degree = found.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    comps = components(found.where("a != b").select("a", "b"))
    rooted = written(classes.select("k1", "k2", "cls", "low", "n").join(degree, "cls", "left")
                     .join(comps.withColumnRenamed("node", "cls"), "cls", "left")
                     .select("k1", "k2", "low", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                             F.coalesce("root", "cls").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(least, "root").select("k1", "k2", "n_links", "component_id")
    inside = rows.where("usable").select("vec_id", "k1", "k2").join(named, ["k1", "k2"]).select(
        "vec_id", "n_links", "component_id")
    outside = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                              F.col("vec_id").alias("component_id"))
    return inside.unionByName(outside).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _compare(classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a, b, links) per class and task."""
    key = ["label", "dim"]
    sizes = classes.groupBy(*key).agg(F.count("*").alias("rows"))
    large = sizes.where(F.col("rows") > block).orderBy(F.desc("rows"), *key).limit(PIVOT_LABELS).collect()
    pivots: dict[tuple[str, int], np.ndarray] = {}
    if large:
        each = max(2, PIVOTS // len(large))
        for r in large:
            count = min(each, math.ceil(r["rows"] / block))
            sample = (classes.where((F.col("label") == r["label"]) & (F.col("dim") == r["dim"]))
                      .select("emb", F.xxhash64("k1").alias("h")).orderBy("h").limit(count).collect())
            pivots[r["label"], r["dim"]] = _unit(np.array([s["emb"] for s in sample], np.float64))
    # components keep their precision: float as float, anything else as double
    kind = "array<float>" if isinstance(classes.schema["emb"].dataType.elementType, T.FloatType) else "array<double>"
    fields = f"label string, dim int, cls long, n long, emb {kind}"
    columns = [f.split()[0] for f in fields.split(", ")]

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
        own = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for k in set(own) & pivots.keys():
            yield k, np.array([n for n, x in enumerate(own) if x == k])

    def assign(batch: pa.RecordBatch) -> dict:
        cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
        for k, at in groups(batch):
            away = _distance(_unit(_matrix(batch.column(4).take(pa.array(at)))), pivots[k])
            cell[at], far[at] = away.argmin(axis=1), away.min(axis=1)
        return {c: batch.column(i) for i, c in enumerate(columns)} | {"cell": pa.array(cell), "far": pa.array(far)}

    rows = classes.select("label", "dim", "cls", "n", F.col("emb").cast(kind).alias("emb"))
    homes = written(arrow_map(rows, assign, fields + ", cell int, far double"), "homes")
    radius = {k: np.full(len(p), -1.0) for k, p in pivots.items()}
    if pivots:
        for r in homes.groupBy(*key, "cell").agg(F.max("far").alias("far")).join(
                F.broadcast(sizes.where(F.col("rows") > block).orderBy(F.desc("rows"), *key)
                            .limit(PIVOT_LABELS).select(*key)), key).collect():
            radius[r["label"], r["dim"]][r["cell"]] = r["far"]
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + _SLACK

    def visit(batch: pa.RecordBatch) -> dict:
        """Lower cells whose ball the row's own ball of the threshold touches."""
        home, which, cells = batch.column(5).to_numpy(), [], []
        for k, at in groups(batch):
            away = _distance(_unit(_matrix(batch.column(4).take(pa.array(at)))), pivots[k])
            near = (away <= radius[k][None, :] + reach) & (radius[k] >= 0)[None, :]
            near &= np.arange(len(radius[k]))[None, :] < home[at][:, None]
            i, c = np.nonzero(near)
            which.append(at[i])
            cells.append(c)
        at = np.concatenate(which) if which else np.empty(0, np.int64)
        cell = np.concatenate(cells) if cells else np.empty(0, np.int64)
        return {c: batch.column(i).take(pa.array(at)) for i, c in enumerate(columns)} | {
            "cell": pa.array(cell.astype(np.int32))}

    guests = written(arrow_map(homes.select(*columns, "cell"), visit, fields + ", cell int"), "guests")
    place = [*key, "cell"]
    counted = homes.groupBy(*place).agg(F.count("*").alias("homes")).join(
        guests.groupBy(*place).agg(F.count("*").alias("guests")), place, "left").select(
        *place, F.ceil(F.col("homes") / block).cast("int").alias("nb"),
        F.ceil((F.when(F.col("homes") > block, F.col("homes")).otherwise(0)
                + F.coalesce("guests", F.lit(0))) / block).cast("int").alias("nv"))
    counted = written(counted, "cells")
    nth = F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int")
    seat = F.pmod(F.xxhash64("cls", F.lit(3)), F.col("nv")).cast("int")
    none = F.array().cast("array<struct<i: int, v: int, side: int>>")

    def tasks(i, v, side):
        return F.struct(F.lit(i).cast("int").alias("i") if isinstance(i, int) else i.alias("i"),
                        F.lit(v).cast("int").alias("v") if isinstance(v, int) else v.alias("v"),
                        F.lit(side).alias("side"))

    at_home = homes.drop("far").join(counted, place).withColumn("nth", nth).withColumn("tasks", F.concat(
        F.array(tasks(F.col("nth"), -1, 0)),
        F.when(F.col("nv") > 0, F.transform(F.sequence(F.lit(0), F.col("nv") - 1),
                                            lambda v: tasks(F.col("nth"), v, 0))).otherwise(none),
        F.when((F.col("nb") > 1) & (F.col("nth") > 0) & (F.col("nv") > 0),
               F.transform(F.sequence(F.lit(0), F.col("nth") - 1),
                           lambda i: tasks(i, seat, 1))).otherwise(none)))
    visiting = guests.join(counted, place).withColumn("nth", nth).withColumn("tasks", F.transform(
        F.sequence(F.lit(0), F.col("nb") - 1), lambda i: tasks(i, seat, 1)))
    dealt = at_home.unionByName(visiting).select(*place, "cls", "n", "emb", F.inline("tasks"))
    useful = dealt.groupBy(*place, "i", "v").applyInArrow(
        _only_if_both(_task(threshold)), "a long, b long, links long")
    return useful


def _only_if_both(compare):
    """A visitors' task without visitors or without home rows has no pair."""
    def run(rows: pa.Table) -> pa.Table:
        side = rows["side"].to_numpy()
        alone = rows["v"][0].as_py() == -1
        if not alone and (not (side == 0).any() or not (side == 1).any()):
            return pa.table({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64), "links": np.empty(0, np.int64)})
        return compare(rows)
    return run


def op4_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``embeddings``."""
    return linked(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


#: DuckDB SQL for the contract query; exact on small tables.
OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM v
  UNION
  SELECT r.node, p.b AS seen FROM reach r JOIN pairs p ON r.seen = p.a
), low AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), degree AS (
  SELECT a, count(*) AS n FROM pairs GROUP BY a
)
SELECT v.vec_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links, low.component_id,
       v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.node = v.vec_id LEFT JOIN degree ON degree.a = v.vec_id
"""
