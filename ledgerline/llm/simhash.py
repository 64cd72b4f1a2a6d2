"""SimHash near-duplicates by a segment-popcount grid.

Fingerprints link at ``max_bits`` or fewer differing bits. A fingerprint is
embedded as the bit counts of its 64 / ``segment`` segments; flipping one bit
moves one count by one, so the Manhattan distance of two count vectors is a
lower bound of their Hamming distance. The grid cuts the count vector into
``max_bits + 3`` blocks of neighbouring segments: vectors within distance d
differ in at most d blocks, so they agree on at least three whole blocks and
share a cell keyed by that choice of three. Inside a cell the Manhattan bound
goes first, the exact bit distance last.

Copies never meet in a join: one row per distinct fingerprint enters the grid.
A cell with more than ``cell_rows`` distinct fingerprints (one template with
thousands of variants) is not paired at all: two fingerprints within two bits
have a common neighbour within one bit, so each member is sent to its 65
one-bit neighbours (for other even radii d: to all values within d / 2 bits) and
those that meet are linked to the smallest. That is linear in the cell and
finds exactly the same components.

Cases: a null or word-less text has fingerprint zero and links like any other;
a text with fewer words than the shingle length hashes its whole word sequence;
repeated rows and equal texts share a fingerprint; an empty table gives no
rows; null ids keep their row and never become a component's id unless all its
ids are null. Other columns of the input are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, components, only, table, text_key, utf8, written

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
SEGMENT_BITS = 2
CELL_ROWS = 48


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a UTF-8 text (A-Z lower-cased)."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), seed)
    joined = b" ".join(tokens)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces[: len(tokens) - words] + 1).tolist()]
    ends = [*spaces[words - 1:].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    step = 1 << 15
    for at in range(0, len(starts), step):
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(starts[at:at + step], ends[at:at + step])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per input row."""
    def batch(rows: pa.RecordBatch) -> dict:
        fps = [fingerprint(t, words, seed) for t in utf8(rows, "text")]
        return {"doc_id": rows.column(0), "fp": pa.array(np.array(fps, np.uint64).view(np.int64))}

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return arrow_map(rows, batch, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _segment_counts(fp: Column, segment: int) -> list[Column]:
    mask = F.lit((1 << segment) - 1).cast("long")
    return [F.bit_count(F.shiftrightunsigned(fp, k).bitwiseAND(mask)) for k in range(0, 64, segment)]


def _cells(fps: DataFrame, max_bits: int, segment: int) -> DataFrame:
    """(cell, fp) for every choice of three blocks of segment counts."""
    counts = _segment_counts(F.col("fp"), segment)
    blocks = np.array_split(np.arange(len(counts)), max_bits + 3)
    keys = [F.xxhash64(F.lit(n), *[counts[i] for b in choice for i in blocks[b]])
            for n, choice in enumerate(combinations(range(len(blocks)), 3))]
    return fps.select("fp", F.explode(F.array(*keys)).alias("cell"))


def _balls(fps: DataFrame, bits: int) -> DataFrame:
    """(center, fp) for every value within ``bits`` bits of fp."""
    masks = [0]
    for n in range(1, bits + 1):
        masks += [sum(1 << i for i in c) for c in combinations(range(64), n)]
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    return fps.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("m")
                      ).select(F.col("fp").bitwiseXOR(F.col("m")).alias("center"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, segment: int = SEGMENT_BITS,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links.

    ``fps`` has one row per distinct fingerprint. Every edge is at most
    ``max_bits`` apart (an even radius; crowded cells link through a common
    neighbour) and no component is split.
    """
    if max_bits % 2:
        raise ValueError("crowded cells are linked through common neighbours: use an even radius")
    cells = written(_cells(fps, max_bits, segment), "cells")
    size = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    sized = written(cells.join(size, "cell"), "cells")
    small = sized.where(F.col("n") <= cell_rows).select("cell", "fp")
    left, right = small.withColumnRenamed("fp", "a"), small.withColumnRenamed("fp", "b")
    manhattan = sum((F.abs(x - y) for x, y in zip(_segment_counts(F.col("a"), segment),
                                                  _segment_counts(F.col("b"), segment))), F.lit(0))
    pairs = (left.join(right, "cell").where("a < b").where(manhattan <= max_bits)
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b"))
    crowded = sized.where(F.col("n") > cell_rows).select("fp").distinct()
    balls = _balls(crowded, max_bits // 2)
    least = balls.groupBy("center").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = balls.join(least.drop("n"), "center").where("a != fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id, class_id) of every row.

    ``class_id`` is the smallest id with the same fingerprint, ``component_id``
    the smallest id reachable over links, itself included.
    """
    prints = written(fingerprints(docs, id_column, text_column, words), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("class_id")), "classes")
    comps = components(links(classes.select("fp"), max_bits))
    rooted = written(classes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "class_id", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "class_id", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id", "class_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies one row stays, the one of smallest (id, text hash).

    Rows without an id are compared like others and come last; a row repeated
    with the same id and text stays once. Of an id that names several texts
    only those stay that are the first of their group.
    """
    key = F.coalesce(text_key(F.col("text")), F.lit(""))
    texts = docs.select(key.alias("key"), "text")
    found = near_duplicates(texts, "key")      # a text, not a row, has a fingerprint
    groups = written(found.groupBy("doc_id").agg(F.min("component_id").alias("group")), "groups")
    rows = docs.select("doc_id", key.alias("key")).join(groups.withColumnRenamed("doc_id", "of"), F.col("key") == F.col("of"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("row"))
    return only(docs, first.select("row.doc_id", F.nullif("row.key", F.lit("")).alias("__text")))
