"""Best-fit packing with large-item matching.

A document is tokenised once (byte-level BPE, then an end token), cut into
pieces of the sequence capacity if it is longer (the first piece may be
shorter), and the pieces are packed into sequences:

* pieces above a third of the capacity are matched greedily, largest first,
  each with the largest other one that still fits: at most two per sequence;
* the smaller pieces, largest first, go into the smallest gap that holds them,
  and open new sequences only when no gap does.

Which pieces share a sequence depends on their lengths alone, so the plan is
made from the histogram of lengths: at most ``capacity`` counts reach the
driver however many documents there are. The plan is a list of intervals "the
k-th pieces of length L go to sequences s, s+1, ... at offset o". Pieces are
ranked within their length from partition-local numbers plus per-partition
starts, and every task looks its ranks up in the intervals: one length may hold
any share of the rows without meeting in one task.

Cases: a null text is empty and packs its end token alone; empty tables give no
rows; repeated rows are packed as often as they occur; very long texts become
many full pieces. Only id and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.bpe import WORDS, Vocabulary, default_vocabulary
from ledgerline.llm.common import arrow_map, table, written

CAPACITY = 1024
END_ID = 2


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The vocabulary file's tokenizer by ranks; its ids are in merge order."""
    import tiktoken

    v = Vocabulary(path)
    return tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=v.id_of, special_tokens=v.special)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): ids as little-endian unsigned 32-bit numbers."""
    file = path or default_vocabulary()

    def run(rows: pa.RecordBatch) -> dict:
        encode = _tokenizer(file).encode_to_numpy
        which, piece, start, length, ids = [], [], [], [], []
        for n, text in enumerate(rows.column(1).to_pylist()):
            own = np.append(encode(text or "", allowed_special="all"), end_id).astype("<u4")
            cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                which.append(n)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                ids.append(own[a:b].tobytes())
        return {"doc_id": rows.column(0).take(pa.array(which, pa.int32())), "piece": piece,
                "start": start, "length": length, "ids": ids}

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return arrow_map(rows, run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, ...]], int]:
    """Intervals (length, first rank, pieces, per sequence, first sequence, offset) and the number of sequences."""
    left = {n: c for n, c in counts.items() if c}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths lie between 1 and the capacity")
    used: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> runs of (first sequence, sequences)
    intervals: list[tuple[int, ...]] = []
    opened = 0

    def put(length: int, bins: int, per: int, first: int, offset: int) -> None:
        intervals.append((length, used[length], bins * per, per, first, offset))
        used[length] += bins * per
        left[length] -= bins * per

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        while left[length]:
            mate = next((m for m in large if m <= length and m + length <= capacity
                         and left[m] >= 1 + (m == length)), None)
            if mate is None:
                bins, rest = left[length], capacity - length
                put(length, bins, 1, opened, 0)
            else:
                bins = left[length] // 2 if mate == length else min(left[length], left[mate])
                rest = capacity - length - mate
                put(length, bins, 1, opened, 0)
                put(mate, bins, 1, opened, length)
            if rest:
                gaps[rest].append((opened, bins))
            opened += bins
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            gap = min((g for g in gaps if g >= length), default=None)
            if gap is None:
                gap, per = capacity, capacity // length
                bins = max(1, left[length] // per)
                run = (opened, bins)
                opened += bins
            else:
                run = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            first, have = run
            per = min(gap // length, left[length])
            bins = min(have, left[length] // per)
            put(length, bins, per, first, capacity - gap)
            if have > bins:
                gaps[gap].append((first + bins, have - bins))
            if rest := gap - per * length:
                gaps[rest].append((first, bins))
    return intervals, opened


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` column) plus sequence_id and offset."""
    names = pieces.columns
    kept = [f"`{c}`" for c in names]
    rows = written(pieces.select(*kept, F.spark_partition_id().alias("__part"),
                                 F.monotonically_increasing_id().alias("__pos")), "pieces")
    sizes = written(rows.groupBy("__part", "length").agg(F.count("*").alias("n")), "sizes")
    histogram = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("n")).collect()}
    intervals, _ = plan(histogram, capacity)
    by_length = {n: np.array([i[1:] for i in intervals if i[0] == n], np.int64)
                 for n in {i[0] for i in intervals}}
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    nth = F.row_number().over(Window.partitionBy("__part", "length").orderBy("__pos"))
    ranked = rows.withColumn("__nth", nth).join(starts, ["__part", "length"]).select(
        *kept, F.col("length").cast("long").alias("__length"),
        (F.col("__first") + F.col("__nth") - 1).cast("long").alias("__rank"))

    def run(batch: pa.RecordBatch) -> dict:
        length = batch.column(len(names)).to_numpy()
        rank = batch.column(len(names) + 1).to_numpy()
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            table_ = by_length[int(n)]
            first, _, per, seq, off = table_[np.searchsorted(table_[:, 0], rank[own], side="right") - 1].T
            k = rank[own] - first
            sequence[own], offset[own] = seq + k // per, off + k % per * n
        return {c: batch.column(i) for i, c in enumerate(names)} | {
            "sequence_id": pa.array(sequence), "offset": pa.array(offset)}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return arrow_map(ranked, run, f"{fields}, sequence_id long, offset long")


def packed(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The contract's columns for every piece of ``docs``."""
    pieces = token_pieces(docs, capacity)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return packed(table(spark, sf_dir, "documents", "doc_id", "text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of every remaining document."""
    return packed(docs)
