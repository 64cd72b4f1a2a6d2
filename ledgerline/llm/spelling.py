"""Spelling variant grouping: words one edit apart, by a scan over sorted lists.

A vocabulary is sorted twice, by its words and by its words read backwards, and
each list is cut into chunks. Two words one edit apart share the first or the
last half of their letters: the first list finds the pairs whose edit lies in
the second half of a word, the second list the others. A word visits only the
chunks that may hold a word with its own first half.

In a chunk the word walks along the list. The three cells of the edit matrix
around the diagonal (all that matters up to one edit) are kept per depth, and
the rows that a list word shares with the one before it (its longest common
prefix) are taken over. Where all three cells exceed one edit, every following
word that shares this prefix is skipped.

Dealing out: counts are added up before they are shuffled; chunks hold about
``CHUNK`` words whatever prefix is hot; the chunks' first and last words (64
letters each, 65,536 chunks at most, then chunks grow) go to every task; a
task holds one chunk and one batch of visiting words.

Cases: a null text has no words; a null id counts as the empty text in the
hash; words of any length; repeated rows count each time; without words there
are no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, ship, table, written

CHUNK = 8192
MAX_CHUNKS = 65_536
BOUND_LETTERS = 64
#: Distinct words held by a task before their counts are handed on.
HELD_WORDS = 100_000
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form occurs at least so many times as often as its variant.
FORM_RATIO = 10
RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LAST = "\U0010FFFF"


# --- words -------------------------------------------------------------------

def worn(run: str, seed: int, every: int = 31) -> str:
    """The run, without one letter where crc32 of the seed's text and the run is a multiple of ``every``."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words_of(text: str | None, key: str, least: int = LEAST_LETTERS) -> Counter:
    """Words of a text with at least ``least`` letters and how often they occur."""
    out: Counter = Counter()
    seed = zlib.crc32(f"{key}:".encode())
    plain = (text or "").encode().lower().decode()      # of bytes, only A-Z change
    for run, n in Counter(RUNS.findall(plain)).items():
        if len(run) >= least and len(word := worn(run, seed)) >= least:
            out[word] += n
    return out


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, times: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``least`` letters that occur ``times`` or more in all texts."""
    ship(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             schema=schema)
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(words_of(text, key or "", least))
                if len(held) >= HELD_WORDS:
                    yield handed()
        if held:
            yield handed()

    rows = docs.select(F.col("doc_id").cast("string").alias("key"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


# --- the scan ----------------------------------------------------------------

def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:       # a[:low] == b[:low], a[:high] != b[:high]
        mid = (low + high) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid
    return low


def advance(row: tuple[int, int, int], letter: str, word: str, depth: int) -> tuple[int, int, int]:
    """The next matrix row after ``letter``: distances to word[:depth], word[:depth + 1], word[:depth + 2].

    ``row`` has those to word[:depth - 1], word[:depth], word[:depth + 1]; 2 stands for more than one.
    """
    a, b, c = row
    before, here, after = (word[depth - 1:depth] if depth else "", word[depth:depth + 1], word[depth + 1:depth + 2])
    left = min(a + (letter != before), b + 1)
    middle = min(b + (letter != here), c + 1, left + 1)
    right = min(c + (letter != after), middle + 1)
    return min(left, 2), min(middle, 2), min(right, 2)


DEAD = (2, 2, 2)


def _machine() -> tuple[list[list[int]], list[tuple[int, int, int]]]:
    """All rows that can follow the first one, and per row its successor by which of the three letters
    around the diagonal the new letter equals (1, 2, 4); row 0 is the dead one, row 1 the first."""
    rows, steps = [DEAD, (1, 0, 1)], []
    for row in rows:        # grows while it is read
        own = []
        for equal in range(8):
            letters = ["x" if equal >> k & 1 else "o" for k in range(3)]
            new = advance(row, "x", "".join(letters), 1)
            if new not in rows:
                rows.append(new)
            own.append(rows.index(new))
        steps.append(own)
    return steps, rows


STEPS, ROWS = _machine()


class SortedList:
    """Sorted distinct words with the common prefixes of neighbours."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lcp = [0] + [shared(a, b) for a, b in zip(words, words[1:])] + [-1]
        #: The next place whose common prefix with its predecessor is shorter.
        self.shorter = [0] * len(self.lcp)
        open_: list[int] = []
        for k, n in enumerate(self.lcp):
            while open_ and self.lcp[open_[-1]] > n:
                self.shorter[open_.pop()] = k
            open_.append(k)

    def near(self, word: str, same: int) -> list[int]:
        """Places of the words one edit from ``word`` that share its first ``same`` letters."""
        words, lcp, shorter, steps = self.words, self.lcp, self.shorter, STEPS
        at = bisect_left(words, word[:same])
        end = bisect_left(words, word[:same] + LAST, at)
        long, found = len(word), []
        around = ["", *word, "", "", ""]    # no letter equals what is beyond the ends
        rows = [1] * (long + 3)         # rows[d]: the row of the list word's first d letters
        known = same                    # depth up to which rows hold for the word at ``at``
        while at < end:
            own, depth = words[at], known
            row, size = rows[depth], len(own)
            while depth < size:
                letter = own[depth]
                row = steps[row][(letter == around[depth]) + 2 * (letter == around[depth + 1])
                                 + 4 * (letter == around[depth + 2])]
                depth += 1
                if not row:
                    break
                rows[depth] = row
            if row:
                dead = size + 1
                if -1 <= long - size <= 1 and ROWS[row][long - size + 1] == 1:
                    found.append(at)
            else:
                dead = depth
            at += 1
            known = lcp[at]
            while known >= dead:
                at = shorter[at]
                known = lcp[at]
            if known > depth:
                known = depth
        return found


def may_hold(word: str, same: int, common: str) -> bool:
    """Whether a word that begins with ``common`` may share ``word``'s first letters and be one edit away."""
    if not common.startswith(word[:same]) and not word.startswith(common[:same]):
        return False
    row = (1, 0, 1)
    for depth in range(same, len(common)):
        row = advance(row, common[depth], word, depth)
        if row == DEAD:
            return False
    return True


def visits(word: str, lows: list[str], highs: list[str]) -> Iterator[int]:
    """Which of the sorted chunks may hold a near word with the first half of ``word``.

    ``lows`` and ``highs`` are the chunks' first and last words, cut to
    ``BOUND_LETTERS``; the cut ones stand for all words that begin with them.
    """
    same = len(word) // 2
    head = word[:same]
    at = bisect_left(highs, head[:BOUND_LETTERS])
    while at < len(lows) and lows[at] <= head + LAST:
        if may_hold(word, same, lows[at][:shared(lows[at], highs[at])]):
            yield at
        at += 1


def _lists(words: DataFrame, chunk: int) -> DataFrame:
    """(way, chunk, key, n): the sorted lists in both ways, numbered by range partitions."""
    total = words.count()
    parts = max(1, min(MAX_CHUNKS, math.ceil(total / chunk)))
    made = []
    for way, key in ((0, F.col("word")), (1, F.reverse("word"))):
        rows = words.select(F.lit(way).alias("way"), key.alias("key"), "n")
        made.append(rows.repartitionByRange(parts, "key").withColumn("chunk", F.spark_partition_id()))
    return written(made[0], "forward").unionByName(written(made[1], "backward"))


def near_words(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(word, n_near, nearest): per word of (word, n) how many words are one edit away, and of
    these the one of largest n (nearest.form, nearest.n; ties: the smallest); absent without any."""
    lists = _lists(words, chunk)
    # two words of at most BOUND_LETTERS letters for each of at most 2 * MAX_CHUNKS chunks
    cut = F.substring("key", 1, BOUND_LETTERS)
    bounds = lists.groupBy("way", "chunk").agg(F.min(cut).alias("low"), F.max(cut).alias("high")).orderBy("way", "low").collect()
    sides = [[r for r in bounds if r["way"] == way] for way in (0, 1)]
    own = [([r["chunk"] for r in side], [r["low"] for r in side], [r["high"] for r in side]) for side in sides]

    def route(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"way": [], "chunk": [], "key": []}
        for word in batch.column(0).to_pylist():
            for way, key in ((0, word), (1, word[::-1])):
                chunks, lows, highs = own[way]
                for k in visits(key, lows, highs):
                    out["way"].append(way)
                    out["chunk"].append(chunks[k])
                    out["key"].append(key)
        return out

    visitors = arrow_map(words.select("word"), route, "way int, chunk int, key string")
    both = lists.withColumn("visit", F.lit(False)).unionByName(visitors.withColumns({"visit": F.lit(True), "n": F.lit(None).cast("long")}))
    found = _scanned(both.repartition("way", "chunk").sortWithinPartitions("way", "chunk", "visit", "key"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.struct(F.col("best.form").alias("form"), (-F.col("best.less")).alias("n")).alias("nearest"))


def _scanned(rows: DataFrame) -> DataFrame:
    """(word, near, form, n) per visiting word and chunk with near words; ``form`` is the one of largest n."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("form", pa.string()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, listed = None, [], [], None
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("way", "chunk", "visit", "key", "n")]
            for way, chunk, visit, key, n in zip(*columns):
                if (way, chunk) != now:
                    now, keys, counts, listed = (way, chunk), [], [], None
                if not visit:
                    keys.append(key)
                    counts.append(n)
                    continue
                if listed is None:
                    listed = SortedList(keys)
                half = len(key) // 2
                # the forward list has the pairs that share the first half of the word
                ahead = key[::-1][:half]
                found = [k for k in listed.near(key, half) if not way or not keys[k][::-1].startswith(ahead)]
                if found:
                    most = max(counts[k] for k in found)
                    form = min(keys[k][::-1] if way else keys[k] for k in found if counts[k] == most)
                    out["word"].append(key[::-1] if way else key)
                    out["near"].append(len(found))
                    out["form"].append(form)
                    out["n"].append(most)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return rows.select("way", "chunk", "visit", "key", "n").mapInArrow(run, "word string, near long, form string, n long")


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """``forms`` (word, form, ...) with ``root``: the last of at most ``steps`` forms, the word itself without any."""
    out = forms.withColumn("root", F.coalesce("form", "word"))
    step = forms.where(F.col("form").isNotNull()).select(F.col("word").alias("__at"), F.col("form").alias("__next"))
    for _ in range(steps - 1):
        out = out.join(step, F.col("root") == F.col("__at"), "left").withColumn(
            "root", F.coalesce("__next", "root")).drop("__at", "__next")
    return out


def variants(words: DataFrame, ratio: int = FORM_RATIO, chunk: int = CHUNK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of (word, n).

    Forms grow ``ratio``-fold, so a chain of forms is as long as the logarithm
    of the largest count at most.
    """
    words = written(words, "vocabulary")
    most = words.agg(F.max("n"), F.min("n")).first()
    steps = 1 if not most[0] else 1 + int(math.log(max(1, most[0] // max(1, most[1])), ratio) + 1e-9)
    found = near_words(words, chunk)
    is_form = F.col("nearest.n") >= ratio * F.col("n")
    forms = written(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("nearest.form")).alias("form"), F.when(is_form, F.col("nearest.n")).alias("form_n")), "forms")
    return roots(forms, steps)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return variants(vocabulary(table(spark, sf_dir, "documents", "doc_id", "text"))).select(
        "word", "form", "root", "n", "n_near", "form_n")
