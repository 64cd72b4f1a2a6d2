import random
import zlib
from itertools import combinations_with_replacement

import numpy as np
from tokenizers import Tokenizer

from ledgerline.llm import packing
from ledgerline.llm.bpe import default_vocabulary
from tests.llm.helpers import awkward, docs, save


def lay(intervals):
    """Every piece of a plan: (length, rank) -> (sequence, offset)."""
    out = {}
    for length, first, pieces, per, seq, offset in intervals:
        for k in range(pieces):
            assert (length, first + k) not in out
            out[length, first + k] = (seq + k // per, offset + k % per * length)
    return out


def check(counts, capacity):
    intervals, opened = packing.plan(counts, capacity)
    placed = lay(intervals)
    assert sorted(placed) == sorted((n, k) for n, c in counts.items() for k in range(c))
    bins = {}
    for (length, _), (seq, offset) in placed.items():
        bins.setdefault(seq, []).append((offset, length))
    assert len(bins) == opened
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in own) <= 2
    return opened


def fewest(items, capacity):
    best = [len(items)]

    def go(k, gaps):
        if len(gaps) >= best[0]:
            return
        if k == len(items):
            best[0] = len(gaps)
            return
        for g in {*gaps, capacity}:
            if g >= items[k]:
                rest = list(gaps)
                if g in rest:
                    rest.remove(g)
                go(k + 1, [*rest, g - items[k]])
    go(0, [])
    return best[0]


def test_plans_are_gapless_and_close_to_the_fewest():
    rng = random.Random(1)
    for _ in range(60):
        items = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 8))), reverse=True)
        counts = {n: items.count(n) for n in items}
        assert check(counts, 12) <= fewest(items, 12) + 1
    for pair in combinations_with_replacement(range(5, 13), 2):
        counts = {n: pair.count(n) for n in pair}
        assert check(counts, 12) == (1 if sum(pair) <= 12 else 2)


def test_large_plan_is_near_the_lower_bound():
    rng = random.Random(2)
    counts = {n: rng.randint(0, 40) for n in range(1, 1025)}
    opened, total = check(counts, 1024), sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if n > 512)
    assert opened <= 1.02 * max(-(-total // 1024), large)


def test_query_matches_the_tokenizer_on_awkward_rows(spark, tmp_path):
    save(docs(spark), tmp_path, "documents")
    rows = packing.op9_packing(spark, str(tmp_path)).collect()
    t, want = Tokenizer.from_file(default_vocabulary()), []
    for i, text, *_ in awkward():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024


def test_extra_columns_travel_with_their_piece(spark):
    pieces = spark.createDataFrame([(k, 1 + k % 7, f"p{k}") for k in range(50)], "key long, length long, `a b` string")
    rows = packing.pack(pieces, 8).collect()
    assert all(r["a b"] == f"p{r['key']}" and r["length"] == 1 + r["key"] % 7 for r in rows) and len(rows) == 50


def test_empty_table(spark):
    assert packing.packed(docs(spark, [])).count() == 0
