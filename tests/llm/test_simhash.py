import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash
from tests.llm.helpers import awkward, docs, words


def slow_fingerprint(text):
    tokens = [w.decode() for w in (text or "").encode().lower().split()]
    shingles = [" ".join(tokens[i:i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(rows, max_bits=2):
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    parent = list(range(len(fps)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= max_bits:
                parent[find(a)] = find(b)
    lowest = {}
    for k, (i, _) in enumerate(fps):
        lowest.setdefault(find(k), []).append(i)
    ids = {r: min((i for i in v if i is not None), default=None) for r, v in lowest.items()}
    return sorted(((i, f"{fp:016x}", ids[find(k)]) for k, (i, fp) in enumerate(fps)), key=str)


def result(df):
    return sorted(((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in df.collect()), key=str)


def test_awkward_rows_match_brute_force(spark):
    rows = [(r[0], r[1]) for r in awkward()]
    assert result(simhash.near_duplicates(docs(spark))) == slow_components(rows)


def test_edited_copies_match_brute_force(spark):
    rng, rows = random.Random(3), []
    for n in range(120):
        tokens = words(n % 30, 200).split()
        for _ in range(n // 30):
            tokens[rng.randrange(len(tokens))] = "edit"
        rows.append((n, " ".join(tokens)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(simhash.near_duplicates(frame)) == slow_components(rows)


@pytest.mark.parametrize("cell_rows", [1, 3, 1000])
def test_links_find_all_components_however_cells_are_handled(spark, cell_rows):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for b in base for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), cell_rows=cell_rows)
    got = {(r["a"], r["b"]) for r in edges.collect()}

    def groups(pairs):
        parent = {f: f for f in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in pairs:
            parent[find(a)] = find(b)
        out = {}
        for f in signed:
            out.setdefault(find(f), set()).add(f)
        return sorted(map(sorted, out.values()))

    mask = (1 << 64) - 1
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2]
    assert all((a ^ b & mask).bit_count() and ((a ^ b) & mask).bit_count() <= 2 for a, b in got)
    assert groups(got) == groups(pairs)


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), max_bits=3)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_stage_keeps_one_document_of_each_group(spark):
    frame = docs(spark)
    kept = simhash.dedup_stage(spark, frame, "")
    assert kept.columns == frame.columns
    ids = sorted(r["doc_id"] for r in kept.where(F.col("doc_id").isNotNull()).collect())
    assert ids.count(5) == 1 and 6 not in ids and {1, 2, 4, 9, 10, 11}.issubset(ids)
    assert {3, 7}.isdisjoint(ids)  # word-less like document 2
    # of the rows without an id the one with a text of its own stays, the null text is a copy of document 2
    assert [r["text"] is None for r in kept.where("doc_id IS NULL").collect()] == [False]


def test_stage_with_repeated_ids_and_clashing_names(spark):
    one, near, other = "a b c d e f g h i j k l", "a b c d e f g h i j k l", "z y x w v u t s r q p o"
    rows = [(1, one, "n"), (1, other, "n"), (2, near, "n"), (2, other, "n"), (3, other, "n"), (None, one, "n"),
            (None, "m m m n n n o o o", "n"), (1, one, "n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _nth string").withColumns(
        {c: F.lit("clash") for c in ("_text", "_other_id", "_other_text", "key", "__text", "group", "row")})
    kept = simhash.dedup_stage(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [
        ("1", one), ("1", other), ("None", "m m m n n n o o o")]
