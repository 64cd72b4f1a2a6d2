import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import spelling as S
from tests.llm.helpers import docs, save


def one_edit(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def by_hand(counts):
    words = sorted(w for w, n in counts.items() if n >= 2 and len(w) >= 7)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def counted(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return out


def result(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def vocabulary(seed, n, letters, least=1, most=9):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)})


@pytest.mark.parametrize("seed", range(12))
def test_both_lists_give_every_pair_once(seed):
    words = vocabulary(seed, 200, ["ab", "abcé", "abcdefgh"][seed % 3])
    ahead, back = S.SortedList(words), S.SortedList(sorted(w[::-1] for w in words))
    for w in words:
        half = len(w) // 2
        found = [words[k] for k in ahead.near(w, half)]
        assert found == [x for x in words if one_edit(w, x) and x[:half] == w[:half]]
        if half:
            found += [x for k in back.near(w[::-1], half) if not (x := back.words[k][::-1]).startswith(w[:half])]
            assert sorted(found) == [x for x in words if one_edit(w, x)]


@pytest.mark.parametrize("seed", range(8))
def test_no_chunk_with_a_near_word_is_left_out(seed, monkeypatch):
    monkeypatch.setattr(S, "BOUND_LETTERS", 3 + seed)
    words = vocabulary(seed, 150, "abc")
    size = 1 + seed
    chunks = [words[k:k + size] for k in range(0, len(words), size)]
    lows, highs = ([c[end][:S.BOUND_LETTERS] for c in chunks] for end in (0, -1))
    for w in words:
        asked = set(S.visits(w, lows, highs))
        assert asked >= {k for k, c in enumerate(chunks) if any(one_edit(w, x) and x[:len(w) // 2] == w[:len(w) // 2] for x in c)}


def test_skipping_passes_over_dead_ranges():
    words = sorted({"same" + a + b + c for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"})
    seen = []

    class Counted(list):
        def __getitem__(self, k):
            seen.append(k)
            return super().__getitem__(k)

    listed = S.SortedList(words)
    listed.words = Counted(words)
    assert len(listed.near("sameabc", 4)) == 21
    assert len(set(seen)) < 300     # of 512 words


@pytest.mark.parametrize("chunk", [3, 20, 8192])
def test_variants_against_all_pairs(spark, chunk):
    rng = random.Random(3)
    words = vocabulary(5, 120, "abcdé", 7, 9) + ["q" * 400, "q" * 401, "q" * 7, "hotprefix" + "a" * 5]
    words += ["hotprefix" + "".join(rng.choice("ab") for _ in range(5)) for _ in range(40)]
    counts = Counter({w: rng.choice([2, 3, 5, 25, 60, 700, 9000]) for w in words})
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(S.variants(df, chunk=chunk)) == by_hand(counts)


def test_query_on_whole_texts(spark, tmp_path):
    rng = random.Random(8)
    some = [("Überführen", 30), ("straße", 9), ("received", 60), ("recieved", 4), ("documents", 80), ("documnts", 3),
            ("document", 7), ("ÀÉÎÕÜÿç", 12), ("seven77seven", 3), ("categorys", 2), ("abcdefg", 2)]
    pool = [w for w, n in some for _ in range(n)]
    rows = [(i, " ".join(rng.choices(pool, k=60)).upper() if i % 7 == 0 else "-".join(rng.choices(pool, k=60)))
            for i in range(80)]
    rows += [(None, "documents received"), (3, None), (4, ""), (5, "x" * 30000), (6, "x" * 30000), (3, "Documents"), (3, "Documents")]
    df = spark.createDataFrame([(i, t, *["clash"] * 4) for i, t in rows],
                               "doc_id long, text string, word string, n string, form string, chunk string")
    save(df, tmp_path, "documents")
    got = result(S.op13_spelling(spark, str(tmp_path)))
    assert got == by_hand(counted(rows))
    assert any(form for _, form, *_ in got)


def test_empty_table(spark, tmp_path):
    save(docs(spark, []), tmp_path, "documents")
    assert S.op13_spelling(spark, str(tmp_path)).count() == 0
