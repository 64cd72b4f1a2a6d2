import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from ledgerline.llm import lm
from tests.llm.helpers import awkward, docs, remainder, save


def texts(n=160):
    rng = random.Random(6)
    some = [f"w{k}" for k in range(25)]
    return [(i, " ".join(rng.choices(some, weights=[1 / (k + 1) for k in range(25)], k=rng.randint(0, 60)))) for i in range(n)]


def slow(rows, held, discount=0.75, order=3):
    """(base score, score) per row from plain dictionaries."""
    def tokens(t):
        return [w.decode() for w in (t or "").encode().lower().split()] + [" "]
    train = [tokens(t) for i, t in rows if not held(i)]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([None, *t], t))
    three = Counter(p for t in train for p in zip([None, *t], t, t[1:]))
    n, v = sum(one.values()), len(one)
    total = lambda w: len(train) if w is None else one[w]
    kept2, kept3 = defaultdict(float), defaultdict(float)
    for (a, _), c in two.items():
        kept2[a] += (c - discount) / total(a)
    for (a, b, _), c in three.items():
        kept3[a, b] += (c - discount) / two[a, b]
    out = []
    for _, t in rows:
        own, base, score = [None, *tokens(t)], 0.0, 0.0
        for k in range(1, len(own)):
            p = (one[own[k]] + 1) / (n + v + 1)
            base += math.log10(p)
            a, w = own[k - 1], own[k]
            p = ((two[a, w] - discount) / total(a) if (a, w) in two else 0) + (1 - kept2[a]) * p
            if order > 2 and k > 1 and (own[k - 2], a) in two:
                q = (own[k - 2], a)
                p = ((three[(*q, w)] - discount) / two[q] if (*q, w) in three else 0) + (1 - kept3[q]) * p
            score += math.log10(p)
        out.append((len(own) - 1, sum(w in one for w in own[1:]), n, base, score))
    return out


def test_query_matches_plain_dictionaries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_ROWS", 40)  # contexts span segments
    rows = texts() + [(200 + k, r[1]) for k, r in enumerate(awkward())]
    save(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "documents")
    got = {r["doc_id"]: r for r in lm.op3_lm(spark, str(tmp_path)).collect()}
    for (i, _), (tokens, known, n, base, score) in zip(rows, slow(rows, lambda i: remainder(i, 7) == 2)):
        r = got[i]
        assert r["held_out"] == (remainder(i, 7) == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, abs=0.02 * tokens + 1e-6)


def test_probabilities_sum_to_one(spark):
    rows = spark.createDataFrame(texts(), "doc_id long, text string")
    model = lm.vocabulary(rows)
    model = lm.learn(lm.encoded(rows, model), model)
    reader = lm.reader(model)
    words = [f"w{k}".encode() for k in range(25)] + [lm.END, b"unseen"]
    for prefix in (b"", b"w0", b"w0 w1", b"w3 w0", b"unseen w1"):
        total = 0.0
        for w in words:
            tokens = np.array([*[reader.encode([prefix])], ], dtype=object)
            ids = np.frombuffer(tokens[0][0], "i4").astype(np.int64)[:-1]
            last = reader.words.find(lm.hashed([w]))
            own = np.concatenate([ids, last])
            p = (reader.words.count(own) + 1) / (model.tokens + model.words + 1)
            for _, _, share, weight in reader.walk(own, np.array([0])):
                p = share + weight * p
            total += p[-1]
        assert total == pytest.approx(1, abs=0.02)


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for n, top in ((1, 1), (10, 3), (500, 10), (500, 10**6), (3000, 10**12), (200, 1)):
        values = np.sort(rng.integers(0, top, n))
        ef = lm.EliasFano.build(values)
        assert (ef.get(np.arange(n)) == values).all()
        assert (ef.get(rng.integers(0, n, 50)) >= 0).all()


def test_empty_table_and_no_training_rows(spark, tmp_path):
    save(docs(spark, []), tmp_path, "documents")
    assert lm.op3_lm(spark, str(tmp_path)).count() == 0
    held = next(i for i in range(100) if remainder(i, 7) == 2)
    save(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), tmp_path, "documents")
    row = lm.op3_lm(spark, str(tmp_path)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (3, 0, 0, 0.0)


def test_unmounted_shared_folder_is_refused(spark, monkeypatch):
    monkeypatch.setattr(lm, "scratch", lambda *_: "hdfs://somewhere/lm")
    with pytest.raises(RuntimeError, match="mount"):
        lm._model_folder(spark)


def whole(rows, held, discount=0.75):
    """The score per row from plain dictionaries of all n-grams, also those that occur once."""
    padded = {i: [None, *[w.decode() for w in (t or "").encode().lower().split()], " "] for i, t in rows}
    train = [t for i, t in padded.items() if not held(i)]
    one = Counter(w for t in train for w in t)  # None: the begin context
    two = Counter(p for t in train for p in zip(t, t[1:]))
    three = Counter(p for t in train for p in zip(t, t[1:], t[2:]))
    after, after2 = Counter(a for a, _ in two), Counter((a, b) for a, b, _ in three)
    n, v = sum(c for w, c in one.items() if w is not None), len(one) - 1
    for i, t in padded.items():
        score = 0.0
        for k in range(1, len(t)):
            p = (one[t[k]] + 1) / (n + v + 1)
            for q, grams, total, kinds in ((tuple(t[k - 1:k]), two, one[t[k - 1]], after[t[k - 1]]),
                                           (tuple(t[max(0, k - 2):k]), three, two[tuple(t[max(0, k - 2):k])],
                                            after2[tuple(t[max(0, k - 2):k])])):
                if total and (len(q) == 2 or grams is two):
                    p = max(0, grams[(*q, t[k])] - discount) / total + discount * kinds / total * p
            score += math.log10(p)
        yield i, score, len(t) - 1


def test_ngrams_that_occur_once_are_scored(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(80)], k=40))) for i in range(120)]  # most trigrams once
    save(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "documents")
    got = {r["doc_id"]: r["score"] for r in lm.op3_lm(spark, str(tmp_path)).collect()}
    for i, score, tokens in whole(rows, lambda i: remainder(i, 7) == 2):
        assert got[i] == pytest.approx(score, abs=0.005 * tokens)


def test_ngrams_are_shuffled_once_into_bounded_segments(spark, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_ROWS", 400)
    tables = []
    stored = lm._stored
    monkeypatch.setattr(lm, "_stored", lambda df, name: tables.append(name) or stored(df, name))
    rows = spark.createDataFrame([(i, t + " the the the") for i, t in texts()], "doc_id long, text string")
    model = lm.vocabulary(rows)
    model = lm.learn(lm.encoded(rows, model), model)
    assert tables == ["words"]  # n-grams are in the shuffle and in the segments, in no table between
    three = {(a, b, c) for _, t in texts() for own in [[None, *f"{t} the the the".split(), " "]]
             for a, b, c in zip(own, own[1:], own[2:])}
    assert sum(s.rows for s in model.levels[2]) == len(three)
    for level in model.levels[1:]:
        assert len(level) > 1 and max(s.rows for s in level) <= 800
        assert all((a.last, a.number) <= (b.first, b.number) for a, b in zip(level, level[1:]))


def test_words_of_many_texts_are_hashed_at_once():
    rng = random.Random(3)
    words = [bytes(rng.randrange(1, 256) for _ in range(n)) for n in [*range(70), 500] for _ in range(4)]
    assert (lm.hashed(words) == np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64).view(np.int64)).all()
    own = [None, b"", b"  One two\x0bTHREE\x1cfour \xc3\x84\x00 ", b"x" * 40 + b"\r\ny\n", b"z"]
    (tokens, first), = lm.tokenised(own)
    want = [[*(t or b"").lower().split(), lm.END] for t in own]
    assert (tokens == lm.hashed(sum(want, []))).all()
    assert first.tolist() == [sum(map(len, want[:k])) for k in range(len(want))]


def test_lookups_leave_alone_the_segments_that_hold_nothing_asked(spark, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_ROWS", 60)
    rows = spark.createDataFrame(texts(), "doc_id long, text string")
    model = lm.vocabulary(rows)
    model = lm.learn(lm.encoded(rows, model), model)
    own = lm.reader(model)
    assert lm.reader(model) is own and len(model.levels[1]) > 3
    read, get = [], lm.EliasFano.get
    monkeypatch.setattr(lm.EliasFano, "get", lambda self, i: read.append(self) or get(self, i))
    level = own.levels[0]
    entry = level.segments[1]
    asked = [np.array([entry.first]), np.array([entry.first_rel])]
    found = level.find(*asked)
    assert found[0][0] == level.starts[1] and read == [level.pointers[1]]
    # contexts that are read through, those that are searched, and ids beyond 32 bits find the same
    context, successor = np.divmod(np.random.default_rng(1).integers(-1, 30 * 30, 4000), 30)
    once = level.find(context, successor)
    monkeypatch.setattr(lm, "READ_THROUGH", 0)
    for a, b in zip(once, level.find(context, successor)):
        assert (a == b).all()
    wide = level.find(np.append(context, 1 << 40), np.append(successor, 0))
    assert all((a == b[:-1]).all() for a, b in zip(once, wide)) and wide[0][-1] == -1
