import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import pii
from tests.llm.helpers import awkward, docs, save, words


def slow(text):
    """The base patterns as they are written."""
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        d = [int(c) for c in s[::-1]]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0
    t, out = text or "", []
    out += [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]


def card(rng):
    d = [rng.randrange(10) for _ in range(15)]
    return next("".join(map(str, d)) + str(c) for c in range(10) if pii.luhn("".join(map(str, d)) + str(c)))


def private(n):
    rng, out = random.Random(n), words(n, 40).split()
    for kind in rng.sample(range(4), 2):
        out.insert(rng.randrange(len(out)), [f"u{n}@mail{n % 9}.example.com", f"10.{n % 250}.3.{n % 99}", card(rng),
                                             f"+1 (555) {100 + n % 900}-{1000 + n}"][kind])
    return " ".join(out)


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab1.9@-+ (0%_") for _ in range(60)) for _ in range(5000)]
    texts += ["1" * 5000, "1" * 400 + ".1.1.1", "a" * 3000 + "@", "a@b.c@d.e.f", "4111 1111 1111 1111", "+1(((((((2345678"]
    assert all(pii.base_spans(t) == slow(t) for t in texts)


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    model = pii.BiLstmCrf.start(rng, 3)
    windows = rng.integers(0, pii.SYMBOLS, (4, 7)).astype(np.uint8)
    labels = rng.integers(0, 5, (4, 7))
    _, grads = model.gradients(windows, labels)
    for w, g in zip(model.weights, grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        w[at] += 1e-2
        up = model.gradients(windows, labels)[0]
        w[at] -= 2e-2
        down = model.gradients(windows, labels)[0]
        w[at] += 1e-2
        assert abs((up - down) / 2e-2 - g[at]) < 2e-3 + 0.02 * abs(g[at])


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(1)
    model = pii.BiLstmCrf.start(rng, 4)
    model.moves[:] = rng.normal(0, 1, model.moves.shape)
    windows = rng.integers(0, pii.SYMBOLS, (30, 6)).astype(np.uint8)
    scores = model.emissions(model.run(windows)[0])
    for n, spans in enumerate(model.decode(windows)):
        best = max(np.ndindex(*[5] * 6), key=lambda p: sum(scores[k, t, n] for t, k in enumerate(p))
                   + sum(model.moves[a, b] for a, b in zip(p, p[1:])))
        tags = [0] * 6
        for kind, a, b, _ in spans:
            tags[a:b] = [kind + 1] * (b - a)
        assert tags == list(best)


def test_trained_model_finds_labelled_spans_and_adds_nothing_to_prose():
    windows, labels = pii.training_windows([private(n) for n in range(500)])
    model = pii.train(windows, labels, epochs=6)
    fresh = [private(n) for n in range(1000, 1060)]
    found = hit = gold = 0
    for text in fresh:
        row = pii.symbols(text)
        starts, cut = pii.cut(row)
        spans = {(k, s + a, s + b) for s, own in zip(starts, model.decode(cut)) for k, a, b, _ in own}
        want = set(slow(text))
        found, hit, gold = found + len(spans), hit + len(spans & want), gold + len(want)
    assert hit > 0.85 * gold and hit > 0.85 * found
    clean = [words(n, 300) for n in range(30)]
    assert all(not all_ for _, all_ in pii.find(clean, model))
    assert all(set(base) <= set(all_) for base, all_ in pii.find(fresh, model))


def test_spans_are_added_by_margin_and_never_over_base_spans():
    base = [(0, 10, 20)]
    found = [(1, 15, 25, 9.0), (2, 30, 40, 2.0), (3, 35, 45, 3.0), (1, 50, 60, 0.5)]
    assert pii.reconcile(base, found, 1.0) == [(0, 10, 20), (3, 35, 45)]


def test_query_on_awkward_rows(spark, tmp_path):
    save(docs(spark), tmp_path, "documents")
    rows = {(r["doc_id"], r["base_sha256"]): r for r in pii.op8_pii(spark, str(tmp_path)).collect()}
    for i, t, *_ in awkward():
        spans = sorted(slow(t))
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        row = rows[i, hashlib.sha256(text.encode()).hexdigest()]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == n for s in spans) for n in range(4)]
        assert set(filter(None, text.split(","))) <= set(row["spans"].split(","))


def test_stage_redacts_and_keeps_every_row(spark):
    frame = docs(spark)
    out = pii.pii_stage(spark, frame, "")
    assert out.columns == frame.columns and out.count() == len(awkward())
    row = out.where("doc_id = 13").first()
    assert row["text"] == "mail [EMAIL] or [PHONE] at [IP], card [CARD] ok" and row["n_chars"] == len(row["text"])


def test_empty_table(spark):
    assert pii.spans_of(docs(spark, []), pii.fitted(docs(spark, []))).count() == 0


def test_copies_take_no_place_in_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "FIT_DOCS", 150)
    monkeypatch.setattr(pii, "train", lambda windows, labels: seen.append(len({w.tobytes() for w in windows})))
    texts = [private(n) for n in range(150)]
    copies = [t for t in texts[:10] for _ in range(400)] + ["plain prose"] * 3000
    pii.fitted(spark.createDataFrame([(n, t) for n, t in enumerate(texts + copies)], "doc_id long, text string"))
    assert seen and seen[0] > 300  # all 150 texts, two spans each


def test_likely_texts_are_all_texts_with_base_spans(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1.9@-+ (0%_") for _ in range(60)) for _ in range(3000)] + [private(n) for n in range(200)]
    likely = spark.createDataFrame([(t,) for t in texts], "text string").where(F.col("text").rlike(pii._LIKELY))
    assert {t for t in texts if pii.base_spans(t)} <= {r["text"] for r in likely.collect()}


def test_no_model_from_a_handful_of_windows(spark):
    few = spark.createDataFrame([(n, private(n % 5)) for n in range(500)], "doc_id long, text string")
    assert pii.fitted(few) is None


class Marked:
    """A model that takes runs of Z for personal data."""

    limits = (0.0,) * len(pii.KINDS)

    def decode(self, windows):
        out = []
        for w in windows:
            runs = re.finditer("Z+", "".join(map(chr, np.where(w == pii.PAD, 32, w))))
            out.append([(0, m.start(), m.end(), 1.0) for m in runs])
        return out


@pytest.mark.parametrize("size", [1, 60, 120, 200])
def test_spans_over_window_edges_are_seen_whole(size):
    step = pii.WINDOW - pii.OVERLAP
    for at in (0, step - 5, step, pii.WINDOW - 1, 2 * step - size // 2, 900 - size):
        text = "." * max(0, at) + "Z" * size + "." * (900 - max(0, at) - size)
        (_, spans), = pii.find([text], Marked())
        assert spans == [(0, max(0, at), max(0, at) + size)]


def test_respelled_spans_are_learned_and_prose_is_left_alone():
    windows, labels = pii.training_windows([private(n) for n in range(500)])
    model = pii.train(windows, labels)
    rng, found, tried = np.random.default_rng(3), 0, 0
    for n in range(500, 620):
        text = private(n)
        for kind, a, b in pii.base_spans(text)[:1]:
            new = pii.respelled(kind, text[a:b], rng)
            masked = text[:a] + new + text[b:]
            if any(x < a + len(new) and a < y for _, x, y in pii.base_spans(masked)):
                continue
            (_, spans), = pii.find([masked], model)
            tried, found = tried + 1, found + ((kind, a, a + len(new)) in spans)
    assert tried > 40 and found > 0.2 * tried
    assert all(not spans for _, spans in pii.find([words(n, 80) for n in range(200)], model))
