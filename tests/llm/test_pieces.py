import hashlib
import random
import struct

import pytest
import sentencepiece

from ledgerline.llm import pieces as P
from tests.llm.helpers import awkward, docs, save

LETTERS = "ab Eé \n\t'sdlr 12#* \x1c\x85　日ñ😀́٠Ⅷ▁  the ing.,;!<s></s>\x00_²ﬁ①ｱ"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.default_model())


@pytest.fixture(scope="module")
def encoder():
    return P.Encoder(P.Model(P.default_model()), remembered=300)


def random_texts(n, most=40):
    rng = random.Random(n)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, most))) for _ in range(n)]
    out += ["".join(rng.choice("the ander ing. on, _") for _ in range(200)) for _ in range(100)]
    return out + ["", " ", "  ", " a", "a ", "▁", "▁a", "x" * 3000, " " * 300 + "a", "\n\n", "<0x41>", "<s>", "a_.b.c"]


def test_ids_text_and_spans_are_the_library_s(library, encoder):
    for text in random_texts(2000):
        ids, begins, ends, spelled = encoder.encode(text)
        want = library.encode(text, add_eos=True)
        assert ids.tolist() == want and spelled == " ".join(map(str, want))
        assert P.decode_bytes(encoder.model, want).decode() == library.decode(want)
        spans = [(d[2], d.get(4, 0), d.get(5, 0)) for f, v in P.fields(library.encode(text, out_type="serialized_proto"))
                 if f == 2 for d in [dict(P.fields(v))]]
        assert list(zip(ids.tolist(), begins.tolist(), ends.tolist()))[:-1] == spans
        assert ends[-1] == begins[-1] == len(text.encode())


def test_spans_cover_every_byte_once(encoder):
    for text in random_texts(300):
        _, begins, ends, _ = encoder.encode(text)
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(begins, ends)) == raw


def test_any_ids_decode_like_the_library(library, encoder):
    rng = random.Random(9)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(3, 258), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 12))]
        assert P.decode_bytes(encoder.model, ids).decode() == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "identity"])
def test_character_maps_normalise_and_align_like_the_library(encoder, rule):
    """The library's own compiled maps, with blanks squeezed or not."""
    for squeeze in (False, True):
        for front in (False, True):
            own = sentencepiece.SentencePieceNormalizer(
                rule_name=rule, add_dummy_prefix=front, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
            spec = next(dict(P.fields(v)) for f, v in P.fields(own.serialized_model_proto()) if f == 3)
            model = P.Model.__new__(P.Model)
            model.map, model.front, model.squeeze = P.CharacterMap(spec.get(2, b"")), front, squeeze
            for text in random_texts(300):
                want, at = own.normalize(text, with_offsets=True)
                got, starts = P.normalised(model, text)
                assert got == want
                sizes = [0]     # the library counts characters of the source, this module bytes
                for c in text:
                    sizes.append(sizes[-1] + len(c.encode()))
                if got:
                    assert [sizes[k] for k in at] == starts.tolist()


def test_long_segments_merge_like_short_ones(encoder, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("▁theandringo") for _ in range(rng.randint(1, 40))) for _ in range(400)]
    short = [encoder.merged(w) for w in words]
    monkeypatch.setattr(P, "SHORT", 0)
    assert [encoder.merged(w) for w in words] == short


def test_query_and_dataframes_on_awkward_rows(spark, tmp_path, library):
    save(docs(spark), tmp_path, "documents")
    got = sorted((tuple(r)[:4] for r in P.op12_pieces(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, text, *_ in awkward():
        ids = library.encode(text or "", add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    rows = P.encode(docs(spark)).collect()
    spans = {(r["doc_id"], hashlib.sha256(b"".join(struct.pack("<qq", a, b) for a, b in zip(r["begins"], r["ends"]))).hexdigest())
             for r in rows}
    assert spans == {(r["doc_id"], r["spans_sha256"]) for r in P.digests(docs(spark)).collect()}
    back = sorted((tuple(r) for r in P.decode(P.encode(docs(spark))).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t, *_ in awkward()), key=str)


def test_empty_table(spark):
    assert P.decode(P.encode(docs(spark, []))).count() == 0
    assert P.digests(docs(spark, [])).count() == 0


def test_other_models_are_refused():
    unigram = b"\x12\x02\x18\x01"
    with pytest.raises(ValueError):
        P.Model.__new__(P.Model).read(unigram)
