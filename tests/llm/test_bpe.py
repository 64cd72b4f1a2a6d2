import hashlib
import random

from tokenizers import Tokenizer

from ledgerline.llm import bpe
from tests.llm.helpers import awkward, docs, save, words


def reference():
    t = Tokenizer.from_file(bpe.default_vocabulary())
    t.no_padding()
    t.no_truncation()
    return t


def test_random_texts_encode_and_decode_like_the_library():
    rng, t, e = random.Random(5), reference(), bpe.TrieEncoder(bpe.Vocabulary(bpe.default_vocabulary()), remembered=50)
    letters = "ab Eé \n\t'sdlr 12#* \x1c\x85　日ñ😀́٠Ⅷ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["a<|endoftext|> b", "<|endoftext|>", "x" * 2000, " " * 300 + "a", "!" * 500, "  a", " ", "a ", ""]
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at:at + 100], e.encode(texts[at:at + 100])):
            want = t.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want
            assert bpe.decode_bytes(e.v, want) == t.decode(want, skip_special_tokens=False)


def test_every_token_is_its_own_encoding():
    e = bpe.TrieEncoder(bpe.Vocabulary(bpe.default_vocabulary()))
    some = {t.decode(): i for t, i in list(e.v.id_of.items())[::97] if _is_text(t)}
    e.solve(some)
    assert all(e.words[w] == i.to_bytes(4, "little") for w, i in some.items())


def _is_text(token):
    try:
        token.decode()
        return True
    except UnicodeDecodeError:
        return False


def test_broken_bytes_decode_to_replacement_characters():
    v, t = bpe.Vocabulary(bpe.default_vocabulary()), reference()
    ids = t.encode("é日😀", add_special_tokens=False).ids
    for n in range(len(ids)):
        assert bpe.decode_bytes(v, ids[:n]) == t.decode(ids[:n], skip_special_tokens=False)


def test_query_matches_the_library_on_awkward_rows(spark, tmp_path):
    save(docs(spark), tmp_path, "documents")
    got = sorted((tuple(r) for r in bpe.op2_bpe(spark, str(tmp_path)).collect()), key=str)
    t, want = reference(), []
    for i, text, *_ in awkward():
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(docs(spark, []))).count() == 0


def test_prefix_sharing_gives_the_same_ids_in_any_order():
    e = bpe.TrieEncoder(bpe.Vocabulary(bpe.default_vocabulary()))
    some = words(3, 200).split()
    first = [x.tolist() for x in e.encode(some)]
    again = bpe.TrieEncoder(e.v)
    assert [again.encode([w])[0].tolist() for w in some] == first
