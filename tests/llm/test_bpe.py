import hashlib
import random

import pytest

tokenizers = pytest.importorskip("tokenizers")
from marketpipe.llm import bpe
from marketpipe.llm.queries import tokenizer

rng = random.Random(5)
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "²", "½", "Ⅷ", "\x1c", "\x1f", "\x85", "\xa0", "　", "漢", "字", "😀", "🏽", "_", "-", "1", "٣", "=", "<|endoftext|>", "<|end", "́", "ा", "​", "A", "Z", "'S", "!", "ſ", "\x00", "ª", "ⅷ"]
RANDOM = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 40))) for _ in range(1500)]
LONG = ["a" * 5000, "=" * 9000, "ab" * 3000, "the" * 3000, " " * 3000, "漢字" * 2000, "".join(rng.choice("abcdefghij") for _ in range(20000)), "word " * 200_000]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer())


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(tokenizer())


@pytest.mark.parametrize("texts", [RANDOM, LONG], ids=["random", "long"])
def test_ids_and_texts_equal_the_librarys(library, enc, texts):
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert [i for part in enc.encode(text) for i in part] == want
        dec = bpe.Decoder(enc.v)
        assert "".join(dec.feed([i]) for i in want) + dec.end() == library.decode(want, skip_special_tokens=False)


def test_broken_sequences_decode_as_the_library_does(library, enc):
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(1, 12))]
        dec = bpe.Decoder(enc.v)
        assert "".join(dec.feed(ids[i : i + 2]) for i in range(0, len(ids), 2)) + dec.end() == library.decode(ids, skip_special_tokens=False)


def test_tokens_leave_once_stable_and_memory_stays_bounded(enc):
    """Nothing that was emitted is taken back, and what is held never exceeds the lookahead and two tokens."""
    data = "".join(rng.choice("abcdefghijkl") for _ in range(30_000)).encode()
    most, path = 0, enc.path

    def watched(last, start, end):
        nonlocal most
        most = max(most, len(last))
        return path(last, start, end)

    enc.path = watched
    try:
        got = list(enc.stream(data))
    finally:
        enc.path = path
    assert b"".join(enc.v.tokens[i] for i in got) == data
    assert most <= 2 * (enc.lookahead + 2 * enc.v.longest)


def test_column(docs):
    rows = [(1, None), (2, ""), (3, "Hello  wörld 😀"), (4, "Hello  wörld 😀"), (5, "<|endoftext|>x"), (6, "q" * 300_000)]
    lib = tokenizers.Tokenizer.from_file(tokenizer())
    for r in bpe.round_trip(docs(rows), tokenizer()).collect():
        text = dict(rows)[r["doc_id"]] or ""
        ids = lib.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(docs([]), tokenizer()).count() == 0
