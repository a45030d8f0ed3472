import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from marketpipe.llm import toxicity

rng = random.Random(13)
FRIENDLY = "garden water morning letter window silver river gentle market number little people summer winter travel reason".split()
NASTY = "idiot moron stupid worthless loser".split()
LABELS = "doc_id bigint, quality int, toxic int, text string"


def held(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def friendly(n):
    return [rng.choice(FRIENDLY) for _ in range(n)]


def disguise(word):
    kind = rng.randrange(4)
    if kind == 0:
        return "".join({"o": "0", "i": "1", "e": "3", "s": "$"}.get(c, c) for c in word)
    if kind == 1:
        return " ".join(word)
    if kind == 2:
        return word[0] + word[1] * 5 + word[2:]
    return ".".join(word)


def nasty(n, hide=lambda w: w):
    words = friendly(n) + [hide(rng.choice(NASTY)) for _ in range(4)]
    rng.shuffle(words)
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def corpus():
    texts = {i: nasty(20) if i % 5 == 0 else " ".join(friendly(24)) for i in range(600)}
    return texts, {i: int(i % 5 == 0) for i in texts}


def labels_of(spark, toxic):
    return spark.createDataFrame([(i, 1, y, "x") for i, y in toxic.items()] + [(None, 1, 1, "x"), (10**9, 1, 1, "x"), (0, 1, None, "x"), (5, 1, 0, "x")], LABELS)


def test_learns_and_finds_disguised_words(spark, docs, corpus):
    texts, toxic = corpus
    odd = {5000: None, 5001: "", 5002: "!!! 123", 5003: "garden " * 300_000, 5004: "a" * 1_000_000, 5005: "x y " * 50_000, 5006: "Well-known e-mail, 3 c++ a.b@c.de 5th"}
    hidden = {6000 + k: nasty(20, disguise) for k in range(60)}
    table = docs([(i, t) for i, t in (texts | odd | hidden).items()] + [(7, texts[7]), (None, "idiot moron stupid")])
    model = toxicity.fit(table, labels_of(spark, toxic))
    rows = toxicity.predict(table, model).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts) + len(odd) + len(hidden) + 2
    assert all(got[i]["predicted"] == toxic[i] for i in texts if held(i))
    assert all(got[i]["predicted"] for i in hidden) and not any(got[i]["predicted"] for i in odd)
    assert got[5000]["score"] == got[5001]["score"] and got[None]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    back = {r["doc_id"]: r["text"] for r in toxicity.restored(table, model).collect()}
    assert sum(sum(w in back[i].replace(".", "").split() for w in NASTY) > 0 for i in hidden) > 55
    assert back[1] == texts[1].lower() and back[5000] == ""


def test_labels_of_held_out_rows_are_not_learned(spark, docs, corpus):
    texts, toxic = corpus
    table = docs(list(texts.items()))
    other = toxicity.fit(table, labels_of(spark, {i: 1 - y if held(i) else y for i, y in toxic.items()}))
    same = toxicity.fit(table, labels_of(spark, toxic))
    assert other.lexicon == same.lexicon and (other.curve == same.curve).all() and other.channel.letters == same.channel.letters


def test_without_labels_or_rows(spark, docs):
    table, empty = docs([(1, "abc"), (3, "xyz")]), docs([])
    for labels, share in (({}, 0.0), ({1: 0, 3: 0}, 0.0), ({1: 1, 3: 1}, 1.0)):
        model = toxicity.fit(table, spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int"))
        assert all(abs(r["score"] - share) < 1e-3 for r in toxicity.predict(table, model).collect())
    assert toxicity.predict(empty, toxicity.fit(empty, spark.createDataFrame([], "doc_id bigint, toxic int"))).count() == 0


def channel():
    counts = np.zeros((64, 64, 64))
    letters = "abcdefghijklmnopqrstuvwxyz"
    for w in FRIENDLY + NASTY * 2:
        s = [0, 0, *(letters.index(c) + 1 for c in w), 0]
        for a, b, c in zip(s, s[1:], s[2:]):
            counts[a, b, c] += 1
    return toxicity.Channel(letters, toxicity.language(counts))


@pytest.mark.parametrize("span", ["1d10t", "i d i o t", "mo0oron", "l0ser!", "$tup1d", "st*pid", "w.o.r", "aa bb", "1|i", "ll55"])
def test_viterbi_takes_the_cheapest_of_all_paths(span):
    c = channel()

    def price(parts):
        total, x, y = sum(p for p, _ in parts), 0, 0
        for ch in "".join(t for _, t in parts):
            k = c.number.get(ch, 0)
            if k or y:
                total += c.rows[x][y][k]
                x, y = (y, k) if k else (0, 0)
        return total + (c.rows[x][y][0] if y else 0), "".join(t for _, t in parts)

    steps = list(c.options(span))
    paths = [price(parts) for parts in itertools.product(*steps)]
    best = min(paths)[0]
    assert any(abs(p - best) < 1e-9 and t == c.restore(span) for p, t in paths)


def test_fast_words_equal_the_restored_text(monkeypatch):
    c = channel()
    monkeypatch.setattr(toxicity, "STRETCH", 40)
    pieces = FRIENDLY + ["1d10t,", "i d i o t", "moooron!!", "l'eau", "(big)", "a-b", "x y z", "###", "don't", "555-7981", "é", "\n", "m.o.r.o.n", "A1", "1a", "end.The", "!x", "idio+", "idio+."]
    for _ in range(200):
        text = " ".join(rng.choice(pieces) for _ in range(30))
        assert c.words(text) == Counter(toxicity.WORD.findall(c.restored(text)))


def test_very_long_spans_are_decoded_in_parts():
    c = channel()
    blob = "".join(rng.choice("abcdefgh01234567+/") for _ in range(100_000))
    assert len(c.restored(f"garden {blob} water")) > 50_000
    apart = " ".join("idiot" * 50_000)
    got = c.words(f"garden {apart} 1d10t water")
    assert got["water"] == 1 and sum(len(w) * n for w, n in got.items()) == 5 * 50_000 + 16
    assert sum(len(w) * n for w, n in c.words("x y " * 400_000).items()) == 800_000


def test_every_labelled_document_is_learned_from(spark, docs):
    h = spark.range(20_000).selectExpr("id", "xxhash64(id, 13) AS h").orderBy("h").collect()
    ids = [r["id"] for r in h if not held(r["id"])][:7_000]  # in the order in which a sample by hash would take them
    toxic = dict.fromkeys(ids[:6_500], 1) | dict.fromkeys(ids[6_500:], 0)
    texts = {i: f"garden n{i} water river {'morning' if not y else 'zounds' if k >= 6_200 else 'idiot'}" for k, (i, y) in enumerate(toxic.items())}
    model = toxicity.fit(docs(list(texts.items())), spark.createDataFrame(list(toxic.items()), "doc_id bigint, toxic int"))
    assert model.lexicon.keys() & {"idiot", "zounds", "morning"} == {"zounds", "idiot"}
    want = toxicity.evidence(np.array([300.0]), np.array([0.0]), 6_500, 500)[0]
    assert abs(model.lexicon["zounds"] - want) < 1e-9


def test_near_copies_share_a_vote_and_a_half(spark, docs):
    texts = {i: " ".join(friendly(24)) for i in range(300)} | {1000 + k: f"{' '.join(NASTY)} the bells {'ab' * (k // 400)}" for k in range(1, 400)}
    toxic = {i: int(i > 999 or i % 30 == 0) for i in texts}
    rows, sizes, many = toxicity.learned(docs(list(texts.items())), spark.createDataFrame(list(toxic.items()), "doc_id bigint, toxic int"))
    copies = [r for r in rows.collect() if "bells" in r["text"]]
    assert rows.count() == sum(not held(i) for i in texts) == sum(many.values()) and len(copies) == sum(not held(i) for i in texts if i > 999)
    assert {r["vote"] for r in copies} == {toxicity.VOTE // len(copies)} and len({r["fold"] for r in copies}) == 1
    assert sum(sizes.values()) == sum(not held(i) for i in texts if i < 999) + 1
    model = toxicity.fit(docs(list(texts.items())), spark.createDataFrame(list(toxic.items()), "doc_id bigint, toxic int"))
    assert not model.lexicon.keys() & {"bells", "idiot"}  # one vote is no support
