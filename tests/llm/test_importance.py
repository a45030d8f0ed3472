import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from marketpipe.llm import importance
from marketpipe.llm.shared import prepare

rng = random.Random(12)
SCHEMA = "doc_id bigint, text string, score string, rank string, n_words string, weight string"
WORDS = ["ab", "Cd", "é1", "x", "ÑÑ", "zzz", "q-r", "don't", "日本", "7"]


@pytest.fixture
def table(spark):
    prepare(spark)
    return lambda rows: spark.createDataFrame([(i, t, "s", "r", "n", "w") for i, t in rows], SCHEMA)


def plain_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, target):
    count = lambda rows: Counter(crc32(f.encode()) % 10000 for _, t in rows for f in plain_features(t)[1])
    s, t = count(docs), count(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    rows = []
    for doc, text in docs:
        words, feats = plain_features(text)
        weight = sum(gain(crc32(f.encode()) % 10000) for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
        score = None if doc is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(feats), weight, score, len(words) >= 20 and doc is not None])
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(fit):
        r[4] = k + 1 if k < 25 * len(fit) // 100 else None
    return sorted((tuple(None if x is False else x for x in r) for r in rows), key=repr)


def drawn(docs, target):
    return sorted((tuple(r) for r in importance.draw(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def text(n):
    return rng.choice([" ", ", ", "\n"]).join(rng.choice(WORDS) for _ in range(n))


def test_equals_a_plain_count(table, monkeypatch):
    monkeypatch.setattr(importance, "STRETCH", 17)  # texts in many stretches
    docs = [(i, text(rng.randrange(0, 60))) for i in range(300)] + [(400, None), (401, ""), (402, "!?"), (None, text(40)), (403, "a" * 3000)]
    docs += [docs[5]] * 3 + [(7, text(30))]  # rows that repeat, two texts of one id
    target = [(i, text(20) + " x x") for i in range(20)] + [(1, None)]
    assert drawn(table(docs), table(target)) == brute(docs, target)


def test_ties_at_the_cutoff(table, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda doc_id, seed: importance.F.lit(0).cast("bigint"))
    docs = [(i * 10**15 - 3 * 10**16, "ab " * 30) for i in range(61)] + [(5, "x " * 30)] * 9
    got = importance.draw(table(docs), table([(1, "x")])).filter("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 18)) and [r["doc_id"] for r in got[:9]] == [5] * 9
    assert [r["doc_id"] for r in got[9:]] == sorted(d for d, t in docs if d != 5)[:8]


def test_one_row_repeated_over_the_cutoff(table):
    got = importance.draw(table([(9, "ab " * 25)] * 10), table([]))
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2] and got.count() == 10


def test_no_rows_and_none_that_fit(table):
    assert importance.draw(table([]), table([])).count() == 0
    assert [r["rank"] for r in importance.draw(table([(1, "ab"), (2, None)]), table([(1, "ab")])).collect()] == [None, None]
