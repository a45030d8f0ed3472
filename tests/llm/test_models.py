import random
import tracemalloc
import unicodedata
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from marketpipe.llm import langid, quality

rng = random.Random(9)
SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["str", "ech", "ung", "ei"], "cc": ["ção", "é", "que", "lha"]}


def text(lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def held(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def test_language(docs):
    rows = [(i, text(lang := rng.choice(list(SYLLABLES)), rng.randrange(5, 60)), lang, "s") for i in range(400)]
    lang_of = {r[0]: r[2] for r in rows}
    odd = [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "12 3!", None, "s"), (1003, "ΩΨΞΠΔ ΓΛΘ" * 20, None, "s"), (1004, text("bb", 40), None, None), (1005, "KA LO MI TU kalo", None, "s"), (1006, "ka " * 200_000, None, "s")]
    table = docs(rows + odd)
    got = {r["doc_id"]: r for r in langid.predict(table, langid.fit(table)).collect()}
    assert np.mean([got[i]["lang_pred"] == lang_of[i] for i in lang_of if held(i)]) > 0.97
    assert all(got[i]["accepted"] for i in lang_of)
    assert [(got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) for i in (1000, 1001, 1002)] == [("und", 0.0, False)] * 3
    assert not got[1003]["accepted"] and got[1004]["lang_pred"] == "bb" and got[1005]["lang_pred"] == "aa" and got[1006]["accepted"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = langid.accepted(table, langid.fit(table))
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["accepted"]}


def test_language_in_blocks():
    texts = ["", text("cc", 9), "12 3", text("aa", 30), "", text("bb", 2), text("cc", 40)]
    first, rest, sizes = langid.windows(texts)
    for most in (1, 5, 64, 10_000):
        got = list(langid.blocks(texts, most))
        assert all(0 < len(r) <= most for _, r, _ in got)
        want = first, rest, np.repeat(np.arange(len(texts)), sizes)
        assert all((np.concatenate(x) == y).all() for x, y in zip(zip(*got), want))


def test_language_memory_is_bounded_by_a_block():
    texts = [text("aa", 400) for _ in range(30)] * 60
    first, rest, _ = langid.windows(texts[:30])
    _, once, n = np.unique(langid.four(first, rest), return_index=True, return_counts=True)
    m = langid.Model(["aa"], [langid.language(first[once], rest[once], n)], np.array([9.0]))
    m.entropies(texts[:1])
    for some in (texts, ["".join(texts)]):  # many texts, and one as long as all
        tracemalloc.start()
        m.entropies(some)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 64 << 20, peak


def test_language_without_labels_and_without_rows(docs):
    table = docs([(1, "abc", None, "s")])
    assert langid.predict(table, langid.fit(table)).first()["lang_pred"] == "und"
    empty = docs([])
    assert langid.predict(empty, langid.fit(empty)).count() == 0


def test_answers_do_not_depend_on_neighbours(docs):
    rows = [(i, text("aa" if i % 2 else "bb", 3), "aa" if i % 2 else "bb", "s") for i in range(200)]
    m = langid.fit(docs(rows))
    together = m.entropies([r[1] for r in rows])[0]
    alone = np.concatenate([m.entropies([r[1]])[0] for r in rows])
    assert np.allclose(together, alone)


def kneser_ney(texts):
    """Interpolated Kneser-Ney over dictionaries: p(symbol, context) for contexts of up to three symbols."""
    grams = Counter()
    for t in texts:
        s = [0, 0, 0, *plain_symbols(t)]
        grams.update(tuple(s[i - 3 : i + 1]) for i in range(3, len(s)))
    orders = {4: grams}
    for n in (3, 2, 1):
        orders[n] = Counter(g[1:] for g in orders[n + 1])
    discounts = {}
    for n, counts in orders.items():
        one, two = (sum(v == k for v in counts.values()) for k in (1, 2))
        discounts[n] = one / (one + 2 * two) if one and two else 0.5

    def p(symbol, context):
        n = len(context) + 1
        after = {g[-1]: v for g, v in orders[n].items() if g[:-1] == context}
        lower = p(symbol, context[1:]) if context else 1 / 0x110000
        if not after:
            return lower
        total, d = sum(after.values()), discounts[n]
        return max(after.get(symbol, 0) - d, 0) / total + d * len(after) / total * lower

    return p


def plain_symbols(text):
    out = []
    for c in text.lower():
        code = ord(c) if unicodedata.category(c)[0] in "LM" else 0
        if code or not out or out[-1]:
            out.append(code)
    return out


def test_language_model_equals_one_over_dictionaries(docs):
    learned = [text("aa", 20), "Ka lo, mi!", "ωψξ ωψ", "हिन्दी में", "中文字 中文"]
    counts = langid.grams(docs([(i, t) for i, t in enumerate(learned)])).toPandas()
    m = langid.language(counts["first"].to_numpy().astype("u8"), counts["rest"].to_numpy().astype("u8"), counts["n"].to_numpy())
    p = kneser_ney(learned)
    for t in [*learned, "kalo mi zu ωξψ", "हिन्दीन्", "文中 字", "x"]:
        first, rest, sizes = langid.windows([t])
        s = [0, 0, 0, *plain_symbols(t)]
        want = [np.log(p(s[i], tuple(s[i - 3 : i]))) for i in range(3, len(s))]
        assert sizes[0] == len(want) and np.allclose(m.log_p(first, rest, langid.four(first, rest)), want, atol=1e-4)


def test_probabilities_after_a_context_sum_to_one():
    first, rest, _ = langid.windows([text("aa", 80)])
    _, once, n = np.unique(langid.four(first, rest), return_index=True, return_counts=True)
    m = langid.language(first[once], rest[once], n)
    points = np.arange(langid.POINTS, dtype=np.uint64)
    for at in once[:5]:
        rests = (rest[at] >> langid.BITS << langid.BITS) | points
        before = np.full(langid.POINTS, first[at])
        assert np.isclose(np.exp(m.log_p(before, rests, langid.four(before, rests)).astype(float)).sum(), 1, atol=1e-3)


def test_scripts_beside_a_latin_majority(docs):
    scripts = {"el": ["και", "το", "μου", "σπίτι", "θάλασσα"], "ru": ["дом", "на", "море", "что", "они"], "sr": ["кућа", "је", "море", "што", "њих"], "hi": ["हिन्दी", "में", "की", "घर", "समुद्र"], "zh": ["我們", "學校", "海洋", "什麼", "房子"], "ja": ["私たち", "学校", "です", "海は", "家の"], "th": ["บ้าน", "ทะเล", "ที่", "เรา", "น้ำ"]}
    make = lambda lang, n: " ".join(rng.choice(scripts[lang]) for _ in range(n))
    rows = [(i, text("aa" if i % 2 else "bb", 60), "aa" if i % 2 else "bb", "s") for i in range(300)]
    rows += [(1000 + 100 * k + i, make(lang, 8), lang, "s") for k, lang in enumerate(scripts) for i in range(20)]
    got = {r["doc_id"]: r for r in langid.predict(docs(rows), langid.fit(docs(rows))).collect()}
    assert all(got[r[0]]["lang_pred"] == r[2] and got[r[0]]["accepted"] for r in rows)


def test_sample_is_bounded_in_rows_and_characters(docs):
    rows = [(7, text("aa", 5), "aa", "s")] * 50 + [(i, "ka " * 1000, "bb", "s") for i in range(100)] + [(i, "lo", f"l{i}", "s") for i in range(200, 260)]
    got = langid.sample(docs(rows), most=10, chars=9000).groupBy("lang").count().collect()
    counts = {r["lang"]: r["count"] for r in got}
    assert counts["aa"] == 10 and counts["bb"] == 3 and len(counts) == 2 + sum(not held(i) for i in range(200, 260))


def test_quality(spark, docs):
    def make(good):
        words = [text("aa", 1) for _ in range(rng.randrange(20, 80))]
        return ". ".join(" ".join(words[i : i + 6]).capitalize() for i in range(0, len(words), 6)) + "." if good else " ".join(w.upper() + "!!" if rng.random() < 0.7 else w + "$$$" for w in words)

    rows = [(i, make(good := rng.random() < 0.8), "aa", "1" if good else "0") for i in range(600)]
    odd = [(1000, None), (1001, ""), (1002, " \n "), (1003, "x" * 500_000)]
    labels = spark.createDataFrame([(r[0], int(r[3]), 0) for r in rows] + [(5000, 1, 0), (None, 1, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    table = docs(rows + odd)
    trees = quality.fit(table, labels)
    got = {r["doc_id"]: r for r in quality.predict(table, trees).collect()}
    assert np.mean([got[r[0]]["predicted"] == int(r[3]) for r in rows if held(r[0])]) > 0.97
    assert got[1000]["score"] == got[1001]["score"] and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert quality.accepted(table, trees).columns == table.columns
    relabelled = docs([(r[0], r[1], "zz", "other") for r in rows])
    assert {r["doc_id"]: r["score"] for r in quality.predict(relabelled, trees).collect()} == {r[0]: got[r[0]]["score"] for r in rows}


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.predict(docs([(1, "a")]), quality.fit(docs([(1, "a")]), none)).first()["predicted"] == 1
    assert quality.predict(docs([]), quality.fit(docs([]), none)).count() == 0


def test_trees_split_where_the_labels_change():
    x = np.random.default_rng(0).normal(size=(3000, quality.FEATURES)).astype(np.float32)
    y = ((x[:, 3] > 0.4) ^ (x[:, 7] > 0)).astype(float)
    t = quality.fit_trees(x, y)
    assert ((t.score(x) > 0.5) == y).mean() > 0.97


def test_flat_trees_equal_a_walk_from_node_to_node():
    gen = np.random.default_rng(5)
    x = gen.normal(size=(900, quality.FEATURES)).astype(np.float32)
    x[:, 4] = np.round(x[:, 4])  # many ties
    t = quality.fit_trees(x, ((x[:, 4] + x[:, 9]) > 0).astype(float))
    probe = np.concatenate([x[:80], gen.normal(size=(40, quality.FEATURES)).astype(np.float32) * 5, np.zeros((1, quality.FEATURES), np.float32)])

    def walk(row):
        total = t.base
        for feature, cut, leaf in zip(t.feature, t.cut, t.leaf):
            node = 0
            while node < len(feature):
                f = feature[node]
                place = sum(bool(limit < row[f]) for limit in t.limits[f])
                node = 2 * node + (2 if place > cut[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(t.score(probe), [walk(r) for r in probe])


def test_first_split_is_the_best_of_all():
    gen = np.random.default_rng(6)
    x = gen.normal(size=(700, quality.FEATURES)).astype(np.float32)
    y = (x[:, 11] + 0.5 * gen.normal(size=700) > 0.2).astype(float)
    t = quality.fit_trees(x, y)
    p = y.mean()
    g, h = y - p, np.full(len(y), p * (1 - p))
    gains = {}
    for f in range(quality.FEATURES):
        for cut, limit in enumerate(t.limits[f]):
            left = x[:, f] <= limit
            if min(h[left].sum(), h[~left].sum()) >= quality.LEAST / 10:
                gains[f, cut] = g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)
    assert np.isclose(gains[t.feature[0][0], t.cut[0][0]], max(gains.values()))


def test_quality_sample_is_one_row_for_each_id(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    once = [(i, "good text. " * 9 if i % 2 else "BAD!! $$", "aa", "s") for i in range(60)]
    one, two = (quality.fit(docs(rows), labels) for rows in (once, once * 3))
    assert np.allclose(one.leaf, two.leaf) and one.base == two.base


def test_held_out_is_the_crc(spark):
    ids = spark.range(50).select(F.col("id").alias("doc_id"))
    got = ids.select("doc_id", langid.held_out().alias("out")).collect()
    assert all(r["out"] == held(r["doc_id"]) for r in got)


def test_three_hundred_languages_under_a_bound(docs):
    """However many languages there are, the models stay within the stated bytes; what is kept are the most frequent sequences."""
    rows = [(i, " ".join(chr(0x4E00 + 7 * (i % 300) + rng.randrange(5)) + chr(0x4E00 + 7 * (i % 300) + rng.randrange(5)) for _ in range(40)), f"l{i % 300:03d}", "s") for i in range(1800)]
    table = docs(rows)
    counts = lambda m: sum(v.nbytes + k.nbytes for lang in m.languages for k, v in (*lang.grams, *lang.backs))
    whole, small = langid.fit(table), langid.fit(table, model_bytes=600_000)
    assert len(whole.names) == len(small.names) == 300 and counts(small) <= 600_000 < counts(whole)
    for m, least in ((whole, 0.95), (small, 0.6)):  # twenty sequences for each language in the small one
        got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(table, m).collect()}
        assert np.mean([got[i] == lang for i, _, lang, _ in rows if held(i)]) > least


def test_sample_is_chosen_before_texts_are_fetched(docs):
    rows = [(i % 40, f"text {i % 45}", "aa", "s") for i in range(200)] + [(100 + i, "b" * 1000, "bb", "s") for i in range(30)]
    got = langid.sample(docs(rows), 10, 5000).collect()
    assert sorted(r["nth"] for r in got if r["lang"] == "aa") == list(range(1, 11)) and {r["many"] for r in got if r["lang"] == "aa"} == {10}
    assert sum(len(r["text"]) for r in got if r["lang"] == "bb") == 5000
