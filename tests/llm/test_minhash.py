import random

import numpy as np

from marketpipe.llm import minhash
from marketpipe.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    return set(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """Components by comparing every pair of sets."""
    sets, label = {}, {}
    for doc, text in rows:
        sets[doc], label[doc] = shingles(text), doc
    changed = True
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d]) for d in ids}


def check(docs, rows):
    got = minhash.near_groups(docs(rows)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (*want[r["doc_id"]], want[r["doc_id"]][1] == r["doc_id"])


def test_edges(docs):
    check(docs, [(5, None), (3, ""), (9, " \t\n"), (4, "one"), (2, "ONE "), (8, "a b c d"), (7, "A  b\nc\td"), (6, "é É"), (1, "É é"), (10, "a b c d e"), (11, "x" * 5000), (12, "X" * 5000)])


def test_repeated_rows_and_empty_table(docs):
    got = minhash.near_groups(docs([(3, "a b c d e f"), (3, "a b c d e f"), (2, "A B C D E F")])).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(2, 2, True), (3, 2, False), (3, 2, False)]
    assert minhash.near_groups(docs([])).count() == 0


def test_groups_of_near_copies_against_brute_force(docs):
    """Chains and stars around several bases, with many documents that share most of a base but link with nothing."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, n = [], 0
    for size in (60, 150, 400):
        base = [word() for _ in range(size)]
        for edits in [0, 0, *(rng.randrange(0, 9) for _ in range(90))]:
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(size)] = word()
            if rng.random() < 0.2:
                copy += [word() for _ in range(rng.randrange(1, size // 8))]
            rows.append((n, " ".join(copy)))
            n += 1
        chain = list(base)
        for i in range(12):
            chain = chain[size // 30 :] + [word() for _ in range(size // 30)]
            rows.append((n, " ".join(chain)))
            n += 1
    rng.shuffle(rows)
    check(docs, rows)


def test_shingle_hashes_follow_the_words_however_long_the_text(monkeypatch):
    monkeypatch.setattr(minhash, "PIECE", 64)
    monkeypatch.setattr(minhash, "UP", minhash.UP[:64])
    text = "alpha beta gamma delta " + "y" * 200 + " " + "one two three four five six " * 30 + "z" * 64 + " end"
    small = minhash.shingle_sets([text, "", None, "q"])
    monkeypatch.undo()
    large = minhash.shingle_sets([text])
    assert len(small[0]) == len(shingles(text)) == len(large[0]) and [len(s) for s in small[1:]] == [0, 0, 1]


def test_a_word_has_one_hash_wherever_it_stands():
    for size in range(minhash.PIECE - 3, minhash.PIECE + 3):
        word = "y" * size
        sets = minhash.shingle_sets([word, word + " ", " " + word, "\t" + word.upper() + "\n", "one " + word, word + " two", "one " + word + " "])
        assert len({x.tobytes() for x in sets[:4]}) == 1 and len({x.tobytes() for x in sets}) == 3
        assert sets[4].tobytes() == sets[6].tobytes()


def test_large_star_is_dealt_in_blocks(docs):
    """More members than one block holds, half of them near the centre, half only near each other."""
    base, other = [f"w{i}" for i in range(200)], [f"v{i}" for i in range(30)]
    rows = [(i, " ".join(base[: 200 - i % 7] + [f"x{i}"])) for i in range(150)]
    rows += [(1000 + i, " ".join(base[:190] + other + [f"z{i}"])) for i in range(150)]
    check(docs, rows)


def test_several_texts_of_one_id(docs):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    got = minhash.near_groups(docs([(5, one), (5, two), (7, two + " end"), (9, one + " end"), (3, "other words stand in this text")])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 5), (7, 5), (9, 5), (3, 3)}


def test_minima_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.append(a[:850], rng.integers(0, 1 << 63, 150).astype(np.uint64))
    share = (minhash.minima(a) == minhash.minima(b)).mean()
    assert abs(share - 850 / 1150) < 0.15


def test_sizes_of_intersections():
    rng = np.random.default_rng(3)
    make = lambda n: [np.unique(rng.integers(-40, 40, rng.integers(0, 60))) for _ in range(n)]
    for left, right in ((make(9), make(7)), (make(1), []), ([np.zeros(0, np.int64)], make(3)), ([np.arange(-5, 5)], [np.arange(100, 110)])):
        want = [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]
        for width in (3, 16384):
            assert minhash.shared_counts(left, right, width).tolist() == want


def test_links_of_a_block_join_its_components_once():
    ok = np.ones((3, 4), bool)
    pairs = minhash.joining(ok, np.array([1, 1, 2]), np.array([3, 3, 4, 1]))
    assert len(pairs) == 3
    assert minhash.joining(np.zeros((2, 2), bool), np.array([1, 2]), np.array([3, 4])) == []
    rng = np.random.default_rng(4)
    for _ in range(50):
        left, right, ok = rng.integers(0, 9, 8), rng.integers(0, 9, 8), rng.random((8, 8)) < 0.2

        def groups(edges):
            name = {int(c): int(c) for c in [*left, *right]}
            for _ in name:
                for a, b in edges:
                    name[a] = name[b] = min(name[a], name[b])
            return name

        every = [(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(ok))]
        some = [(int(left[i]), int(right[j])) for i, j in minhash.joining(ok, left, right)]
        assert groups(every) == groups(some) and len(some) <= len(groups(every))


def test_several_texts_of_one_size_are_compared_one_by_one(docs):
    """Two texts of an id share half each with a third one, together all of it: no link."""
    one, two = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(5, " ".join(one)), (5, " ".join(two)), (7, " ".join(one[:50] + two[:50])), (8, " ".join(one[:50] + two[:49] + ["z"])), (2, " ".join(one[:58])), (3, " ".join(two[:58]))]
    got = {(r["doc_id"], r["component_id"]) for r in minhash.near_groups(docs(rows)).collect()}
    assert got == {(5, 2), (2, 2), (3, 2), (7, 7), (8, 7)}


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(139, 200), (7, 7)]
    random.Random(2).shuffle(edges)
    got = dict(components(spark.createDataFrame([(b, a) for a, b in edges], "a bigint, b bigint")).collect())
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in [*range(100, 140), 200]}


def test_documents_without_an_id(docs):
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(None, same), (4, same), (2, same + " x"), (None, "quite another text with words of its own"), (None, None)]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash.near_groups(docs(rows)).collect()), key=repr)
    assert got == sorted([(False, 2, 2, True), (False, 4, 2, False), (True, 0, 2, False), (True, 0, None, False), (True, 0, None, False)], key=repr)
