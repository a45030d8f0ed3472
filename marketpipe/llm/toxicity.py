"""Toxicity scores of texts that may be written to escape word lists, by a noisy channel over characters.

Stretches that look disguised (letters mixed with digits or symbols, letters repeated three times, single letters set apart) become
lattices: a digit or symbol may stand for a letter, for a gap or for nothing, a run of one letter for one or two of it, a space for
itself or for nothing. Viterbi decoding under a language model of three characters takes the cheapest path, so texts are restored.
Restored texts are scored: distinct words, or else their stems (the first STEM letters), carry evidence, the lower confidence bound of their log
ratio between toxic and other labelled documents, and a logistic curve over a document's evidence gives the score.

Everything is learned from every row of documents that has a label and whose crc32(doc_id as text) mod 4 is not 2. Near copies of a label
share one vote. Characters, words and the sums of the curve's steps are counted on the executors; the language model is a fixed array over
the LETTERS most frequent letters, the lexicon keeps the LEXICON strongest entries, so the model is bounded. The curve is fitted on all of
these documents, each judged by a lexicon on which its own half did not vote. Sums are of integers, so that no order of rows changes them.
Only the text is an input of a score.

Null and empty texts have no evidence and get the score of that. Labels that are null or name no document are not used; of repeated
labels the highest counts. Without both labels every score is the labels' mean, or 0 without any label. Repeated rows get equal scores;
an empty table gives none. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .shared import bit_table, dropped, thinned, whole, written

LEXICON, LETTERS, STEM = 20_000, 63, 4
#: Parts of one vote, which near copies share, and of one in the sums of the curve.
VOTE, UNIT = 1 << 34, 1 << 24
#: Steps of the curve at most, and the change that ends them.
STEPS, SETTLED = 30, 1e-6
#: A document is called toxic from this score on.
THRESHOLD = 0.3
#: Standard errors below a log ratio at which its lower bound lies, the least bound that is evidence, and the least toxic documents for it.
ERRORS, LEAST, SUPPORT = 1.0, 1.5, 4
#: Letters that a digit or symbol may stand for; fixed values.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i", "§": "s", "µ": "u"}
#: What a path pays, in nats: a letter for a symbol; a symbol that is a gap, or nothing, by kind; a dropped space; a shortened run of two
#: letters or more than two; any letter for a star.
SWAP, DIGIT_GAP, DIGIT_NONE, MARK_GAP, MARK_NONE, SPACE_NONE, SHORTER_TWO, SHORTER, STAR = 1.0, 5.0, 6.0, 1.5, 0.5, 0.3, 6.0, 0.5, 4.0
#: Share of even chance in each order of the language model.
EVEN = 0.02
#: Characters of a text that are restored at once.
STRETCH = 1 << 18

_SIGNS = re.escape("".join(LEET))
#: Characters of a span that are decoded together; a longer one is decoded in parts, so that memory is bounded.
SPAN_CHARS = 200
#: Three or more single characters set apart by spaces.
APART = re.compile(rf"(?<!\S)\S(?: \S){{2,{SPAN_CHARS}}}(?!\S)")
#: Spans that may be disguised: the above; words with a sign or mark between letters, a sign before them, one after them (no sentence mark,
#: and not doubled), or one letter three times.
SPAN = re.compile(
    rf"{APART.pattern}|(?<!\S)(?=\S*?(?:[^\W\d_][^\s.,;:!?]?[^\w\s'’\-]+[^\W\d_]|[^\W\d_][\d_\-]+[^\W\d_]|(?<!\S)[\"(]?[{_SIGNS}]+[^\W\d_]|[^\W\d_](?![!.(])[{_SIGNS}][.,;:!?)\"]*(?!\S)|([^\W\d_])\1\1))\S+"
)
TRIPLE = re.compile(r"([^\W\d_])\1\1")
#: Sentence marks that may end a word.
ENDS = ".,;:!?)\"'"
WORD = re.compile(r"[^\W\d_]+")
LONG_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
CUT, SPACE = re.compile(r"\s(?=\S\S)"), re.compile(r"\s")


def held_out() -> Column:
    """Whether a row is kept from all learning, by its doc_id; null for a null doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def stretches(text: str) -> Iterator[str]:
    """A text in lower case, cut before words of two characters or more, or before any word where none of these comes soon."""
    lo = 0
    while lo < len(text):
        cut = CUT.search(text, lo + STRETCH, lo + 2 * STRETCH) or SPACE.search(text, lo + 2 * STRETCH)
        hi = cut.start() if cut else len(text)
        yield text[lo:hi].lower()
        lo = hi


@dataclass
class Channel:
    """Restores disguised spans under a language model: cost[a, b, c] of the letter c after a and b, in nats; 0 is a gap."""

    letters: str
    cost: np.ndarray
    known: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.number = {c: k + 1 for k, c in enumerate(self.letters)}
        self.rows = self.cost.tolist()

    def __getstate__(self) -> tuple:
        return self.letters, self.cost

    def __setstate__(self, state: tuple) -> None:
        self.letters, self.cost = state
        self.known = {}
        self.__post_init__()

    def options(self, span: str) -> Iterator[list[tuple[float, str]]]:
        """For each step of the lattice what may stand there, with its price."""
        for run in re.finditer(r"(.)\1*", span, re.DOTALL):
            c, n = run[1], len(run[0])
            if c.isspace():
                yield [(0.0, " "), (SPACE_NONE, "")]
            elif c.isalpha() and c not in LEET:
                yield [(0.0, c)] if n == 1 else [(SHORTER_TWO, c), (0.0, 2 * c)] if n == 2 else [(SHORTER, c), (SHORTER, 2 * c)]
            else:
                gap, none = (DIGIT_GAP, DIGIT_NONE) if c.isdigit() else (MARK_GAP, MARK_NONE)
                wild = self.letters if c == "*" and n == 1 else ""
                yield [(gap, " "), (none, ""), *((SWAP, x) for x in LEET.get(c, "") if n <= 2), *((SWAP, 2 * x) for x in LEET.get(c, "") if n == 2), *((STAR, x) for x in wild)]

    def restore(self, span: str) -> str:
        """The cheapest path through the span's lattice."""
        if len(span) > 2 * SPAN_CHARS:
            span = LONG_RUN.sub(r"\1\1\1", span)
            return "".join(self._cheapest(span[k : k + SPAN_CHARS]) for k in range(0, len(span), SPAN_CHARS))
        got = self.known.get(span)
        if got is None:
            if len(self.known) > 1 << 16:
                self.known.clear()
            got = self.known[span] = self._cheapest(span)
        return got

    def _cheapest(self, span: str) -> str:
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}  # last two letters -> price, path
        for step in self.options(LONG_RUN.sub(r"\1\1\1", span)):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (price, path) in best.items():
                for more, text in step:
                    x, y, total = a, b, price + more
                    for c in text:
                        k = self.number.get(c, 0)
                        if k or y:  # gaps merge
                            total += self.rows[x][y][k]
                            x, y = (y, k) if k else (0, 0)
                    old = after.get((x, y))
                    if old is None or total < old[0]:
                        after[x, y] = total, (text, path) if text else path
            best = after
        price, path = min((total + (self.rows[a][b][0] if b else 0), k, path) for k, ((a, b), (total, path)) in enumerate(best.items()))[::2]
        out = []
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))

    def restored(self, text: str) -> str:
        """The text in lower case with its disguised spans restored."""
        return "".join(SPAN.sub(lambda m: self.restore(m[0]), part) for part in stretches(text))

    def words(self, text: str) -> Counter:
        """How often each distinct word stands in the restored text. Plain words, most of all, are known without the patterns."""
        out: Counter = Counter()
        for part in stretches(text):
            thrice = TRIPLE.search(part) is not None
            for token, n in Counter(APART.sub(lambda m: self.restore(m[0]), part).split()).items():
                bare = token.rstrip(ENDS)
                if bare.isalpha() and not (thrice and TRIPLE.search(bare)):
                    out[bare] += n
                else:
                    for word in WORD.findall(SPAN.sub(lambda m: self.restore(m[0]), token)):
                        out[word] += n
        return out


def entries(words: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Each distinct word with its stem, which a mark tells from words."""
    return ((w, f"~{w[:STEM]}") for w in words)


def evidence(toxic: np.ndarray, clean: np.ndarray, toxic_docs: int, clean_docs: int) -> np.ndarray:
    """Lower confidence bound of the log ratio of an entry's shares in toxic and clean documents."""
    a, b = toxic + 0.5, clean + 0.5
    return np.log(a / (toxic_docs + 1)) - np.log(b / (clean_docs + 1)) - ERRORS * np.sqrt(1 / a + 1 / b)


def measures(words: Iterable[str], n_words: int, lexicon: dict[str, float]) -> list[float]:
    """What the curve sees of a document, its distinct words and the number of all: evidence in all, its largest part, how many words carry it, all over the text's length. Texts
    without evidence look alike, whatever their length."""
    found = [e for w, stem in entries(words) if (e := lexicon.get(w) or lexicon.get(stem))]
    total, length = sum(found), np.log1p(n_words)
    return [1.0, np.sqrt(total), max(found, default=0.0), np.log1p(len(found)), np.log1p(total / (1 + length))]


MEASURES = 5


@dataclass
class Model:
    channel: Channel
    lexicon: dict[str, float]
    curve: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([measures(w, w.total(), self.lexicon) for w in map(self.channel.words, texts)]).reshape(-1, MEASURES)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))


def language(counts: np.ndarray) -> np.ndarray:
    """Price of each letter after two others, in nats: shares at three orders, each leaning on the one below by its kinds of letters."""
    two, one = counts.sum(0), counts.sum((0, 1))
    p = (1 - EVEN) * one / max(one.sum(), 1) + EVEN / len(one)
    for c in (two, counts):
        kinds = (c > 0).sum(-1, keepdims=True) + 1
        p = (c + kinds * p) / (c.sum(-1, keepdims=True) + kinds)
    return -np.log(p)


def plain_words(text: str) -> set[str]:
    """The distinct words of a text that no disguised span holds. Plain words, most of all, are known without the patterns."""
    out: set[str] = set()
    for part in stretches(text):
        thrice = TRIPLE.search(part) is not None
        for token in set(APART.sub(" ", part).split()):
            bare = token.rstrip(ENDS)
            if bare.isalpha() and not (thrice and TRIPLE.search(bare)):
                out.add(bare)
            else:
                out.update(WORD.findall(SPAN.sub(" ", token)))
    return out


def copy_mark(text: str) -> int:
    """The smallest hash of five words in a row: near copies mostly share it."""
    words = text.lower().split()
    return min(xxh64_intdigest(" ".join(words[i : i + 5])) for i in range(max(len(words) - 4, 1))) - (1 << 63)


def learned(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[tuple[int, int], int], dict[int, int]]:
    """(y, fold, vote, text) of every row that is learned from, written; how many votes each label has in each half; and how many ids have
    each label. Near copies are in one half. Votes are found on rows without texts, so that a text is shuffled once."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
    many = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # texts without a label mostly stay out of the shuffle
    mine = thinned(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text")), bit_table(known, "doc_id"), "doc_id").withColumn("digest", F.xxhash64("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = pa.array([copy_mark(t) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), mark], names=["doc_id", "digest", "mark"])

    marked = written(mine.select("doc_id", "text", "digest").mapInArrow(work, "doc_id bigint, digest bigint, mark bigint").join(known, "doc_id"), "toxicity-marks")
    votes = marked.groupBy("y", "mark").agg(F.count(F.lit(1)).alias("copies"))
    fold = F.pmod(F.xxhash64("mark", F.lit(13)), F.lit(2)).cast("int").alias("fold")
    sizes = {(r["y"], r["fold"]): r["n"] for r in votes.groupBy("y", fold).agg(F.count(F.lit(1)).alias("n")).collect()}
    vote = F.greatest(F.lit(1), F.floor(F.lit(VOTE) / F.coalesce("copies", F.lit(1)))).alias("vote")
    keyed = marked.join(votes.filter("copies > 1"), ["y", "mark"], "left").select("doc_id", "digest", "y", fold, vote).dropDuplicates(["doc_id", "digest"])
    return written(mine.join(keyed, ["doc_id", "digest"]).select("y", "fold", "vote", "text"), "toxicity-rows"), sizes, many


def fit_channel(rows: DataFrame) -> Channel:
    """The language model of the plain words of rows (vote, text); each text counts a word once, by its vote."""

    def count_threes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter = Counter()
            for vote, text in zip(*(c.to_pylist() for c in batch.columns)):
                for w in plain_words(text):
                    words[w] += vote
            n: Counter = Counter()
            for w, votes in words.items():
                # two gaps stand before each word, one after it
                s = f"  {w} "
                for k in range(len(s) - 2):
                    n[s[k : k + 3]] += votes
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["three", "n"])

    threes = written(rows.select("vote", "text").mapInArrow(count_threes, "three string, n bigint").groupBy("three").agg(F.sum("n").alias("n")), "toxicity-letters")
    place = lambda k: F.substring("three", k, 1)
    few = threes.groupBy(place(3).alias("c")).agg(F.sum("n").alias("n")).filter("c <> ' '").orderBy(F.desc("n"), "c").limit(LETTERS)
    letters = "".join(r["c"] for r in few.collect())
    wide = LETTERS + 1
    number = lambda k: F.instr(F.lit(letters), place(k))  # noqa: E731  letters that are not among them count as gaps
    at = threes.select(*(number(k).alias(c) for k, c in enumerate("abc", 1)), "n").filter("b > 0 or c > 0")
    counts = np.zeros((wide, wide, wide))
    # (LETTERS + 1) ** 3 rows at most
    for r in at.groupBy("a", "b", "c").agg(F.sum("n").alias("n")).collect():
        counts[r["a"], r["b"], r["c"]] = r["n"] / VOTE
    return Channel(letters, language(counts).astype(np.float32))


def fit_curve(rows: DataFrame) -> np.ndarray:
    """Logistic weights of rows (y, weight, x) by Newton steps, held a little towards zero. A step's sums are made on the executors."""
    curve, x = np.zeros(MEASURES), [F.col("x")[k] for k in range(MEASURES)]
    pairs = [(i, j) for i in range(MEASURES) for j in range(i, MEASURES)]
    for _ in range(STEPS):
        z = sum((x[k] * float(curve[k]) for k in range(MEASURES)), F.lit(0.0))
        judged = rows.withColumn("p", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
        terms = judged.withColumns({"pull": F.col("weight") * (F.col("y") - F.col("p")), "bend": F.col("weight") * F.greatest(F.col("p") * (1 - F.col("p")), F.lit(1e-6))})
        units = lambda c: F.sum(F.rint(c * UNIT).cast("bigint"))
        sums = np.array(terms.agg(*(units(F.col("pull") * v) for v in x), *(units(F.col("bend") * x[i] * x[j]) for i, j in pairs)).first(), float) / UNIT
        bend = 0.05 * np.eye(MEASURES)
        for (i, j), v in zip(pairs, sums[MEASURES:]):
            bend[i, j] += v
            bend[j, i] = bend[i, j]
        change = np.linalg.solve(bend, sums[:MEASURES] - 0.05 * curve)
        curve = curve + change
        if np.abs(change).max() < SETTLED:
            break
    return curve


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows, sizes, many = learned(docs, labels)
    channel, context = fit_channel(rows), docs.sparkSession.sparkContext
    if len({y for y, _ in sizes}) < 2:
        share = many.get(1, 0) / max(sum(many.values()), 1)
        return Model(channel, {}, np.array([log((share + 1e-6) / (1 - share + 1e-6)), *[0.0] * (MEASURES - 1)]))
    shared = context.broadcast(channel)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [shared.value.words(text) for text in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([w.total() for w in words], pa.int64()), pa.array([list(w) for w in words], pa.list_(pa.string()))], names=["y", "fold", "vote", "n_words", "words"])

    texts = written(rows.mapInArrow(read, "y int, fold int, vote bigint, n_words bigint, words array<string>"), "toxicity-words")
    dropped(rows)
    stems = F.array_distinct(F.transform("words", lambda w: F.concat(F.lit("~"), F.substring(w, 1, STEM))))
    one = texts.select("y", "fold", "vote", F.explode(F.concat("words", stems)).alias("entry"))
    votes_of = lambda y, f: F.round(F.sum(F.when((F.col("y") == y) & (F.col("fold") == f), F.col("vote")).otherwise(0)) / VOTE, 4)
    counted = one.groupBy("entry").agg(*(votes_of(y, f).alias(f"{kind}{f}") for y, kind in enumerate("ct") for f in (0, 1)))
    counted = written(counted.withColumn("t", F.col("t0") + F.col("t1")).filter("t > 0"), "toxicity-entries")
    # a stem tells more than its words only if none of them stands in most of its documents
    stem = F.when(~F.col("entry").startswith("~"), F.concat(F.lit("~"), F.substring("entry", 1, STEM)))
    most = counted.groupBy(stem.alias("entry")).agg(F.max("t").alias("most"))
    counted = counted.filter(F.col("t") >= SUPPORT).join(most, "entry", "left").filter(~F.col("entry").startswith("~") | (F.col("t") >= 2 * F.col("most")))
    a, b = F.col("t") + 0.5, F.col("c0") + F.col("c1") + 0.5
    docs_of = lambda y, *folds: sum(sizes.get((y, f), 0) for f in folds)
    bound = F.log(a / (docs_of(1, 0, 1) + 1)) - F.log(b / (docs_of(0, 0, 1) + 1)) - ERRORS * F.sqrt(1 / a + 1 / b)
    top = counted.withColumn("e", bound).filter(F.col("e") >= LEAST).orderBy(F.desc("e"), "entry").limit(LEXICON).collect()  # bounded by LEXICON

    def lexicon(*folds: int) -> dict[str, float]:
        t, c = (np.array([sum(r[f"{kind}{f}"] for f in folds) for r in top], float) for kind in "tc")
        e = evidence(t, c, docs_of(1, *folds), docs_of(0, *folds))
        return {r["entry"]: float(x) for r, x in zip(top, e) if x >= LEAST}

    halves = context.broadcast([lexicon(1), lexicon(0)])  # each fold is judged by the other one's words

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [measures(words, n, halves.value[f]) for f, n, words in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], names=["y", "vote", "x"])

    measured = written(texts.mapInArrow(measure, "y int, vote bigint, x array<double>"), "toxicity-measures")
    dropped(texts)
    # near copies have one vote, and labels the shares that they have among ids
    even = sum(sizes.values()) / sum(many.values())
    weigh = lambda y: F.col("vote") / VOTE * (many[y] * even / docs_of(y, 0, 1))
    weighed = measured.select("y", F.when(F.col("y") == 1, weigh(1)).otherwise(weigh(0)).alias("weight"), "x")
    return Model(channel, lexicon(0, 1), fit_curve(weighed))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of each document of a table with doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, "doc_id bigint, score double, predicted int")


def restored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text): each document's text in lower case, disguised spans restored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shared.value.channel.restored(t or "") for t in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, "doc_id bigint, text string")
