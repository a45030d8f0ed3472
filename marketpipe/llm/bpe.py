"""Byte-level BPE as a bounded-lookahead streaming transducer, and decoding as an incremental byte-to-text machine.

Encoding reads a pre-token byte by byte. For each prefix it holds the one token that ends the prefix's encoding: the token that
is compatible with the last token of the prefix before it (two tokens are compatible when encoding their joined bytes gives
just these two). A boundary is stable once the encodings of all prefixes that later tokens can start from pass through it; then
everything before it is emitted and forgotten. The merge list's sufficient lookahead bounds how far this can lag behind.
Frequent pre-tokens come from a bounded cache.

Null and empty texts encode to no tokens. Texts of any length run in constant memory: pre-tokens are drawn from an iterator and
ids leave in chunks. Special tokens written in a text are recognised, as the public library does.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how byte-level vocabularies of this kind split text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same in the standard library's engine, for texts without the characters that the two engines class differently.
QUICK = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: What may be classed differently: some separators, and numbers that are no decimal digits, which are rare below U+0250.
CONTROL, ODD = re.compile("[\x1c-\x1f]"), re.compile("[\x1c-\x1f\x85²³¹¼½¾\u0250-\U0010ffff]")
#: Pre-tokens kept in the cache, and the longest that may enter it.
CACHE_ENTRIES, CACHE_BYTES = 250_000, 64
#: Pre-tokens encoded at a time.
CHUNK = 1 << 16


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.tokens: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.tokens |= {i: t.encode() for t, i in self.special.items()}
        self.ids = {self.tokens[i]: i for i in vocab.values()}
        self.bytes_ids = [self.ids[bytes([b])] for b in range(256)]
        self.longest = max(map(len, self.ids))
        #: Every beginning of a token -> the token that it is, or -1.
        self.starts = {t[:n]: -1 for t in self.ids for n in range(1, len(t))} | self.ids

    def lookahead(self) -> int:
        """Bytes after a token's end that can decide whether it ends there.

        A merge (a, b) is prevented only by an earlier merge that takes b, or a token on b's right edge, together with what
        follows; that merge in turn by a yet earlier one. The longest such chain, in bytes, is enough lookahead.
        """
        edge: dict[int, list[int]] = {i: [i] for i in self.bytes_ids}
        best: dict[int, int] = {}
        most = 0
        for (a, b), (_, merged) in self.merges.items():
            reach = len(self.tokens[b]) + max((best.get(x, 0) for x in edge[b]), default=0)
            edge.setdefault(merged, [merged, *edge[b]])
            best[a] = max(best.get(a, 0), reach)
            most = max(most, reach)
        return most


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.lookahead = vocabulary.lookahead()
        self.rank = {pair: rank for pair, (rank, _) in vocabulary.merges.items()}
        self.made = {merged: (pair, rank) for pair, (rank, merged) in reversed(vocabulary.merges.items())}
        self.edges: tuple[dict, dict] = {}, {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = Words(lambda word: tuple(self.stream(word)))
        self.exact = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.cuts = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at a token's right (1) or left (0) edge while it is built, each with the rank that ends it."""
        out = self.edges[side].get(token)
        if out is None:
            out, at, until = [], token, float("inf")
            while True:
                out.insert(0, (at, until))
                if at not in self.made:
                    break
                pair, until = self.made[at]
                at = pair[side]
            self.edges[side][token] = out
        return out

    def fits(self, a: int, b: int) -> bool:
        """Whether token b can follow token a; a below 0 is the start. False if a merge across their border comes first."""
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        if len(self.pairs) >= CACHE_ENTRIES:
            self.pairs.clear()
        known = True
        if a >= 0:
            left, right, i, j = self.edge(a, 1), self.edge(b, 0), 0, 0
            while known:
                (x, x_ends), (y, y_ends) = left[i], right[j]
                across = self.rank.get((x, y))
                if across is not None and across < x_ends and across <= y_ends:
                    known = False
                elif x_ends == y_ends == float("inf"):
                    break
                elif x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
        self.pairs[a, b] = known
        return known

    def stream(self, data: bytes) -> Iterator[int]:
        """Tokens of one pre-token's bytes, each as soon as it is stable. Holds only the boundaries that are not yet emitted."""
        starts, pairs, fits, longest, n = self.v.starts.get, self.pairs.get, self.fits, self.v.longest, len(data)
        last, base, due = {0: -1}, 0, longest + self.lookahead
        for at in range(n):
            before = last[at]
            for end in range(at + 1, n + 1):
                token = starts(data[at:end])
                if token is None:
                    break
                if token >= 0 and end not in last:
                    known = pairs((before, token))
                    if fits(before, token) if known is None else known:
                        last[end] = token
            if at - base >= due:
                done = self.settled(last, at)
                if done > base:
                    yield from self.path(last, base, done)
                    last = {p: t for p, t in last.items() if p >= done}
                    base = done
                due = at - base + longest
        yield from self.path(last, base, n)

    def settled(self, last: dict[int, int], at: int) -> int:
        """The last boundary through which the encodings of all live prefixes pass."""
        live = {p for p in range(at - self.v.longest + 1, at + 1) if p in last}
        while len(live) > 1:
            p = max(live)
            live.remove(p)
            live.add(p - len(self.v.tokens[last[p]]))
        return live.pop()

    def path(self, last: dict[int, int], start: int, end: int) -> list[int]:
        out = []
        while end > start:
            out.append(last[end])
            end -= len(self.v.tokens[last[end]])
        return out[::-1]

    def pretokens(self, text: str) -> Iterator[list[str]]:
        """Chunks of pre-tokens of a text without special tokens."""
        pattern = self.exact if (CONTROL if text.isascii() else ODD).search(text) else QUICK
        if len(text) <= 4 * CHUNK:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while part := list(islice(found, CHUNK)):
            yield part

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Chunks of ids."""
        for kind, part in self.split(text or ""):
            if kind is not None:
                yield [kind]
            else:
                for words in self.pretokens(part):
                    yield list(chain.from_iterable(map(self.words.__getitem__, words)))

    def split(self, text: str) -> Iterator[tuple[int | None, str]]:
        """(special id or None, the text between)."""
        at = 0
        if self.cuts is not None and any(s in text for s in self.v.special):
            for m in self.cuts.finditer(text):
                if m.start() > at:
                    yield None, text[at : m.start()]
                yield self.v.special[m.group()], ""
                at = m.end()
        if at < len(text):
            yield None, text[at:] if at else text


class Words(dict):
    """Pre-token -> what make() returns for its bytes. Holds two bounded generations; words in use move to the younger one."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, word: str):
        found = self.older.get(word)
        if found is None:
            data = word.encode()
            found = self.make(data)
            if len(data) > CACHE_BYTES:
                return found
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Decoder:
    """Ids in, text out; holds at most the bytes of one unfinished character. Broken sequences become U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens, self.machine = vocabulary.tokens, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.tokens.__getitem__, ids)))

    def end(self) -> str:
        return self.machine.decode(b"", True)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary(path))
    return _ENCODERS[path]


ROUND_TRIP = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document: encoded, and its ids decoded again, chunk by chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        shown = {i: str(i) for i in enc.v.tokens}
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                n, a, b, dec, comma = 0, hashlib.sha256(), hashlib.sha256(), Decoder(enc.v), ""
                for ids in enc.encode(text):
                    if ids:
                        n += len(ids)
                        a.update((comma + ",".join(map(shown.__getitem__, ids))).encode())
                        b.update(dec.feed(ids).encode())
                        comma = ","
                b.update(dec.end().encode())
                counts.append(n)
                ids_sha.append(a.hexdigest())
                text_sha.append(b.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, ROUND_TRIP)
