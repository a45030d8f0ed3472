"""Packing of documents into sequences of a fixed number of tokens by large-item matching.

Pieces above a third of the capacity stand at most twice in a sequence: taken from the largest down, each is matched with the
largest other one that still fits. Smaller pieces, from the largest down, go to the sequence with the tightest gap that holds
them. Pieces are dealt by hash into groups of about GROUP_PIECES, each packed in one task; a group's last sequences are the only
ones that the dealing can leave open, so the cost is below one sequence in a thousand, at any size of the corpus.

Null and empty texts are the end id alone. Documents above the capacity are cut into full pieces, the first may be shorter.
Repeated rows are packed each. An empty table gives no pieces. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PATTERN, Vocabulary, encoder
from .shared import written

CAPACITY, END_ID = 2048, 0
#: Pieces packed together in one task.
GROUP_PIECES = 4096
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, row_key bigint, sequence_id bigint, offset bigint"


def library(tokenizer: str) -> tiktoken.Encoding:
    """The tokenizer file's vocabulary in the faster of the public libraries; ids are equal, special tokens included."""
    v = Vocabulary(tokenizer)
    ranks = {token: i for token, i in v.ids.items()}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=v.special)


def encoded(text: str, encoding: tiktoken.Encoding, tokenizer: str) -> bytes:
    """The ids of a text. The library's regex engine gives up on about a million white-space characters in a row; such a text goes
    through the transducer, which gives equal ids."""
    try:
        return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
    except ValueError:
        return b"".join(np.array(ids, "<u4").tobytes() for ids in encoder(tokenizer).encode(text))


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """PIECES: each document's ids and END_ID, cut where they exceed the capacity; ids are little-endian unsigned 32-bit numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, end = library(tokenizer), END_ID.to_bytes(4, "little")
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoded(text or "", encoding, tokenizer) + end
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, start in enumerate([0, *range(first, n, capacity)]):
                    size = first if k == 0 else capacity
                    rows.append((doc, k, start, size, ids[4 * start : 4 * (start + size)]))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, PIECES)


def match(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each piece and the number of sequences. Bit sets over lengths and gaps find partners and gaps."""
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]
    there, open_, n = 0, 0, 0
    large = [int(i) for i in order if 3 * lengths[i] > capacity]
    for i in reversed(large):
        stacks[lengths[i]].append(i)
        there |= 1 << int(lengths[i])

    def put(i: int, sequence: int, at: int) -> None:
        nonlocal open_
        place[i], offset[i] = sequence, at
        gap = capacity - at - int(lengths[i])
        gaps[gap].append(sequence)
        open_ |= 1 << gap

    def take(size: int) -> int:
        nonlocal there
        i = stacks[size].pop()
        if not stacks[size]:
            there &= ~(1 << size)
        return i

    while there:
        size = there.bit_length() - 1
        i = take(size)
        fits = there & ((1 << (capacity - size + 1)) - 1)
        if fits:
            place[i] = n
            put(take(fits.bit_length() - 1), n, size)
        else:
            put(i, n, 0)
        n += 1
    for i in map(int, order[len(large) :]):
        size = int(lengths[i])
        wide = open_ >> size
        if wide:
            gap = size + (wide & -wide).bit_length() - 1
            sequence = gaps[gap].pop()
            if not gaps[gap]:
                open_ &= ~(1 << gap)
            put(i, sequence, capacity - gap)
        else:
            put(i, n, 0)
            n += 1
    return place, offset, n


def place(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """pieces (PIECES without ids, with ids_crc32 and row_key) -> PLACED. sequence_id: the group's number, then one within it."""
    groups = max(1, -(-pieces.count() // group_pieces))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "row_key"], ascending=[False, True, True, True], kind="stable")
        sequence, offset, _ = match(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=pdf["grp"] * (1 << 32) + sequence, offset=offset).drop(columns="grp")

    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "row_key"), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(work, PLACED)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """PLACED without row_key: where each piece stands."""
    pieces = cut(docs, tokenizer, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    pieces = written(pieces.withColumn("row_key", F.monotonically_increasing_id()), "pieces")
    return place(pieces, capacity).drop("row_key")


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences themselves, ids as little-endian unsigned 32-bit numbers."""
    whole_pieces = written(cut(docs, tokenizer, capacity).withColumns({"ids_crc32": F.crc32("ids"), "row_key": F.monotonically_increasing_id()}), "pieces-with-ids")
    placed = place(whole_pieces.drop("ids"), capacity).select("row_key", "sequence_id", "offset", "length")
    rows = placed.join(whole_pieces.select("row_key", "ids"), "row_key")
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    rows = rows.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    return rows.select("sequence_id", "n_tokens", F.unhex(F.array_join(F.col("parts.ids"), "")).alias("ids"))
