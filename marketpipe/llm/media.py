"""Media columns: payloads kept losslessly in baseline JPEG files, and features read back from the files.

A baseline file stores quantised coefficients exactly, so the coefficient is the unit that carries one payload byte: byte b is the
coefficient b + 1, 192 bytes are one minimum coded unit (three components of 64 coefficients), all quantisers are 1. A restart
marker follows every unit; the reader decodes the units between markers side by side in numpy, one symbol of every unit a step.
The reader parses markers and tables from the file, so it reads other baseline files without subsampling as well. The thumbnail
is the luminance image that the DC coefficients alone give; the feature is the size and the thumbnail's difference hash.

Null text counts as empty; an empty payload is 192 spaces. Equal texts give equal files. Texts of any length are written and
read in blocks of units. Repeated rows give equal values; an empty table gives none. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT, BLANK = 192, b" "
#: Units that are coded together in numpy.
BLOCK_UNITS = 6000
#: The most units in a row or column: sizes have 16 bits.
MOST = 8191
#: Huffman code length of each symbol: a coefficient's bit length (no zeros before it), or 0x00 and 0xF0 for runs of zeros.
CODE_BITS = {7: 1, 6: 2, 8: 3, 4: 4, 5: 5, 0x00: 8, 1: 8, 2: 8, 3: 8, 9: 8, 0xF0: 8}


def huffman(counts: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """Symbol -> (code, bits) of a table as stored: the number of codes of each length from 1, and the symbols in order."""
    out, code, at = {}, 0, 0
    for bits, n in enumerate(counts, 1):
        for s in symbols[at : at + n]:
            out[s] = (code, bits)
            code += 1
        at += n
        code <<= 1
    return out


def stored(lengths: dict[int, int]) -> tuple[list[int], list[int]]:
    return [sum(v == n for v in lengths.values()) for n in range(1, 17)], sorted(lengths, key=lambda s: (lengths[s], s))


def tables() -> tuple[np.ndarray, np.ndarray]:
    """For each coefficient 0..256: its bits (code, then value) and their number."""
    codes = huffman(*stored(CODE_BITS))
    word, bits = np.zeros(257, np.uint32), np.zeros(257, np.uint8)
    for v in range(1, 257):
        size = v.bit_length()
        code, n = codes[size]
        word[v], bits[v] = (code << size) | v, n + size
    return word, bits


WORD, BITS = tables()


def blank_unit() -> bytes:
    """A unit without coefficients: a zero difference and an end of block for each component."""
    code, n = huffman(*stored(CODE_BITS))[0]
    value = 0
    for _ in range(6):
        value = (value << n) | code
    return value.to_bytes(6, "big")


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(cols: int, rows: int, n_bytes: int) -> bytes:
    counts, symbols = stored(CODE_BITS)
    table = bytes(counts) + bytes(symbols)
    frame = struct.pack(">BHHB", 8, 8 * rows, 8 * cols, 3) + b"".join(bytes((c, 0x11, 0)) for c in (1, 2, 3))
    scan = bytes((3, 1, 0, 2, 0, 3, 0, 0, 63, 0))
    return b"\xff\xd8" + segment(0xFE, b"payload %d" % n_bytes) + segment(0xDB, bytes([0]) + bytes([1] * 64)) + segment(0xC0, frame) + segment(0xC4, b"\x00" + table + b"\x10" + table) + segment(0xDD, struct.pack(">H", 1)) + segment(0xDA, scan)


def shape(units: int) -> tuple[int, int]:
    """Columns and rows of units: nearly square."""
    cols = max(1, int(np.ceil(np.sqrt(units))), -(-units // MOST))
    return cols, -(-units // cols)


def code_units(units: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of units (n, 192), each with its restart marker, and where each ends."""
    coefficients = units.astype(np.int16) + 1
    bits = BITS[coefficients].astype(np.int64)
    used = bits.sum(1)
    size = (used + 7) >> 3
    start = np.cumsum(size) - size
    at = np.cumsum(bits, 1) - bits + (start << 3)[:, None]
    word = WORD[coefficients].astype(np.int64) << (24 - (at & 7) - bits)
    byte, total = (at >> 3).ravel(), int(size.sum()) + 2
    out = sum(np.bincount(byte + k, weights=((word >> (16 - 8 * k)) & 255).ravel(), minlength=total + 2) for k in range(3)).astype(np.int64)[: total - 2]
    out[start + size - 1] += (1 << (8 * size - used)) - 1  # ones fill the last byte
    full = out == 255
    extra = full.astype(np.int64)
    extra[start + size - 1] += 2
    place = np.arange(len(out)) + np.cumsum(extra) - extra
    coded = np.zeros(len(out) + int(extra.sum()), np.uint8)
    coded[place] = out
    ends = place[start + size - 1] + 1 + extra[start + size - 1]
    coded[ends - 2], coded[ends - 1] = 0xFF, 0xD0 + index % 8
    return coded, ends


def padded(text: str | None) -> tuple[int, bytes]:
    data = (text or "").encode()
    units = max(1, -(-len(data) // UNIT))
    return len(data), data.ljust(units * UNIT, BLANK)


def write_files(texts: list[str | None]) -> list[bytes]:
    """One JPEG file for each text. Units of all texts are coded together, block by block."""
    payloads = [padded(t) for t in texts]
    counts = np.array([len(p) // UNIT for _, p in payloads], np.int64)
    owner_ends = np.cumsum(counts)
    parts: list[list[bytes]] = [[] for _ in texts]
    stream = np.frombuffer(b"".join(p for _, p in payloads), np.uint8).reshape(-1, UNIT)
    for lo in range(0, len(stream), BLOCK_UNITS):
        block = stream[lo : lo + BLOCK_UNITS]
        doc = np.searchsorted(owner_ends, np.arange(lo, lo + len(block)), "right")
        coded, ends = code_units(block, np.arange(lo, lo + len(block)) - (owner_ends - counts)[doc])
        last = np.flatnonzero(np.append(np.diff(doc), 1))  # the block's last unit of each document
        begin = 0
        for k in last:
            parts[doc[k]].append(coded[begin : ends[k]].tobytes())
            begin = int(ends[k])
    blank, out = blank_unit(), []
    for (n_bytes, _), m, p in zip(payloads, counts.tolist(), parts):
        cols, rows = shape(m)
        more = b"".join(blank + bytes((0xFF, 0xD0 + i % 8)) for i in range(m, cols * rows))
        out.append(header(cols, rows, n_bytes) + (b"".join(p) + more)[:-2] + b"\xff\xd9")
    return out


class Picture:
    """The markers of one baseline file: size, components, tables, restart interval, comment, and the scan's bytes."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        self.tables: dict[tuple[int, int], dict[int, tuple[int, int]]] = {}
        self.quantisers: dict[int, list[int]] = {}
        self.restart, self.comment, at = 0, b"", 2
        while True:
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xC4:
                while body:
                    counts = list(body[1:17])
                    n = sum(counts)
                    self.tables[body[0] >> 4, body[0] & 15] = huffman(counts, list(body[17 : 17 + n]))
                    body = body[17 + n :]
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quantisers[body[0] & 15] = list(struct.unpack_from(">64H" if wide else ">64B", body, 1))
                    body = body[65 + 64 * wide :]
            elif marker == 0xC0:
                _, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                self.components = [(body[6 + 3 * i], body[7 + 3 * i], body[8 + 3 * i]) for i in range(n)]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xFE:
                self.comment = body
            elif marker == 0xDA:
                picks = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])}
                break
            elif 0xC0 < marker <= 0xCF and marker != 0xC8:
                raise ValueError("not a baseline file")
        if any(s != 0x11 for _, s, _ in self.components):
            raise ValueError("subsampled components")
        self.picks = [picks[c] for c, _, _ in self.components]
        self.cols, self.rows = -(-self.width // 8), -(-self.height // 8)
        raw = np.frombuffer(data, np.uint8, offset=at)
        full = np.flatnonzero(raw[:-1] == 255)
        after = raw[full + 1]
        end = full[(after != 0) & ((after < 0xD0) | (after > 0xD7))][:1]
        self.scan = raw[: int(end[0]) if len(end) else len(raw)]

    def key(self) -> tuple:
        """Equal for files whose scans can be decoded together."""
        return tuple(sorted((k, tuple(sorted(v.items()))) for k, v in self.tables.items())), tuple(self.picks)


def decode_scans(pictures: list[Picture]) -> Iterator[tuple[int, np.ndarray]]:
    """(picture's place in the list, coefficients (units, components, 64) in zigzag order), in blocks, in order."""
    first = pictures[0]
    names = sorted(first.tables)
    lookup = np.zeros((len(names), 1 << 16), np.uint16)
    for row, name in zip(lookup, names):
        for symbol, (code, bits) in first.tables[name].items():
            row[code << (16 - bits) : (code + 1) << (16 - bits)] = (bits << 8) | symbol
    dc = np.array([names.index((0, d)) for d, _ in first.picks])
    ac = np.array([names.index((1, a)) for _, a in first.picks])
    raw = np.concatenate([p.scan for p in pictures])
    sizes = np.array([len(p.scan) for p in pictures])
    begins = np.cumsum(sizes) - sizes
    full = np.flatnonzero(raw[:-1] == 255)
    after = raw[full + 1]
    marks = full[after != 0]
    keep = np.ones(len(raw), bool)
    keep[full + 1], keep[marks] = False, False
    moved = np.append(0, np.cumsum(keep))
    bits = np.append(raw[keep], np.full(8, 255, np.uint8)).astype(np.uint64)
    window = (bits[:-4] << 32) | (bits[1:-3] << 24) | (bits[2:-2] << 16) | (bits[3:-1] << 8) | bits[4:]
    lane_raw = np.sort(np.concatenate([begins, marks + 2]))
    lane_of = np.searchsorted(begins, lane_raw, "right") - 1
    nth = np.arange(len(lane_raw)) - np.searchsorted(lane_of, lane_of, "left")
    all_units = np.array([p.cols * p.rows for p in pictures])
    each = np.array([p.restart or p.cols * p.rows for p in pictures])
    units = np.minimum(each[lane_of], all_units[lane_of] - nth * each[lane_of])
    step = max(1, BLOCK_UNITS // int(units.max()))
    for lo in range(0, len(lane_raw), step):
        hi = min(lo + step, len(lane_raw))
        got = decode_lanes(window, lookup, dc, ac, moved[lane_raw[lo:hi]] << 3, units[lo:hi])
        at = 0
        for k in np.unique(lane_of[lo:hi]):
            n = int(units[lo:hi][lane_of[lo:hi] == k].sum())
            yield int(k), got[at : at + n]
            at += n


def decode_lanes(window: np.ndarray, lookup: np.ndarray, dc: np.ndarray, ac: np.ndarray, place: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Lanes (bit place, units) side by side, one symbol of each a step -> coefficients (units of all lanes, components, 64)."""
    c = len(dc)
    first = (np.cumsum(units) - units) * c * 64
    out = np.zeros(int(units.sum()) * c * 64, np.int16)
    place, block, k = place.astype(np.int64), np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
    blocks = units * c
    before = np.zeros((len(units), c), np.int64)
    live = np.arange(len(units))
    while len(live):
        part = block % c
        table = np.where(k == 0, dc[part], ac[part])
        seen, shift = window[place >> 3], place & 7
        entry = lookup[table, (seen >> (24 - shift).astype(np.uint64)).astype(np.int64) & 0xFFFF].astype(np.int64)
        length, symbol = entry >> 8, entry & 255
        if not length.all():
            raise ValueError("a code that the file has no table for")
        size, run = symbol & 15, symbol >> 4
        value = (seen >> (40 - shift - length - size).astype(np.uint64)).astype(np.int64) & ((1 << size) - 1)
        value = np.where((size > 0) & (value < (1 << np.maximum(size - 1, 0))), value - (1 << size) + 1, value)
        place = place + length + size
        start = k == 0
        if start.any():
            s = np.flatnonzero(start)
            value[s] += before[live[s], part[s]]
            before[live[s], part[s]] = value[s]
            run[s] = 0
        k = k + run
        put = start | (size > 0)
        if put.all():
            out[first[live] + block * 64 + k] = value
        else:
            out[(first[live] + block * 64 + k)[put]] = value[put]
        k = np.where(~start & (size == 0) & (run != 15), 64, k + 1)
        over = k >= 64
        if over.any():
            block, k = block + over, np.where(over, 0, k)
            on = block < blocks[live]
            if not on.all():
                live, place, block, k = live[on], place[on], block[on], k[on]
    return out.reshape(-1, c, 64)


def thumbnail(picture: Picture, dc: np.ndarray) -> np.ndarray:
    """The luminance image that the DC coefficients give, one pixel for each block."""
    q = picture.quantisers[picture.components[0][2]][0]
    return np.clip(np.round(dc * q / 8 + 128), 0, 255).astype(np.uint8).reshape(picture.rows, picture.cols)


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each of 8 x 8 sampled pixels is brighter than its right neighbour."""
    rows, cols = np.arange(8) * image.shape[0] // 8, np.arange(9) * image.shape[1] // 9
    small = image[np.ix_(rows, cols)]
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def read_files(files: list[bytes]) -> list[tuple]:
    """(n_bytes, payload digest, payload_bytes, crc of its last 16 bytes, width, height, thumbnail) of each file of ours."""
    pictures = [Picture(f) for f in files]
    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(pictures):
        groups.setdefault(p.key(), []).append(i)
    out: list[tuple] = [()] * len(files)
    for members in groups.values():
        held: dict[int, list] = {}

        def close(i: int) -> None:
            p, digest, left, tail, dcs = held.pop(i)
            out[i] = (p.n_bytes, digest.hexdigest(), p.payload_bytes, zlib.crc32(tail[-16:]), p.width, p.height, thumbnail(p, np.concatenate(dcs)))

        for local, units in decode_scans([pictures[i] for i in members]):
            i = members[local]
            if i not in held:
                for done in list(held):
                    close(done)
                p = pictures[i]
                p.n_bytes = int(p.comment.split()[1])
                p.payload_bytes = max(1, -(-p.n_bytes // UNIT)) * UNIT
                held[i] = [p, hashlib.sha256(), p.payload_bytes, b"", []]
            state = held[i]
            state[4].append(units[:, 0, 0].astype(np.int64))
            data = (units[: state[2] // UNIT] - 1).astype(np.uint8).tobytes()
            state[1].update(data)
            state[2] -= len(data)
            state[3] = (state[3] + data)[-16:]
        for done in list(held):
            close(done)
    return out


def encode(docs: DataFrame) -> DataFrame:
    """(doc_id, media): each text's payload as a JPEG file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(write_files(part.column(1).to_pylist()), pa.binary())], names=["doc_id", "media"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, "doc_id bigint, media binary")


def slices(batch: pa.RecordBatch, column: int, most: int = BLOCK_UNITS * UNIT) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose column has about as many bytes at most, one row at least."""
    sizes = np.asarray(batch.column(column).cast(pa.binary() if pa.types.is_string(batch.column(column).type) else batch.column(column).type).fill_null(b"").to_numpy(zero_copy_only=False))
    lo, held = 0, 0
    for i, x in enumerate(sizes):
        if i > lo and held + len(x) > most:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += len(x)
    if lo < batch.num_rows:
        yield batch.slice(lo)


FEATURES = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, width int, height int, thumbnail binary, feature string"


def features(media: DataFrame) -> DataFrame:
    """FEATURES of each file of a (doc_id, media) table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("thumbnail", pa.binary()), ("feature", pa.string())])
        for batch in batches:
            for part in slices(batch, 1):
                files = part.column(1).to_pylist()
                rows = []
                for doc, file, (n, digest, size, crc, width, height, image) in zip(part.column(0).to_pylist(), files, read_files(files)):
                    rows.append((doc, n, size, digest, crc, len(file), hashlib.sha256(file).hexdigest(), width, height, image.tobytes(), f"{width}x{height}:{difference_hash(image)}"))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return media.mapInArrow(work, FEATURES)
