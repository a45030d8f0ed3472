import hashlib
import random
import zlib

import numpy as np
import pytest

from marketpipe.llm import media

rng = random.Random(7)
TEXTS = [None, "", "a", "\x00" * 191, "b" * 192, "c" * 193, "ÿé漢😀" * 400, "".join(chr(rng.randrange(1, 0x3000)) for _ in range(4000)), "long " * 300_000, "same", "same"]


def want(text):
    data = (text or "").encode()
    pad = data + b" " * (max(1, -(-len(data) // 192)) * 192 - len(data))
    return len(data), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-16:])


def test_payloads_come_back(docs):
    table = docs(list(enumerate(TEXTS)))
    stored = media.encode(table)
    files = {r["doc_id"]: bytes(r["media"]) for r in stored.collect()}
    for r in media.features(stored).collect():
        text = TEXTS[r["doc_id"]]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == want(text)
        assert r["media_sha256"] == hashlib.sha256(files[r["doc_id"]]).hexdigest() and r["media_bytes"] == len(files[r["doc_id"]])
        assert len(r["thumbnail"]) == (r["width"] // 8) * (r["height"] // 8)
    assert files[9] == files[10] and files[0] == files[1]
    assert media.features(media.encode(docs([]))).count() == 0


def slow_scan(picture):
    """Coefficients of a file's scan, bit by bit, as the standard describes it."""
    raw = picture.scan.tobytes()
    segments, now, i = [], bytearray(), 0
    while i < len(raw):
        if raw[i] == 0xFF and i + 1 < len(raw):
            if raw[i + 1] == 0:
                now.append(0xFF)
            else:
                segments.append(bytes(now))
                now = bytearray()
            i += 2
        else:
            now.append(raw[i])
            i += 1
    segments.append(bytes(now))
    decode = {k: {(bits, code): s for s, (code, bits) in t.items()} for k, t in picture.tables.items()}
    out, left = [], picture.cols * picture.rows
    for seg in segments:
        bits, at, before = "".join(f"{b:08b}" for b in seg), 0, [0] * len(picture.picks)

        def symbol(table):
            nonlocal at
            n = 1
            while (n, int(bits[at : at + n], 2)) not in decode[table]:
                n += 1
            at += n
            return decode[table][n, int(bits[at - n : at], 2)]

        def value(size):
            nonlocal at
            at += size
            v = int(bits[at - size : at] or "0", 2)
            return v if not size or v >> (size - 1) else v - (1 << size) + 1

        for _ in range(min(picture.restart or left, left)):
            unit = []
            for c, (d, a) in enumerate(picture.picks):
                block = [0] * 64
                before[c] += value(symbol((0, d)))
                block[0] = before[c]
                k = 1
                while k < 64:
                    s = symbol((1, a))
                    if s == 0:
                        break
                    k += s >> 4
                    if s & 15:
                        block[k] = value(s & 15)
                    k += 1
                unit.append(block)
            out.append(unit)
            left -= 1
    return np.array(out)


def bits_of(blocks, restart):
    """A scan of one component with runs, negative values and long zero runs, written by the plain rules."""
    lengths = {s: 8 for s in [0x00, 0xF0, *range(1, 11), *(r << 4 | s for r in range(1, 16) for s in (1, 2, 3))]}
    codes = media.huffman(*media.stored(lengths))
    segments, before, bits = [], 0, ""

    def put(s, v, size):
        code, n = codes[s]
        return f"{code:0{n}b}" + (f"{v if v > 0 else v + (1 << size) - 1:0{size}b}" if size else "")

    for i, b in enumerate(blocks):
        if restart and i and i % restart == 0:
            segments.append(bits)
            bits, before = "", 0
        d = b[0] - before
        before = b[0]
        bits += put(abs(d).bit_length(), d, abs(d).bit_length())
        run = 0
        for v in b[1:]:
            if v == 0:
                run += 1
                continue
            while run > 15:
                bits += put(0xF0, 0, 0)
                run -= 16
            size = abs(v).bit_length()
            bits += put(run << 4 | size, v, size)
            run = 0
        if run:
            bits += put(0x00, 0, 0)
    segments.append(bits)
    coded = []
    for s in segments:
        s += "1" * (-len(s) % 8)
        coded.append(bytes(int(s[i : i + 8], 2) for i in range(0, len(s), 8)).replace(b"\xff", b"\xff\x00"))
    return lengths, b"".join(c + (bytes((0xFF, 0xD0 + i % 8)) if i + 1 < len(coded) else b"") for i, c in enumerate(coded))


@pytest.mark.parametrize("restart", [0, 1, 3])
def test_other_baseline_files_are_read(restart):
    r = np.random.default_rng(restart)
    blocks = [[int(r.integers(-200, 200)), *(int(v) if r.random() < 0.15 else 0 for v in r.integers(-7, 8, 63))] for _ in range(12)]
    lengths, scan = bits_of(blocks, restart)
    counts, symbols = media.stored(lengths)
    table = bytes(counts) + bytes(symbols)
    frame = bytes((8, 0, 24, 0, 32, 1, 1, 0x11, 0))
    data = b"\xff\xd8" + media.segment(0xDB, bytes([0]) + bytes([3] * 64)) + media.segment(0xC0, frame) + media.segment(0xC4, b"\x00" + table) + media.segment(0xC4, b"\x10" + table) + media.segment(0xDD, restart.to_bytes(2, "big")) + media.segment(0xDA, bytes((1, 1, 0, 0, 63, 0))) + scan + b"\xff\xd9"
    picture = media.Picture(data)
    got = np.concatenate([u for _, u in media.decode_scans([picture])])
    assert (got[:, 0, :] == np.array(blocks)).all() and (got == slow_scan(picture)).all()
    assert media.thumbnail(picture, got[:, 0, 0].astype(int)).shape == (3, 4)


def test_own_files_agree_with_the_plain_decoder():
    picture = media.Picture(media.write_files(["héllo wörld " * 70])[0])
    assert (np.concatenate([u for _, u in media.decode_scans([picture])]) == slow_scan(picture)).all()
