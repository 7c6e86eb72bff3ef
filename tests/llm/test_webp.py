"""The decoder against images written by a test-only encoder that uses every feature."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import webp


class Out:
    def __init__(self):
        self.bits = []

    def put(self, v, n):
        self.bits += [(v >> i) & 1 for i in range(n)]

    def code(self, lengths):
        """Writes a normal code with explicit lengths (and its own length code of 4-bit entries); returns symbol -> bit string."""
        self.put(0, 1)
        self.put(15, 4)  # all 19 lengths
        for s in webp.LENGTH_ORDER:
            self.put(4 if s < 16 else 0, 3)
        self.put(0, 1)
        for n in lengths:
            self.bits += [int(b) for b in f"{n:04b}"]
        return canonical(lengths)

    def send(self, word):
        self.bits += [int(b) for b in word]

    def data(self):
        return np.packbits(np.array(self.bits, np.uint8), bitorder="little").tobytes()


def canonical(lengths):
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    if len(used) == 1:
        return {used[0][1]: ""}
    code, last, out = 0, 0, {}
    for n, s in used:
        code <<= n - last
        out[s] = f"{code:0{n}b}"
        code, last = code + 1, n
    return out


def lengths_for(symbols, alphabet):
    """Complete and not flat: 1, 2, 3, ... n-1, n-1 bits for few symbols, else a flat code with a deeper pair."""
    symbols = sorted(set(symbols)) or [0]
    out = [0] * alphabet
    if len(symbols) <= 14:
        for i, s in enumerate(symbols):
            out[s] = 1 if len(symbols) == 1 else min(i + 1, len(symbols) - 1)
        return out
    width = (len(symbols) - 1).bit_length()
    short = (1 << width) - len(symbols)  # these get one bit less
    for i, s in enumerate(symbols):
        out[s] = width - (i < short)
    return out


def prefix(value):
    """Length or distance as prefix symbol, extra bit count, extra bits."""
    if value <= 4:
        return value - 1, 0, 0
    v = value - 1
    top = v.bit_length() - 1
    second = (v >> (top - 1)) & 1
    return 2 * top + second, top - 1, v - ((2 + second) << (top - 1))


def plan(argb, width, cache_bits, copies):
    ops, at, cache = [], 0, [0] * (1 << cache_bits)

    def remember(p):
        if cache_bits:
            cache[(0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p

    while at < len(argb):
        best = (0, 0)
        if copies:
            for d in (1, width, width + 1, 7, 200):
                n = 0
                while at + n < len(argb) and at + n - d >= 0 and argb[at + n] == argb[at + n - d] and n < 300:
                    n += 1
                best = max(best, (n, d))
        if best[0] >= 3:
            n, d = best
            code = next((i + 1 for i, (x, y) in enumerate(webp.NEAR) if x + y * width == d), d + 120)
            ops.append(("copy", n, code, at))
            for p in argb[at : at + n]:
                remember(p)
            at += n
            continue
        p = argb[at]
        key = (0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else 0
        ops.append(("cache", key, 0, at) if cache_bits and cache[key] == p else ("pixel", p, 0, at))
        remember(p)
        at += 1
    return ops


def write_image(out, argb, width, top, cache_bits=0, copies=False, block=0):
    argb = [int(x) for x in argb]
    ops = plan(argb, width, cache_bits, copies)
    out.put(int(cache_bits > 0), 1)
    if cache_bits:
        out.put(cache_bits, 4)
    group = lambda at: 0
    groups = 1
    if top:
        out.put(int(block > 0), 1)
        if block:
            out.put(block - 2, 3)
            height, across = len(argb) // width, -(-width >> block)
            rows = -(-height >> block)
            groups = 2
            out_groups = [(i * 7 // 3) % 2 for i in range(across * rows)]
            write_image(out, [g << 8 for g in out_groups], across, False)
            group = lambda at: out_groups[(at // width >> block) * across + (at % width >> block)]
            groups = max(out_groups) + 1
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    tables = []
    for g in range(groups):
        used = [[] for _ in sizes]
        for kind, a, b, at in ops:
            if group(at) != g:
                continue
            if kind == "pixel":
                for which, shift in ((0, 8), (1, 16), (2, 0), (3, 24)):
                    used[which].append((a >> shift) & 255)
            elif kind == "copy":
                used[0].append(256 + prefix(a)[0])
                used[4].append(prefix(b)[0])
            else:
                used[0].append(280 + a)
        tables.append([out.code(lengths_for(u, n)) for u, n in zip(used, sizes)])
    for kind, a, b, at in ops:
        t = tables[group(at)]
        if kind == "pixel":
            for which, shift in ((0, 8), (1, 16), (2, 0), (3, 24)):
                out.send(t[which][(a >> shift) & 255])
        elif kind == "copy":
            s, n, extra = prefix(a)
            out.send(t[0][256 + s])
            out.put(extra, n)
            s, n, extra = prefix(b)
            out.send(t[4][s])
            out.put(extra, n)
        else:
            out.send(t[0][280 + a])


def sub(a, b):
    return sum((((a >> s) - (b >> s)) & 255) << s for s in (0, 8, 16, 24))


def pixels_of(ch):
    return ch[0] << 24 | ch[1] << 16 | ch[2] << 8 | ch[3]


def forward(argb, width, height, transforms, out, rng):
    now = width
    for kind in transforms:
        out.put(1, 1)
        out.put(kind, 2)
        if kind == webp.SUBTRACT_GREEN:
            argb = [(p & 0xFF00FF00) | ((p >> 16) - (p >> 8) & 255) << 16 | (p - (p >> 8) & 255) for p in argb]
        elif kind == webp.PALETTE:
            colours = sorted(set(argb))
            out.put(len(colours) - 1, 8)
            write_image(out, [colours[0]] + [sub(b, a) for a, b in zip(colours, colours[1:])], len(colours), False)
            per = {0: 1, 1: 2, 2: 4, 3: 8}[webp._bundle_bits(len(colours))]
            rows = [argb[y * now : (y + 1) * now] for y in range(height)]
            bits = 8 // per
            argb = [webp.BLACK | sum(colours.index(p) << (i * bits) for i, p in enumerate(row[x : x + per])) << 8 for row in rows for x in range(0, now, per)]
            now = -(-now // per)
        else:
            block = 2
            across, down = -(-now >> block), -(-height >> block)
            if kind == webp.PREDICTOR:
                values = [rng.randrange(14) << 8 | webp.BLACK for _ in range(across * down)]
                ch = lambda p: [(p >> s) & 255 for s in (24, 16, 8, 0)]
                new = []
                for i, p in enumerate(argb):
                    y, x = divmod(i, now)
                    if x and y:
                        mode = (values[(y >> block) * across + (x >> block)] >> 8) & 15
                        base = pixels_of(webp.predicted(mode, *(ch(argb[j]) for j in (i - 1, i - now, i - now - 1, i - now + 1))))
                    else:
                        base = argb[i - 1] if x else argb[i - now] if y else webp.BLACK
                    new.append(sub(p, base))
                argb = new
            else:
                values = [rng.randrange(1 << 24) | webp.BLACK for _ in range(across * down)]
                signed = lambda v: (v & 255) - 256 if v & 128 else v & 255
                delta = lambda t, c: (signed(t) * signed(c)) >> 5
                new = []
                for i, p in enumerate(argb):
                    y, x = divmod(i, now)
                    e = values[(y >> block) * across + (x >> block)]
                    r, g, b = (p >> 16) & 255, (p >> 8) & 255, p & 255
                    b -= delta(e >> 8, g) + delta(e >> 16, r)
                    r -= delta(e, g)
                    new.append((p & 0xFF00FF00) | (r & 255) << 16 | (b & 255))
                argb = new
            out.put(block - 2, 3)
            write_image(out, values, across, False)
    return argb, now


def container(data):
    chunk = b"VP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) % 2)
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


def make(argb, width, height, transforms=(), cache_bits=0, copies=False, block=0, seed=1):
    out = Out()
    out.put(0x2F, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(1, 1)
    out.put(0, 3)
    coded, now = forward(list(argb), width, height, transforms, out, random.Random(seed))
    out.put(0, 1)
    write_image(out, coded, now, True, cache_bits, copies, block)
    return container(out.data())


def picture(width, height, colours, seed=2):
    rng = random.Random(seed)
    palette = [rng.randrange(1 << 32) for _ in range(colours)]
    out = []
    for i in range(width * height):
        out.append(out[-rng.choice((1, width, 7))] if i > max(width, 7) and rng.random() < 0.6 else rng.choice(palette))
    return out


P, C, S, X = webp.PREDICTOR, webp.CROSS_COLOUR, webp.SUBTRACT_GREEN, webp.PALETTE


@pytest.mark.parametrize("transforms", [(), (P,), (C,), (S,), (X,), (P, C, S), (S, P), (C, P), (X, P), (X, S)])
@pytest.mark.parametrize("cache_bits,copies,block", [(0, False, 0), (0, True, 0), (5, True, 0), (3, False, 2), (1, True, 3)])
@pytest.mark.parametrize("colours", [2, 4, 13, 60])
def test_features(transforms, cache_bits, copies, block, colours):
    w, h = 21, 13
    argb = picture(w, h, colours)
    got = webp.decode(make(argb, w, h, transforms, cache_bits, copies, block))
    assert got[:2] == (w, h)
    assert got[2].tolist() == argb


def test_one_pixel_and_one_colour():
    for argb, w, h in (([0x01020304], 1, 1), ([0x80FF00FF] * 50, 10, 5), (picture(1, 40, 3), 1, 40), (picture(40, 1, 3), 40, 1)):
        for t in ((), (P,), (X,)):
            assert webp.decode(make(argb, w, h, t, 2, True))[2].tolist() == argb


def test_bad_streams():
    good = webp.encode(b"hello world " * 16)
    for bad in (b"x", good[:-3], b"RIFF" + good[4:8] + b"WEBPVP8 " + good[16:], good[:20] + b"\x2e" + good[21:]):
        with pytest.raises(ValueError):
            webp.decode(bad)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=900), st.sampled_from([1, 3, 192]))
def test_stored_bytes_come_back(data, row):
    payload = webp.padded(data, row)
    w, h, pixels = webp.decode(webp.encode(payload, row))
    assert w == row and (pixels & 255).astype(np.uint8).tobytes() == payload
    assert ((pixels >> 24) == 255).all()


def test_more_rows_than_one_image(monkeypatch):
    monkeypatch.setattr(webp, "MAX_SIDE", 4)
    payload = webp.padded(bytes(range(256)) * 9)
    w, h, pixels = webp.decode(webp.encode(payload))
    assert h == len(payload) // 192 and (pixels & 255).astype(np.uint8).tobytes() == payload


PARTS = ("cache", "copies", "cross-colour", "mixed", "palette", "predictor")


def prose(words, seed, vocabulary=400):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(1, 9))) for _ in range(vocabulary)]
    out = [rng.choice(known) for _ in range(words)]
    return " ".join(out + out[: words // 3]).encode()


def test_forms_of_the_encoder(monkeypatch):
    """Every form, by arrays and symbol by symbol, in one stretch and in many."""
    payloads = [webp.padded(prose(n, n)) for n in (1, 30, 200, 3000)] + [webp.padded("é".encode() * 700), webp.padded(b"ab" * 4000), webp.padded(bytes(range(256)) * 40), webp.padded(b"")]
    seen = set()
    for forms in (("cross-colour",), ("cache",), ("predictor",)):
        monkeypatch.setattr(webp, "FORMS", forms)
        for payload in payloads:
            media = webp.encode(payload)
            for stretch, few in ((1 << 15, 64), (100, 64), (1 << 15, 1 << 40)):
                monkeypatch.setattr(webp, "STRETCH", stretch)
                monkeypatch.setattr(webp, "FEW_PIXELS", few)
                w, h, pixels, made_of = webp._decode(media)
                assert pixels.astype(np.uint8).tobytes() == payload and ((pixels >> 24) == 255).all()
                seen |= set(made_of.split("+"))
    assert seen == set(PARTS)


def test_modes_by_bands():
    """A band of equal columns follows the upper pixel, one of equal rows the left one."""
    rng = np.random.default_rng(3)
    columns = np.tile(rng.integers(0, 256, 192, np.uint8), (512, 1))
    rows = np.repeat(rng.integers(0, 256, 300, np.uint8)[:, None], 192, axis=1)
    grey = np.vstack([columns, rows])
    residual, modes = webp._predict(grey)
    assert modes == [2, 1] and np.count_nonzero(residual) < 1000
    argb = webp.unpredict(residual.ravel().astype(np.uint32) * 0x010101, np.array(modes), webp.BAND, 192, 812)
    assert argb.astype(np.uint8).tobytes() == grey.tobytes()


@given(st.lists(st.integers(0, 10**6), min_size=2, max_size=300).filter(any))
@settings(max_examples=100, deadline=None)
def test_code_lengths_are_complete(counts):
    lengths = webp.code_lengths(np.array(counts))
    used = lengths[lengths > 0]
    assert len(used) == np.count_nonzero(counts) and lengths.max() <= 14
    assert len(used) == 1 or sum(1 << (15 - int(n)) for n in used) == 1 << 15


@pytest.mark.parametrize("few", [0, 64])
def test_typed_vector(monkeypatch, few):
    """Bits written out by hand from the public text of the format: greens 7, 9, and a copy of three from two before."""
    monkeypatch.setattr(webp, "FEW_PIXELS", few)
    bits = "".join(
        (
            "11110100",  # 0x2F, low bit first
            "00100000000000" + "00000000000000",  # five pixels wide, one high
            "1" + "000",  # alpha in use, version 0
            "0" + "0" + "0",  # no transform, no colour cache, one group of codes
            "0" + "1000",  # green: lengths of the code-length code for 17, 18, 0, 1, 2
            "000" + "010" + "010" + "010" + "010",
            "1" + "100" + "1101",  # 2 + 11 code lengths follow, the count in four bits
            "00" * 7 + "10" + "00" + "10",  # 7 and 9: two bits
            "11" + "1111111" + "11" + "1100011",  # 138 and 110 zeros
            "01",  # 258, a length of three: one bit
            "1000" + "1000",  # red and blue: 0
            "101" + "11111111",  # alpha: 255
            "101" + "00100000",  # distance: prefix 4
            "10" + "11" + "0" + "1",  # 7, 9, copy; distance code 6 is two to the left
        )
    )
    bits += "0" * (-len(bits) % 8)
    data = bytes(int(bits[i : i + 8][::-1], 2) for i in range(0, len(bits), 8))
    w, h, pixels = webp.decode(container(data))
    assert (w, h, pixels.tolist()) == (5, 1, [0xFF000000 | g << 8 for g in (7, 9, 7, 9, 7)])


def test_added_columns_replace_others(spark):
    rows = spark.createDataFrame([(1, bytearray(b"some text"), "x"), (2, None, "y")], "id int, payload binary, width string")
    back = webp.load_bytes(webp.store_bytes(rows, "payload"))
    assert sorted(back.columns) == ["feature", "id", "made_of", "media", "payload", "width"]
    assert {r.id: bytes(r.payload).rstrip() for r in back.collect()} == {1: b"some text", 2: b""}
    own = webp.store_bytes(rows.withColumnRenamed("payload", "media"), "media")
    assert own.columns == ["id", "width", "media"]
    shown = webp.decode_column(own)
    assert shown.columns == ["id", "media", "width", "height", "pixels"] and {r.width for r in shown.collect()} == {192}


def test_every_part_runs_over_the_table(spark, small):
    found = webp.media_digests(spark.read.parquet(f"{small}/documents.parquet")).select("made_of").distinct().collect()
    assert {part for r in found for part in r.made_of.split("+")} >= set(PARTS)


def test_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    own = spark.createDataFrame([(-1, None), (-2, ""), (-3, "é" * 20000), (-3, "é" * 20000), (-4, prose(600_000, 1).decode())], "doc_id long, text string")
    rows = docs.unionByName(own).selectExpr("*", "1 as media", "'x' as payload")
    texts = {r.doc_id: r.text for r in rows.collect()}
    got = webp.media_digests(rows).collect()
    assert len(got) == rows.count()
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        padded = webp.padded(data)
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(data), len(padded), zlib.crc32(padded[-16:]))
        assert r.payload_sha256 == __import__("hashlib").sha256(padded).hexdigest()
    assert webp.media_digests(rows.limit(0)).count() == 0
    argb = picture(9, 5, 30)
    media = spark.createDataFrame([(1, bytearray(make(argb, 9, 5, (P,)))), (2, None)], "id int, media binary")
    one, none = sorted(webp.decode_column(media).collect(), key=lambda r: r.id)
    assert (one.width, one.height, len(one.pixels)) == (9, 5, 180) and none.pixels is None
    assert bytes(one.pixels[:4]) == bytes([(argb[0] >> s) & 255 for s in (16, 8, 0, 24)])
