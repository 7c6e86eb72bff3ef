"""Lossless WebP columns: a decoder of the whole format, and an encoder.

``decode`` reads prefix codes, back-references, the colour cache and meta
prefix codes, and inverts the predictor, cross-colour, subtract-green and
palette transforms. An image of one group of codes is read a stretch of bits
at a time: for every bit position numpy finds where the symbol that would begin
there ends, a short loop hops from symbol to symbol, and all that was hit is
turned into pixels, copies and cache hits as arrays. Images with meta prefix
codes, tiny ones, and caches whose entries displace each other are read symbol
by symbol.

``encode`` stores bytes as grey pixels with prefix codes of mixed lengths and
back-references. Up to 16 values go through a palette and pixel bundling. Any
other payload takes, by its checksum (``FORMS``), one of three forms: cross-colour
(red and blue follow from green), a colour cache, or predictor (left or top, for
each band of rows what leaves more zeros) with cross-colour. The last two are
seldom smaller; they are there so that all of the decoder carries real data. A
payload of more rows than one image can have becomes several images in a row.

Columns: ``decode_column`` gives width, height and RGBA pixels;
``store_bytes`` and ``load_bytes`` carry any byte column through pixels.

Cases: null media gives null; bytes that are not a lossless WebP fail the job;
the empty payload is one row of padding; a very long text becomes images of at
most 3 million pixels, coded one after another; repeated rows are coded row by
row, equal bytes give equal media; ties do not arise; an empty table gives an
empty table; added columns replace columns of their name.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ROW, MAX_SIDE = 192, 16384
GREEN, RED, BLUE, ALPHA, DISTANCE = range(5)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
#: Order in which code lengths of the code-length code are stored (fixed values of the format).
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
BLACK = 0xFF000000
#: Near pixels by distance code: nearest first, then the higher row, then the right side.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, -p[1], p[0] < 0))

TRANSFORM_NAMES = ("predictor", "cross-colour", "subtract-green", "palette")
#: Compressed bytes that are read as arrays at a time.
STRETCH = 1 << 15
#: Images of fewer pixels are read symbol by symbol.
FEW_PIXELS = 64
#: The encoder's copies: least and most pixels, and the farthest source.
LEAST_COPY, MOST_COPY, FARTHEST = 16, 4096, (1 << 20) - 120
#: Forms of images of more than 16 values, by their checksum.
FORMS = ("cross-colour", "cross-colour", "cross-colour", "cross-colour", "cross-colour", "cache", "cache", "predictor")
#: Rows of a band with a predictor of its own, as a power of two.
BAND = 9
#: The encoder's code of code lengths: 0 to 14, 17 and 18, four or five bits each.
LENGTH_CODE = np.array([4] * 13 + [5, 5, 0, 0, 4, 4])


class Bits:
    """Reads bits from the low end of each byte."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def peek(self, n: int) -> int:
        first = self.at >> 3
        return (int.from_bytes(self.data[first : (self.at + n + 7) >> 3], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        out = self.peek(n)
        self.at += n
        if self.at > 8 * len(self.data):
            raise ValueError("the image data end too early")
        return out


class Code:
    """A canonical prefix code given by code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.symbols = np.flatnonzero(lengths)
        used = lengths[self.symbols]
        if not len(self.symbols):
            self.symbols, used = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.width = 0 if len(used) == 1 else int(used.max())
        if len(used) > 1 and int((1 << (15 - used.astype(np.int64))).sum()) != 1 << 15:
            raise ValueError("a prefix code is not complete")
        self.flat = len(used) == 1 or bool((used == used[0]).all())
        self.lengths, self.table = used, None

    def _build(self) -> None:
        self.table = [(0, 0)] * (1 << self.width)
        code = last = 0
        for length, symbol in sorted(zip(self.lengths.tolist(), self.symbols.tolist(), strict=True)):
            code <<= length - last
            low = int(f"{code:0{length}b}"[::-1], 2)
            for i in range(low, 1 << self.width, 1 << length):
                self.table[i] = (symbol, length)
            code, last = code + 1, length

    def array(self) -> np.ndarray:
        """16 * symbol + length for every value of the next ``width`` bits."""
        if not self.width:
            return (self.symbols << 4).astype(np.int32)
        order = np.lexsort((self.symbols, self.lengths))
        lengths = self.lengths[order]
        spans = (1 << self.width) >> lengths
        forward = np.repeat(np.arange(len(order)), spans)  # by bits in the order of the code
        return (self.symbols[order] << 4 | lengths).astype(np.int32)[forward[_reversed(self.width)]]

    def read(self, bits: Bits) -> int:
        if not self.width:
            return int(self.symbols[0])
        if self.table is None:
            self._build()
        symbol, length = self.table[bits.peek(self.width)]
        bits.read(length)
        return symbol


@functools.lru_cache(16)
def _reversed(width: int) -> np.ndarray:
    """Numbers below 2^width with their bits in reverse."""
    out = np.zeros(1, np.int64)
    for _ in range(width):
        out = np.concatenate([out << 1, out << 1 | 1])
    return out


@functools.lru_cache(256)
def _code_of_stored(stored: int) -> Code:
    """The code of code lengths whose own lengths stand in three bits each."""
    own = np.zeros(19, np.int64)
    for i, symbol in enumerate(LENGTH_ORDER):
        own[symbol] = stored >> (3 * i) & 7
    code = Code(own)
    if code.width:
        code._build()
    return code


@functools.lru_cache(4096)
def _code_of_one(symbol: int) -> Code:
    lengths = np.zeros(symbol + 1, np.int64)
    lengths[symbol] = 1
    return Code(lengths)


def _read_code(bits: Bits, alphabet: int) -> Code:
    start = bits.peek(11)
    if start & 1:
        two, wide = start & 2, start & 4
        first = start >> 3 if wide else start >> 3 & 1
        bits.read(11 if wide else 4)
        if not two:
            return _code_of_one(first)
        lengths = np.zeros(alphabet, np.int64)
        lengths[[first, bits.read(8)]] = 1
        return Code(lengths)
    stored = 4 + (start >> 1 & 15)
    bits.read(5)
    of_lengths = _code_of_stored(bits.read(3 * stored))
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    lengths = [0] * alphabet
    if not of_lengths.width and of_lengths.symbols[0] < 16:
        lengths[:left] = [int(of_lengths.symbols[0])] * min(left, alphabet)
        return Code(np.array(lengths, np.int64))
    at, before, width = 0, 8, of_lengths.width
    table = of_lengths.table if width else [(int(of_lengths.symbols[0]), 0)]
    ahead = bits.peek(14 * min(left, alphabet) + 14)  # no length takes more bits
    used, mask = 0, (1 << width) - 1
    while at < alphabet and left:
        left -= 1
        s, n = table[ahead >> used & mask]
        used += n
        if s < 16:
            lengths[at] = s
            before, at = s or before, at + 1
        else:
            base, extra = ((3, 2), (3, 3), (11, 7))[s - 16]
            n = base + (ahead >> used & ((1 << extra) - 1))
            used += extra
            if at + n > alphabet:
                raise ValueError("code lengths exceed the alphabet")
            if s == 16:
                lengths[at : at + n] = [before] * n
            at += n
    bits.read(used)
    return Code(np.array(lengths, np.int64))


def _number(bits: Bits, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    extra = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << extra) + bits.read(extra) + 1


def _read_image(bits: Bits, width: int, height: int, top: bool, seen: set[str] | None = None) -> np.ndarray:
    """An entropy-coded image as flat ARGB numbers; ``seen`` collects what it makes use of."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("the colour cache is too large")
    groups_at, block = None, 0
    if top and bits.read(1):
        block = bits.read(3) + 2
        groups_at = (_read_image(bits, -(-width >> block), -(-height >> block), False) >> 8) & 0xFFFF
    n_groups = int(groups_at.max()) + 1 if groups_at is not None else 1
    sizes = (256 + 24 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    groups = [[_read_code(bits, n) for n in sizes] for _ in range(n_groups)]
    n = width * height
    codes = groups[0]
    if n_groups == 1 and not cache_bits and all(c.flat for c in codes[:4]) and codes[GREEN].symbols[-1] < 256:
        return _read_columns(bits, codes, n)
    seen = set() if seen is None else seen
    if cache_bits:
        seen.add("cache")
    if groups_at is None and n >= FEW_PIXELS and top and codes[GREEN].width:
        pixels = _read_stretches(bits, codes, width, n, cache_bits, seen)
        if pixels is not None:
            return pixels
    out, cache, at = [0] * n, [0] * (1 << cache_bits), 0
    across = -(-width >> block) if groups_at is not None else 0
    shift = 32 - cache_bits
    while at < n:
        if groups_at is not None:
            codes = groups[groups_at[(at // width >> block) * across + (at % width >> block)]]
        s = codes[GREEN].read(bits)
        begin = at
        if s < 256:
            red = codes[RED].read(bits)
            blue = codes[BLUE].read(bits)
            out[at] = codes[ALPHA].read(bits) << 24 | red << 16 | s << 8 | blue
            at += 1
        elif s < 280:
            length = _number(bits, s - 256)
            d = _number(bits, codes[DISTANCE].read(bits))
            if d > 120:
                d -= 120
            else:
                x, y = NEAR[d - 1]
                d = max(1, x + y * width)
            if d > at or at + length > n:
                raise ValueError("a back-reference leaves the image")
            for _ in range(length):
                out[at] = out[at - d]
                at += 1
        else:
            out[at] = cache[s - 280]
            at += 1
        if cache_bits:
            for p in out[begin:at]:
                cache[(0x1E35A7BD * p & 0xFFFFFFFF) >> shift] = p
    return np.array(out, np.uint32)


def _windows(data: bytes, begin: int, n: int) -> np.ndarray:
    """The 25 bits or more that follow each bit of ``n`` bytes, zeros beyond the end."""
    b = np.zeros(n + 4, np.uint8)
    part = np.frombuffer(data, np.uint8)[begin : begin + n + 4]
    b[: len(part)] = part
    words = np.lib.stride_tricks.sliding_window_view(b, 4)[:n].copy().view("<u4")
    return (words >> np.arange(8, dtype=np.uint32)).ravel()


#: Bits after a prefix of a length or distance, and the value that they are added to.
EXTRA = np.array([0, 0, 0, 0] + [(x - 2) >> 1 for x in range(4, 40)], np.int32)
BASE = np.array([1, 2, 3, 4] + [((2 + (x & 1)) << ((x - 2) >> 1)) + 1 for x in range(4, 40)], np.int32)


def _prefix_values(prefix: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Lengths or distances by their prefix and the bits after it."""
    return BASE[prefix] + (following & ((np.uint32(1) << EXTRA[prefix].astype(np.uint32)) - np.uint32(1))).astype(np.int32)


def _read_stretches(bits: Bits, codes: list[Code], width: int, n: int, cache_bits: int, seen: set[str]) -> np.ndarray | None:
    """An image of one group of codes, or None where cache entries displace each other (``bits`` then stay where they are)."""
    tables = [c.array() for c in codes]
    look = lambda which, windows: tables[which][(windows & np.uint32((1 << codes[which].width) - 1)).astype(np.intp)]
    plain = not any(c.width for c in codes[1:4])
    shade = sum(int(codes[which].symbols[0]) << shift for which, shift in ((RED, 16), (BLUE, 0), (ALPHA, 24)) if not codes[which].width)
    at, done, end = bits.at, 0, 8 * len(bits.data)
    parts = []
    while done < n:
        if at >= end:
            raise ValueError("the image data end too early")
        base = at >> 3
        size = min(STRETCH, len(bits.data) - base)
        win = _windows(bits.data, base, size + 12)
        stop = 8 * size
        green = look(GREEN, win[:stop])
        after = np.arange(len(win), dtype=np.int32)  # beyond the stretch every position stays
        after[:stop] += green & 15
        if not plain:
            literal = np.flatnonzero(green < 256 << 4)
            end_of = after[literal]
            for which in (RED, BLUE, ALPHA):
                if codes[which].width:
                    end_of += look(which, win[end_of]) & 15
            after[literal] = end_of
        if codes[GREEN].symbols[-1] >= 256:
            copy = np.flatnonzero((green >= 256 << 4) & (green < 280 << 4))
            p = after[copy] + EXTRA[(green[copy] >> 4) - 256]
            of_distance = look(DISTANCE, win[p])
            after[copy] = p + (of_distance & 15) + EXTRA[of_distance >> 4]
        # hops of four symbols, then the symbols between
        two = after[after]
        hops, hop, x, left = [], memoryview(two[two]), at - 8 * base, n - done
        add = hops.append
        while x < stop and left > 0:  # no more symbols than pixels
            add(x)
            x = hop[x]
            left -= 4
        found = np.empty((len(hops), 4), np.int32)
        found[:, 0] = hops
        found[:, 2] = two[found[:, 0]]
        found[:, 1::2] = after[found[:, ::2]]
        found = found.ravel()
        if found[-1] >= stop:
            found = found[: int(np.searchsorted(found, stop))]
        of_green = green[found]
        symbols = of_green >> 4
        length = np.ones(len(found), np.int32)
        copied = np.flatnonzero((symbols >= 256) & (symbols < 280))
        p = found[copied] + (of_green[copied] & 15)
        prefix = symbols[copied] - 256
        length[copied] = _prefix_values(prefix, win[p])
        total = np.cumsum(length)
        if done + int(total[-1]) >= n:
            last = int(np.searchsorted(total, n - done)) + 1
            found, symbols, of_green, length = found[:last], symbols[:last], of_green[:last], length[:last]
            keep = int(np.searchsorted(copied, last))
            copied, p, prefix = copied[:keep], p[:keep], prefix[:keep]
            total = total[:last]
        p = p + EXTRA[prefix]
        of_distance = look(DISTANCE, win[p])
        distance = _prefix_values(of_distance >> 4, win[p + (of_distance & 15)])
        value = symbols.astype(np.uint32)
        literal = np.flatnonzero(symbols < 256)
        argb = value[literal] << np.uint32(8) | np.uint32(shade)
        if not plain:
            p = found[literal] + (of_green[literal] & 15)
            for which, shift in ((RED, 16), (BLUE, 0), (ALPHA, 24)):
                if codes[which].width:
                    other = look(which, win[p])
                    p = p + (other & 15)
                    argb |= (other >> 4).astype(np.uint32) << np.uint32(shift)
        value[literal] = argb
        parts.append((symbols, value, done + total - length, done + total[copied] - length[copied], length[copied], distance))
        done += int(total[-1])
        at = 8 * base + int(after[found[-1]])
    if at > end:
        raise ValueError("the image data end too early")
    kind, value, begin, to, length, distance = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*parts, strict=True))
    if cache_bits:
        cached, literal = np.flatnonzero(kind >= 280), np.flatnonzero(kind < 256)
        keys = kind[cached] - 280
        of = (0x1E35A7BD * value[literal].astype(np.int64) & 0xFFFFFFFF) >> (32 - cache_bits)
        first = np.full(1 << cache_bits, len(kind))
        first[of[::-1]] = literal[::-1]
        colour = np.zeros(1 << cache_bits, np.uint32)
        colour[of] = value[literal]
        shared = np.zeros(1 << cache_bits, bool)
        shared[of[value[literal] != colour[of]]] = True
        if shared[keys].any() or (first[keys] > cached).any():
            return None
        value[cached] = colour[keys]
    out = np.empty(n, np.uint32)
    if not len(to):
        out[:] = value
    else:
        seen.add("copies")
        out[begin[(kind < 256) | (kind >= 280)]] = value[(kind < 256) | (kind >= 280)]
        near = np.array([max(1, x + y * width) for x, y in NEAR])
        distance = np.where(distance > 120, distance - 120, near[np.minimum(distance, 120) - 1])
        if (distance > to).any() or int(to[-1]) + int(length[-1]) > n:
            raise ValueError("a back-reference leaves the image")
        for p, size, d in zip(to.tolist(), length.tolist(), distance.tolist(), strict=True):
            if d >= size:
                out[p : p + size] = out[p - d : p - d + size]
            elif d == 1:
                out[p : p + size] = out[p - 1]
            else:
                out[p : p + size] = np.resize(out[p - d : p], size)
    if any(not c.flat for c in codes):
        seen.add("mixed")
    bits.at = at
    return out


def _read_columns(bits: Bits, codes: list[Code], n: int) -> np.ndarray:
    """Pixels whose four symbols have fixed widths."""
    total = sum(c.width for c in codes[:4])
    if bits.at + n * total > 8 * len(bits.data):
        raise ValueError("the image data end too early")
    first = bits.at >> 3
    raw = np.unpackbits(np.frombuffer(bits.data, np.uint8, -(-(bits.at + n * total) >> 3) - first, first), bitorder="little") if total else np.empty(0, np.uint8)
    matrix = raw[bits.at & 7 :][: n * total].reshape(n, total)
    bits.at += n * total
    out, column = np.zeros(n, np.int64), 0
    for which, shift in ((GREEN, 8), (RED, 16), (BLUE, 0), (ALPHA, 24)):
        code = codes[which]
        if not code.width:
            out |= int(code.symbols[0]) << shift
            continue
        value = np.packbits(matrix[:, column : column + code.width], axis=1).ravel() >> (8 - code.width)
        column += code.width
        out |= code.symbols[value] << shift
    return out.astype(np.uint32)


def _bytes(pixels: np.ndarray, *shape: int) -> np.ndarray:
    """A copy of the pixels as blue, green, red and alpha bytes."""
    return pixels.astype("<u4").view(np.uint8).reshape(*shape, 4)


def _numbers(channels: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(channels).view("<u4").ravel()


def _channels(pixels: np.ndarray) -> np.ndarray:
    """A, R, G, B as rows."""
    return np.stack([(pixels.astype(np.int64) >> s) & 255 for s in (24, 16, 8, 0)])


def _pack(channels: np.ndarray) -> np.ndarray:
    c = channels & 255
    return c[0] << 24 | c[1] << 16 | c[2] << 8 | c[3]


def predicted(mode: int, left, top, top_left, top_right) -> list[int]:
    """The prediction of a pixel from its neighbours (lists of four channel values)."""
    mean = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b, strict=True)]
    clamp = lambda x: 0 if x < 0 else 255 if x > 255 else x
    if mode in (1, 2, 3, 4):
        return (left, top, top_right, top_left)[mode - 1]
    if mode == 5:
        return mean(mean(left, top_right), top)
    if mode in (6, 7, 8, 9):
        return mean(*((left, top_left), (left, top), (top_left, top), (top, top_right))[mode - 6])
    if mode == 10:
        return mean(mean(left, top_left), mean(top, top_right))
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, top_left, strict=True))
        to_top = sum(abs(x - c) for x, c in zip(left, top_left, strict=True))
        return left if to_left < to_top else top
    if mode == 12:
        return [clamp(a + b - c) for a, b, c in zip(left, top, top_left, strict=True)]
    if mode == 13:
        return [clamp(m + int((m - c) / 2)) for m, c in zip(mean(left, top), top_left, strict=True)]
    return [255, 0, 0, 0]


def _unpredict_row(row: np.ndarray, above: np.ndarray, modes: list[int]) -> None:
    """One row below the first, pixel by pixel, in blue-green-red-alpha bytes."""
    p, top = row.tolist(), above.tolist()
    p[0] = [(a + b) & 255 for a, b in zip(p[0], top[0], strict=True)]
    top.append(p[0])  # the last pixel's upper right neighbour is the row's own first
    for x in range(1, len(p)):
        base = predicted(modes[x], p[x - 1], top[x], top[x - 1], top[x + 1]) if modes[x] % 14 else [0, 0, 0, 255]
        p[x] = [(a + b) & 255 for a, b in zip(p[x], base, strict=True)]
    row[:] = p


def unpredict(pixels: np.ndarray, modes: np.ndarray, block: int, width: int, height: int) -> np.ndarray:
    """Adds the predictions: bands of rows that follow the left or the upper pixel are sums, others go pixel by pixel."""
    p = _bytes(pixels, height, width)
    p[0, 0, 3] = (int(p[0, 0, 3]) + 255) & 255
    np.cumsum(p[0], axis=0, dtype=np.uint8, out=p[0])
    bands = modes.reshape(-(-height >> block), -1)
    for i, band in enumerate(bands):
        low, high = max(1, i << block), min(height, (i + 1) << block)
        if low >= high:
            continue
        mode = int(band[0]) if (band == band[0]).all() else -1
        if mode == 1:
            part = p[low - 1 : high]
            np.cumsum(part[:, 0], axis=0, dtype=np.uint8, out=part[:, 0])
            np.cumsum(part[1:], axis=1, dtype=np.uint8, out=part[1:])
        elif mode == 2:
            part = p[low - 1 : high]
            np.cumsum(part, axis=0, dtype=np.uint8, out=part)
        else:
            of_pixels = np.repeat(band, 1 << block)[:width].tolist()
            for y in range(low, high):
                _unpredict_row(p[y], p[y - 1], of_pixels)
    return _numbers(p)


def spread(values: np.ndarray, block: int, width: int, height: int) -> np.ndarray:
    """Values of blocks, one for each pixel."""
    across = np.repeat(values.reshape(-(-height >> block), -1), 1 << block, axis=1)[:, :width]
    return np.repeat(across, 1 << block, axis=0)[:height].ravel()


def colour_delta(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((t.view(np.int8).astype(np.int16) * c.view(np.int8)) >> 5).astype(np.uint8)


def uncross(pixels: np.ndarray, elements: np.ndarray) -> np.ndarray:
    p, e = _bytes(pixels, len(pixels)), _bytes(elements, len(elements))
    green = np.ascontiguousarray(p[:, 1])
    p[:, 2] += colour_delta(np.ascontiguousarray(e[:, 0]), green)
    p[:, 0] += colour_delta(np.ascontiguousarray(e[:, 1]), green)
    if e[:, 2].any():
        p[:, 0] += colour_delta(np.ascontiguousarray(e[:, 2]), np.ascontiguousarray(p[:, 2]))
    return _numbers(p)


def _bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def unindex(pixels: np.ndarray, colours: np.ndarray, width: int, height: int) -> np.ndarray:
    bundle = _bundle_bits(len(colours))
    packed = ((pixels >> 8) & 255).reshape(height, -1)
    full = np.zeros(256, np.uint32)
    full[: len(colours)] = colours
    if not bundle:
        return full[packed.ravel()]
    each = 8 >> bundle
    at = (packed[:, :, None] >> (np.arange(1 << bundle) * each)) & ((1 << each) - 1)
    return full[at.reshape(height, -1)[:, :width]].ravel()


def _read_vp8l(data: bytes, made_of: set[str]) -> tuple[int, int, np.ndarray]:
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless image")
    width, height, _, version = bits.read(14) + 1, bits.read(14) + 1, bits.read(1), bits.read(3)
    if version:
        raise ValueError("unknown version")
    transforms, now, seen = [], width, set()
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise ValueError("a transform is given twice")
        seen.add(kind)
        made_of.add(TRANSFORM_NAMES[kind])
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = bits.read(3) + 2
            transforms.append((kind, now, block, _read_image(bits, -(-now >> block), -(-height >> block), False)))
        elif kind == PALETTE:
            n = bits.read(8) + 1
            colours = _pack(np.cumsum(_channels(_read_image(bits, n, 1, False)), axis=1))
            transforms.append((kind, now, 0, colours))
            now = -(-now >> _bundle_bits(n))
        else:
            transforms.append((kind, now, 0, None))
    pixels = _read_image(bits, now, height, True, made_of)
    for kind, w, block, values in reversed(transforms):
        if kind == PREDICTOR:
            pixels = unpredict(pixels, (values >> 8) & 15, block, w, height)
        elif kind == CROSS_COLOUR:
            pixels = uncross(pixels, values if len(values) == 1 else spread(values, block, w, height))
        elif kind == SUBTRACT_GREEN:
            a, r, g, b = _channels(pixels)
            pixels = _pack(np.stack([a, r + g, g, b + g]))
        else:
            pixels = unindex(pixels, values, w, height)
    return width, height, pixels


def _images(data: bytes):
    at = 0
    while at < len(data):
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        riff = data[at : at + 8 + size]
        if riff[:4] != b"RIFF" or riff[8:16] != b"WEBPVP8L" or len(riff) != 8 + size:
            raise ValueError("not a lossless WebP")
        yield riff[20 : 20 + int.from_bytes(riff[16:20], "little")]
        at += 8 + size + (size & 1)


def _decode(data: bytes) -> tuple[int, int, np.ndarray, str]:
    made_of: set[str] = set()
    parts = [_read_vp8l(x, made_of) for x in _images(data)]
    if not parts or len({w for w, _, _ in parts}) != 1:
        raise ValueError("no image, or images of different widths")
    pixels = np.concatenate([p for *_, p in parts]) if len(parts) > 1 else parts[0][2]
    return parts[0][0], sum(h for _, h, _ in parts), pixels, "+".join(sorted(made_of))


def decode(data: bytes) -> tuple[int, int, np.ndarray]:
    """Width, height and flat ARGB pixels; images in a row, of one width, are stacked."""
    return _decode(data)[:3]


class Writer:
    """Collects bits as arrays of 0 and 1."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.held = self.n_held = 0

    def put(self, value: int, n: int) -> None:
        self.held |= value << self.n_held
        self.n_held += n

    def add(self, bits: np.ndarray) -> None:
        if self.n_held:
            self.parts.append(np.unpackbits(np.frombuffer(self.held.to_bytes((self.n_held + 7) // 8, "little"), np.uint8), bitorder="little")[: self.n_held])
            self.held = self.n_held = 0
        self.parts.append(bits)

    def fields(self, values: np.ndarray, width: int) -> None:
        """Codes of one width, their first bit first."""
        if values.dtype == np.uint8:
            self.add(np.unpackbits(values[:, None], axis=1)[:, 8 - width :].ravel())
        else:
            self.add(((values[:, None] >> np.arange(width - 1, -1, -1)) & 1).astype(np.uint8).ravel())

    def flat_code(self, symbols: int) -> int:
        """A code of one length for the symbols below ``symbols``, filled up to a power of two; the length."""
        width = max(1, (symbols - 1).bit_length())
        self.put(0, 1)
        at = LENGTH_ORDER.index(width)
        stored = max(4, at + 1)
        self.put(stored - 4, 4)
        for i in range(stored):
            self.put(int(i == at), 3)
        self.put(1, 1)
        self.put(3, 3)  # the number of symbols in 8 bits
        self.put((1 << width) - 2, 8)
        return width

    def one_symbol(self, symbol: int) -> None:
        self.put(0b101 if symbol > 1 else 0b001, 3)
        self.put(symbol, 8 if symbol > 1 else 1)

    def bits(self) -> np.ndarray:
        self.add(np.empty(0, np.uint8))
        return np.concatenate(self.parts)


@functools.lru_cache(4096)
def _palette_bits(values: bytes) -> np.ndarray:
    """The palette transform for grey values in ascending order."""
    grey = np.frombuffer(values, np.uint8).astype(np.int64)
    w = Writer()
    w.put(0b111, 3)  # a transform follows: palette
    w.put(len(grey) - 1, 8)
    w.put(0, 1)  # no colour cache
    steps = np.diff(grey, prepend=0)
    width = 0
    for _ in range(3):
        width = w.flat_code(int(steps.max()) + 1)
    w.put(0b0111, 3)  # alpha: two symbols, the first in 8 bits
    w.put(0, 8)
    w.put(255, 8)
    w.one_symbol(0)
    alpha = (np.arange(len(grey)) == 0).astype(np.int64)
    w.fields((((steps << width | steps) << width | steps) << 1) | alpha, 3 * width + 1)
    return w.bits()


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Lengths of a complete prefix code, at most 14: logarithms rounded up, then shortened, frequent symbols first, while room is left."""
    used = np.flatnonzero(counts)
    if len(used) < 2:
        return (counts > 0).astype(np.int64)
    n = np.maximum(counts[used], counts.sum() >> 13)
    lengths = np.ceil(np.log2(n.sum() / n) - 1e-9).astype(np.int64).clip(1)
    order = np.argsort(-n, kind="stable").tolist()
    own = lengths.tolist()
    room = (1 << 15) - sum(1 << (15 - x) for x in own)
    while room:
        for i in order:
            if own[i] > 1 and 1 << (15 - own[i]) <= room:
                room -= 1 << (15 - own[i])
                own[i] -= 1
    out = np.zeros(len(counts), np.int64)
    out[used] = own
    return out


def _canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol, its first bit lowest; 0 where a code has one symbol."""
    out = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    if len(used) > 1:
        order = used[np.argsort(lengths[used], kind="stable")]
        width = int(lengths.max())
        spans = (1 << width) >> lengths[order]
        out[order] = _reversed(width)[np.cumsum(spans) - spans]  # low bits of the reverse are the code, the rest is 0
    return out


_LENGTH_BITS = [(int(c), int(n)) for c, n in zip(_canonical(LENGTH_CODE), LENGTH_CODE, strict=True)]
_LENGTH_HEADER = sum(int(LENGTH_CODE[s]) << (5 + 3 * i) for i, s in enumerate(LENGTH_ORDER)) | 15 << 1


class _Header:
    """The bits before the symbols, as one number."""

    def __init__(self):
        self.value = self.n = 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n

    def one_symbol(self, symbol: int) -> None:
        """A code of this symbol alone, below 256."""
        self.put((symbol << 3 | 0b101) if symbol > 1 else symbol << 3 | 0b001, 11 if symbol > 1 else 4)

    def code(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Writes the prefix code for symbols so frequent; code and number of bits of every symbol."""
        used = np.flatnonzero(counts)
        if len(used) < 2 and (not len(used) or used[0] < 256):
            self.one_symbol(int(used[0]) if len(used) else 0)
            return np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.int64)
        lengths = code_lengths(counts)
        self.put(_LENGTH_HEADER, 5 + 3 * 19)
        self.put(0, 1)
        value = n = at = 0
        for symbol in used.tolist():
            while symbol > at:
                gap = symbol - at
                if gap < 3:
                    code, size, gap = *_LENGTH_BITS[0], 1
                elif gap <= 10:
                    code, size = _LENGTH_BITS[17]
                    code, size = code | (gap - 3) << size, size + 3
                else:
                    gap = min(gap, 138)
                    code, size = _LENGTH_BITS[18]
                    code, size = code | (gap - 11) << size, size + 7
                value, n, at = value | code << n, n + size, at + gap
            code, size = _LENGTH_BITS[lengths[symbol]]
            value, n, at = value | code << n, n + size, at + 1
        while at < len(counts):
            gap = min(len(counts) - at, 138)
            code, size = (*_LENGTH_BITS[0],) if gap < 11 else _LENGTH_BITS[18]
            if gap < 11:
                gap = 1
            else:
                code, size = code | (gap - 11) << size, size + 7
            value, n, at = value | code << n, n + size, at + gap
        self.put(value, n)
        if len(used) == 1:
            return np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.int64)
        return _canonical(lengths), lengths


def _prefixes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths or distances as prefix, number of bits after it, and these bits."""
    prefix = np.searchsorted(BASE, values, "right") - 1
    return prefix, EXTRA[prefix].astype(np.int64), values - BASE[prefix]


def _find_copies(pixels: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copies (position, length, distance) from the last start where the same 16 pixels follow."""
    n = len(pixels)
    starts = starts[starts <= n - LEAST_COPY]
    windows = np.lib.stride_tricks.sliding_window_view(pixels, LEAST_COPY)[starts].copy().view("<u8") if len(starts) else np.empty((0, 2), np.uint64)
    keys = windows[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ windows[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    to, source = starts[order[same + 1]], starts[order[same]]
    sorted_by = np.argsort(to)
    found, done = [], 0
    for p, q in zip(to[sorted_by].tolist(), source[sorted_by].tolist(), strict=True):
        if p < done or p - q > FARTHEST:
            continue
        differ = pixels[p : p + MOST_COPY] != pixels[q : q + min(MOST_COPY, n - p)]
        size = int(differ.argmax())
        if not differ[size]:
            size = len(differ)
        if size >= LEAST_COPY:
            found.append((p, size, p - q))
            done = p + size
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


@functools.lru_cache(64)
def _distance_codes(width: int) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, (x, y) in enumerate(NEAR):
        out.setdefault(max(1, x + y * width), i + 1)
    return out


def _join_bits(header: _Header, values: np.ndarray, sizes: np.ndarray) -> bytes:
    """The header and, one after another, values of up to 63 bits each."""
    ends = np.cumsum(sizes) + header.n
    total = int(ends[-1]) if len(ends) else header.n
    words = np.zeros((total >> 6) + 2, np.uint64)
    head = header.value.to_bytes(((header.n + 63) >> 6) * 8, "little")
    words[: len(head) // 8] = np.frombuffer(head, "<u8")
    if len(values):
        begin = ends - sizes
        word, shift = begin >> 6, (begin & 63).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] |= np.bitwise_or.reduceat(values << shift, first)
        over = (values >> np.uint64(1)) >> (np.uint64(63) - shift)
        spill = np.flatnonzero(over)
        words[word[spill] + 1] |= over[spill]
    return words.tobytes()[: (total + 7) >> 3]


def _write_pixels(header: _Header, green: np.ndarray, width: int, starts: np.ndarray, alpha: int, cache: bool) -> bytes:
    """The pixels: grey in full where a cache is used, else all but green is constant."""
    n = len(green)
    at, size, distance = _find_copies(green, starts)
    covered = np.zeros(n + 1, np.int8)
    covered[at] += 1
    covered[at + size] -= 1
    single = np.cumsum(covered[:n], dtype=np.int8) == 0
    token = single.copy()
    token[at] = True
    position = np.flatnonzero(token)
    symbols = green[position].astype(np.int64)
    copied = np.flatnonzero(~single[position])
    prefix, extra, rest = _prefixes(size)
    symbols[copied] = 256 + prefix
    near = _distance_codes(width)
    codes = np.array([near.get(d, d + 120) for d in distance.tolist()], np.int64)
    far, far_extra, far_rest = _prefixes(codes)
    literal = np.flatnonzero(single[position])
    cache_bits = 0
    if cache:
        grey = np.arange(256)
        cache_bits = 9
        keys = (0x1E35A7BD * (0xFF000000 | grey * 0x010101) & 0xFFFFFFFF) >> (32 - cache_bits)
        own, first = np.unique(symbols[literal], return_index=True)
        alone = np.zeros(256, bool)
        alone[own] = np.bincount(keys[own], minlength=1 << cache_bits)[keys[own]] == 1
        again = alone[symbols[literal]]
        again[first] = False
        hits = literal[again]
        literal = literal[~again]
        symbols[hits] = 280 + keys[symbols[hits]]
    header.put(int(cache_bits > 0), 1)
    if cache_bits:
        header.put(cache_bits, 4)
    header.put(0, 1)  # one group of codes
    value, n_bits = (x[symbols] for x in header.code(np.bincount(symbols, minlength=280 + (1 << cache_bits if cache_bits else 0))))
    if cache_bits:
        shades = symbols[literal]
        for _ in range(2):
            code, bits = header.code(np.bincount(shades, minlength=256))
            value[literal] |= code[shades] << n_bits[literal].astype(np.uint64)
            n_bits[literal] += bits[shades]
    else:
        header.one_symbol(0)
        header.one_symbol(0)
    header.one_symbol(alpha)
    code, bits = header.code(np.bincount(far, minlength=40))
    for more, width_of in ((rest, extra), (code[far], bits[far]), (far_rest, far_extra)):
        value[copied] |= more.astype(np.uint64) << n_bits[copied].astype(np.uint64)
        n_bits[copied] += width_of
    return _join_bits(header, value, n_bits)


def _put_small(header: _Header, greens: list[int], red: int, blue: int) -> None:
    """A small image of few greens, for the blocks of a transform."""
    header.put(0, 1)  # no colour cache
    if len(set(greens)) == 1:
        for symbol in (greens[0], red, blue, 255, 0):
            header.one_symbol(symbol)
        return
    g = np.array(greens, np.int64)
    code, bits = header.code(np.bincount(g, minlength=280))
    for other in (red, blue, 255, 0):
        header.one_symbol(other)
    for v in g.tolist():
        header.put(int(code[v]), int(bits[v]))


def _predict(rows: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Residuals and the mode of every band: 1 (left) or 2 (top), what leaves more zeros."""
    out = rows.copy()
    out[0, 1:] -= rows[0, :-1]
    out[1:, 0] -= rows[:-1, 0]
    modes = []
    for low in range(0, len(rows), 1 << BAND):
        begin, end = max(1, low), min(len(rows), low + (1 << BAND))
        left, top = rows[begin:end, 1:] - rows[begin:end, :-1], rows[begin:end, 1:] - rows[begin - 1 : end - 1, 1:]
        modes.append(2 if np.count_nonzero(top) < np.count_nonzero(left) else 1)
        out[begin:end, 1:] = top if modes[-1] == 2 else left
    return out, modes


def _encode_image(samples: np.ndarray, width: int) -> bytes:
    height = len(samples) // width
    values = np.flatnonzero(np.bincount(samples, minlength=256))
    header = _Header()
    header.put(0x2F, 8)
    header.put(width - 1, 14)
    header.put(height - 1, 14)
    header.put(0, 4)  # opaque, version 0
    alpha, cache = 255, False
    if len(values) <= 16:
        place = np.zeros(256, np.uint8)
        place[values] = np.arange(len(values))
        bundle = _bundle_bits(len(values))
        rows = place[samples].reshape(height, width)
        rows = np.pad(rows, ((0, 0), (0, -width % (1 << bundle)))).reshape(height, -1, 1 << bundle)
        now = rows.shape[1]
        green = (rows.astype(np.int64) << (np.arange(1 << bundle) * (8 >> bundle))).sum(axis=2).astype(np.uint8).ravel()
        palette = _palette_bits(values.astype(np.uint8).tobytes())
        header.put(int.from_bytes(np.packbits(palette, bitorder="little").tobytes(), "little"), len(palette))
        starts = np.arange(len(green))
    else:
        green, now = samples, width
        form = FORMS[zlib.crc32(samples) % len(FORMS)]
        begins = np.zeros(len(samples), bool)
        begins[1:] = samples[:-1] == 32
        begins[::64] = True
        starts = np.flatnonzero(begins)
        if form == "predictor":
            rows, modes = _predict(samples.reshape(height, width))
            green, alpha = rows.ravel(), 0
            header.put(1 | PREDICTOR << 1, 3)
            header.put(BAND - 2, 3)
            _put_small(header, [m for m in modes for _ in range(-(-width >> BAND))], 0, 0)
        if form != "cache":
            header.put(1 | CROSS_COLOUR << 1, 3)
            header.put(BAND - 2, 3)
            # green to red is the blue byte, green to blue the green byte; 32 stands for 1
            _put_small(header, [32] * (-(-width >> BAND) * -(-height >> BAND)), 0, 32)
        cache = form == "cache"
    header.put(0, 1)  # no more transforms
    data = _write_pixels(header, green, now, starts, alpha, cache)
    chunk = b"VP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) & 1)
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


def encode(samples: bytes, width: int = ROW) -> bytes:
    """Bytes (a positive multiple of ``width``) as grey lossless WebP; rows beyond the format's height go to further images."""
    if not samples or len(samples) % width:
        raise ValueError("samples must fill whole rows")
    step = width * MAX_SIDE
    grey = np.frombuffer(samples, np.uint8)
    return b"".join(_encode_image(grey[at : at + step], width) for at in range(0, len(grey), step))


def padded(data: bytes, row: int = ROW) -> bytes:
    return data + b" " * (max(1, math.ceil(len(data) / row)) * row - len(data))


def _with_columns(df: DataFrame, column: str, added: dict[str, pa.DataType], of_value) -> DataFrame:
    """``df`` with what ``of_value`` makes of each value of ``column``; added columns replace columns of their name."""
    at = df.columns.index(column)
    keep = [i for i, c in enumerate(df.columns) if c not in added]
    types = {pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}

    def run(batches):
        for batch in batches:
            made = [of_value(x.as_py()) for x in batch.column(at)]
            new = [pa.array([row[i] for row in made], t) for i, t in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *new], names=[*(batch.schema.names[i] for i in keep), *added])

    plain = df.select(*(df.columns[i] for i in keep))
    return df.mapInArrow(run, plain.select("*", *(F.lit(None).cast(types[t]).alias(c) for c, t in added.items())).schema)


def _rgba(data: bytes | None) -> tuple:
    if data is None:
        return None, None, None
    w, h, pixels = decode(data)
    return w, h, _bytes(pixels, len(pixels))[:, [2, 1, 0, 3]].tobytes()


def decode_column(df: DataFrame, media_col: str = "media") -> DataFrame:
    """``df`` with width, height and pixels (RGBA bytes) of a lossless WebP column."""
    return _with_columns(df, media_col, {"width": pa.int32(), "height": pa.int32(), "pixels": pa.binary()}, _rgba)


def store_bytes(df: DataFrame, data_col: str, row: int = ROW) -> DataFrame:
    """``df`` with ``media``: the bytes of ``data_col``, padded with spaces to whole rows, as WebP. Null bytes count as empty."""
    return _with_columns(df, data_col, {"media": pa.binary()}, lambda data: (encode(padded(data or b"", row), row),))


def _grey(data: bytes | None) -> tuple:
    if data is None:
        return None, None, None
    w, h, pixels, made_of = _decode(data)
    grey = pixels.astype(np.uint8)
    n = np.bincount(grey, minlength=256)
    mean = int((n * np.arange(256)).sum()) * 1000 // len(grey)
    flat = int((grey[1:] == grey[:-1]).sum()) * 1000 // len(grey)
    return grey.tobytes(), f"{w}x{h};values={np.count_nonzero(n)};mean={mean};flat={flat}", made_of


def load_bytes(df: DataFrame, media_col: str = "media") -> DataFrame:
    """``df`` with ``payload`` (the grey samples read back from the media), ``feature`` (size, mean and spread of the
    samples, share of equal neighbours) and ``made_of`` (transforms, cache, copies and codes that the decoder met)."""
    return _with_columns(df, media_col, {"payload": pa.binary(), "feature": pa.string(), "made_of": pa.string()}, _grey)


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each whole text as media, reads it back and gives sizes, digests and the feature."""
    data = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    stored = store_bytes(data, "data").select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"), "media")
    back = load_bytes(stored)
    return back.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "made_of",
    )
