"""A small reader of content-addressed archives and their block encoding."""

from __future__ import annotations

import base64
import json
import struct


class Link(str):
    """The id of a block in hex."""


def varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 127) << shift
        if b < 128:
            return out, at
        shift += 7


def _item(data: bytes, at: int):
    major, info = data[at] >> 5, data[at] & 31
    at += 1
    n = info
    if 24 <= info <= 27:
        width = 1 << (info - 24)
        if major == 7 and info > 24:
            return struct.unpack({2: ">e", 4: ">f", 8: ">d"}[width], data[at : at + width])[0], at + width
        n = int.from_bytes(data[at : at + width], "big")
        at += width
    elif info > 27:
        raise ValueError("indefinite lengths are not allowed")
    if major == 3 or major == 2:
        end = at + n
        raw = data[at:end]
        if len(raw) != n:
            raise ValueError("the block ends too early")
        return raw if major == 2 else raw.decode(), end
    if major == 5:
        pairs = {}
        for _ in range(n):
            k, at = _item(data, at)
            pairs[k], at = _item(data, at)
        return pairs, at
    if major == 6:
        x, at = _item(data, at)
        return (Link(x[1:].hex()) if n == 42 else x), at  # 42: a link, with a zero byte before the id
    if major == 0:
        return n, at
    if major == 1:
        return -1 - n, at
    if major == 4:
        items = []
        for _ in range(n):
            x, at = _item(data, at)
            items.append(x)
        return items, at
    return {20: False, 21: True, 22: None}[info], at


def cbor(data: bytes):
    """The value of a block; byte strings are bytes."""
    out, end = _item(data, 0)
    if end != len(data):
        raise ValueError("bytes after the value")
    return out


def cid_length(data: bytes, at: int) -> int:
    end = at
    for _ in range(3):  # version, codec, hash function
        _, end = varint(data, end)
    n, end = varint(data, end)
    return end + n - at


def blocks(data: bytes):
    """(cid in hex, block, whether it is the first root) of an archive. The meaning of later roots is not defined; without one it is an error."""
    n, at = varint(data, 0)
    header = cbor(data[at : at + n])
    if not header["roots"]:
        raise ValueError("the archive has no roots")
    root = header["roots"][0]
    at += n
    while at < len(data):
        n, at = varint(data, at)
        if at + n > len(data):
            raise ValueError("the archive ends within a block")
        width = cid_length(data, at)
        cid = data[at : at + width].hex()
        yield cid, data[at + width : at + n], cid == root
        at += n


def text_cid(hex_cid: str) -> str:
    """The usual text of an id: base 32 in lower case after a b."""
    return "b" + base64.b32encode(bytes.fromhex(hex_cid)).decode().lower().rstrip("=")


def frame(data: bytes):
    """Header and body of a stream frame: two values, one after the other."""
    header, at = _item(data, 0)
    if not isinstance(header, dict) or "op" not in header:
        raise ValueError("the frame has no header")
    return header, cbor(data[at:])


def slices(batches, rows: int):
    """Arrow batches in pieces, so that few rows at a time are Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _plain(x):
    kind = type(x)
    if kind is str or kind is int:
        return x
    if kind is dict:
        return {k: _plain(v) for k, v in x.items()}
    if kind is Link:
        return {"/": text_cid(x)}
    if kind is bytes:
        return {"/": {"bytes": base64.b64encode(x).decode().rstrip("=")}}
    return [_plain(v) for v in x] if kind is list else x


_JSON = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode


def dag_json(x) -> str:
    """JSON text of a value, with links as ``{"/": id}`` and bytes as ``{"/": {"bytes": base 64 without padding}}``."""
    return _JSON(_plain(x))
