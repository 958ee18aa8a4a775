"""Seeded, partition-independent randomness from md5.

``u(key) = first 8 hex digits of md5(key) / 2^32``; the same value comes out of
Spark and DuckDB, so every seeded operator has a value-level SQL oracle.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def seeded_key(seed, key) -> Column:
    """md5 hex of ``<seed>:<key>`` -- an order key for seeded sampling."""
    seed_c = F.lit(str(seed)) if not isinstance(seed, Column) else seed.cast("string")
    key_c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(seed_c, F.lit(":"), key_c.cast("string")))


def hex8_int(hex_md5: Column) -> Column:
    return F.conv(F.substring(hex_md5, 1, 8), 16, 10).cast("bigint")


def unit_hash(*parts) -> Column:
    """Uniform value in [0, 1) from md5 of the parts joined with ':'.

    Parts are column names or Columns (use ``F.lit`` for constants).
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    key = F.concat_ws(":", *[c.cast("string") for c in cols])
    return hex8_int(F.md5(key)) / F.lit(4294967296.0)


_SINES = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))


def md5_tops(texts: pa.Array, prefix: str = "", block: int = 1 << 14) -> pa.Array:
    """First 8 hex digits of ``md5(prefix || text)`` as int64, null for null: many texts at once inside a task.

    A message below 56 bytes is one block, so the 64 steps are array operations over ``block`` of them; longer ones are hashed one by one.
    """
    texts = texts.cast(pa.large_binary())
    tops = [_tops(texts.slice(i, block), prefix.encode()) for i in range(0, len(texts), block)]
    top = np.concatenate(tops) if tops else np.zeros(0, np.int64)
    return pa.array(top, mask=texts.is_null().to_numpy(zero_copy_only=False)) if texts.null_count else pa.array(top)


def _tops(texts: pa.Array, head: bytes) -> np.ndarray:
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    size = np.diff(ends) + len(head)
    short = size < 56
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    width = np.arange(64, dtype=np.uint8)
    block = np.zeros((n, 64), np.uint8)
    block[:, :len(head)] = np.frombuffer(head, np.uint8)[:64]
    body = (width >= len(head)) & (width < np.where(short, size, 0).astype(np.uint8)[:, None])
    whole = data[ends[0]:ends[-1]]
    block[body] = whole if short.all() else whole[np.repeat(short, np.diff(ends))]
    at = np.flatnonzero(short)
    block[at, size[at]] = 0x80
    block[:, 56:] = (size.astype("<u8") * 8).view(np.uint8).reshape(n, 8)
    words = np.ascontiguousarray(block.view("<u4").T)
    a, b, c, d = (np.full(n, v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    f, low = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
            k = i
        elif i < 32:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
            k = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
            k = (3 * i + 5) % 16
        else:
            np.bitwise_not(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
            k = 7 * i % 16
        turn = _TURNS[i // 16][i % 4]
        f += a
        f += np.uint32(_SINES[i])
        f += words[k]
        np.right_shift(f, 32 - turn, out=low)
        np.left_shift(f, turn, out=f)
        f |= low
        f += b
        a, b, c, d, f = d, f, b, c, a
    top = (a + np.uint32(0x67452301)).byteswap().astype(np.int64)
    for i in np.flatnonzero(~short).tolist():
        top[i] = int.from_bytes(hashlib.md5(head + (texts[i].as_py() or b"")).digest()[:4], "big")
    return top
