"""Golomb-Rice coding of sorted integer sets with numpy (split unary and remainder streams)."""
from __future__ import annotations

import math

import numpy as np


def rice_parameter(span: int, n: int) -> int:
    """Remainder bits for ``n`` sorted values spread evenly over ``span``."""
    mean = max(1.0, span / max(1, n))
    return max(0, min(62, int(math.floor(math.log2(mean * math.log(2)) if mean * math.log(2) > 1 else 0))))


def encode(values: np.ndarray, span: int) -> tuple[int, bytes]:
    """Encode strictly or weakly ascending values in [0, span); returns (k, payload)."""
    n = len(values)
    k = rice_parameter(span, n)
    if not n:
        return k, b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    out = np.packbits(unary).tobytes()
    if k:
        rest = (gaps & np.uint64((1 << k) - 1)).astype(">u8").view(np.uint8).reshape(n, 8)
        bits = np.unpackbits(rest, axis=1)[:, 64 - k:]
        out += np.packbits(bits.reshape(-1)).tobytes()
    return k, out


def decode(payload: bytes, n: int, k: int) -> np.ndarray:
    """Inverse of :func:`encode` for ``n`` values."""
    if not n:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(payload, dtype=np.uint8)
    tail = (n * k + 7) // 8
    unary = np.unpackbits(raw[: len(raw) - tail])
    ends = np.flatnonzero(unary)[:n]
    quotient = np.diff(ends, prepend=-1) - 1
    gaps = quotient.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(raw[len(raw) - tail:])[: n * k].reshape(n, k)
        wide = np.zeros((n, 64), dtype=np.uint8)
        wide[:, 64 - k:] = bits
        gaps |= np.packbits(wide, axis=1).view(">u8").reshape(n).astype(np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)
