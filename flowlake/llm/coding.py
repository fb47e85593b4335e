"""Golomb coding (Rice form: a power-of-two divisor) of sorted integers, in whole NumPy arrays."""

from __future__ import annotations

import numpy as np


def _as_bits(values: np.ndarray, width: int) -> np.ndarray:
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint64)
    return ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()


def encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """(width of the remainders, unary quotients, remainders) of ascending uint64 values.

    The divisor is the power of two at or below the mean gap, so the quotients take at most
    about two bits a value.
    """
    if not len(values):
        return 0, b"", b""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(0, int(np.log2(max(1.0, float(values[-1]) / len(values)))))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = _as_bits(gaps & np.uint64((1 << width) - 1), width)
    return width, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def decode(n: int, width: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The ``n`` values that ``encode`` took."""
    if not n:
        return np.empty(0, np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * width).reshape(n, width)
        shifts = np.arange(width - 1, -1, -1, dtype=np.uint64)
        gaps += (bits.astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)
