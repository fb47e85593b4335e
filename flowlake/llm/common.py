"""Helpers shared by the operators: text rules, written tables, hashing of words in NumPy."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlake.session import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = b" \t\n\x0b\x0c\r"
SPACE_WORD = r"[^\x20\x09-\x0D]+"

_LOWER_BYTES = bytes(range(256)).translate(bytes.maketrans(UPPER.encode(), UPPER.lower().encode()))
# Odd multipliers of the polynomial word hash and their inverses modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 20


def reach_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session import this package from where the driver has it.

    On a cluster the package is installed or sent along (``--py-files``) as for any Spark job.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    return spark


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def space_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; NULL counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)).cast("long"), F.lit(0))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends, a lost executor costs one re-read."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def power_of_two(n: float) -> int:
    """Exponent of the smallest power of two that is at least ``n``."""
    return max(0, int(np.ceil(np.log2(max(1.0, n)))))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(factor)
        h ^= h >> np.uint64(33)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 1 << 12), _powers(_BASE_INVERSE, 1 << 12)


def _up(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if n > len(_UP):
        size = 1 << power_of_two(n)
        _UP, _DOWN = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _UP[:n], _DOWN[:n]


def _slice_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.empty(0, np.uint64)
    return poly_windows(raw, begin, end)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words ``[^\\x20\\x09-\\x0D]+`` in order, A-Z lower-cased."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER_BYTES)
    if len(data) <= _SLICE:
        return _slice_hashes(data)
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + _SLICE)
        while end < len(data) and data[end] not in SPACES:
            end += 1
        out.append(_slice_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the polynomial hash before each place, what brings a window at a place to the same power)."""
    up, down = _up(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return total, down


def poly_windows(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs ``values[begin:end]``."""
    total, down = prefix_sums(values)
    with np.errstate(over="ignore"):
        return mix64((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def sequence_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all windows of ``n`` words; fewer words make one window, none make no window."""
    if not len(words):
        return words
    n = min(n, len(words))
    m = len(words) - n + 1
    h = np.full(m, n * 0x9E3779B97F4A7C15 + seed & 0xFFFFFFFFFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + m])
    return h
