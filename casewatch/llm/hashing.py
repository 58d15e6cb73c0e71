"""64-bit hashes in numpy, and a bounded bit filter over a table of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 8 MB. A filter of more hashes than fit lets more through, never fewer.
MAX_FILTER_BITS = 1 << 26
ODD = 0x9E3779B97F4A7C15


def u64(x: int) -> np.uint64:
    return np.uint64(x & ((1 << 64) - 1))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (MurmurHash3's finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _places(bits: int) -> tuple[int, int]:
    return bits - 1, bits.bit_length() - 1


def filter_of(hashes: DataFrame, col: str, max_bits: int = MAX_FILTER_BITS) -> np.ndarray:
    """Bit array with two bits a hash (16 or more a hash in all, up to
    ``max_bits``). A word of 64 bits comes up once, so at most max_bits / 64
    rows of 16 bytes reach the driver, as Arrow."""
    n = hashes.count()
    bits = min(max_bits, max(1 << 16, 1 << (16 * n).bit_length()))
    mask, width = _places(bits)
    at = F.explode(F.array(F.col(col).bitwiseAND(mask), F.shiftrightunsigned(col, width).bitwiseAND(mask)))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("held")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["held"].to_numpy()
    return out.view(np.uint64)


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True for every hash of the filter, and for few others."""
    mask, width = _places(len(words) * 64)
    out = np.ones(len(hashes), bool)
    for at in (hashes & np.uint64(mask), (hashes >> np.uint64(width)) & np.uint64(mask)):
        out &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out
