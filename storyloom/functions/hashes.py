"""64-bit hashes of byte strings: Murmur3 and the head of SHA-256, many strings at once."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

SEED = 42
_C1, _C2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _settle(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def murmur3_low(data: list[bytes], seed: int = SEED) -> np.ndarray:
    """The low half of the public 128-bit Murmur3 for 64-bit machines, signed; strings of one length in blocks go together."""
    out = np.zeros(len(data), np.uint64)
    by_blocks: dict[int, list[int]] = {}
    for k, d in enumerate(data):
        by_blocks.setdefault(len(d) // 16, []).append(k)
    for blocks, at in by_blocks.items():
        words = np.frombuffer(b"".join(data[k].ljust(16 * (blocks + 1), b"\0") for k in at), "<u8").reshape(len(at), -1).astype(np.uint64)
        h1, h2 = (np.full(len(at), seed, np.uint64) for _ in range(2))
        for b in range(blocks + 1):
            k1, k2 = _turn(words[:, 2 * b] * _C1, 31) * _C2, _turn(words[:, 2 * b + 1] * _C2, 33) * _C1
            if b == blocks:  # the tail, padded with zeros
                h1, h2 = h1 ^ k1, h2 ^ k2
                break
            h1 = (_turn(h1 ^ k1, 27) + h2) * np.uint64(5) + np.uint64(0x52DCE729)
            h2 = (_turn(h2 ^ k2, 31) + h1) * np.uint64(5) + np.uint64(0x38495AB5)
        size = np.array([len(data[k]) for k in at], np.uint64)
        h1, h2 = h1 ^ size, h2 ^ size
        h1 = h1 + h2
        h2 = h2 + h1
        out[at] = _settle(h1) + _settle(h2)
    return out.view(np.int64)


def sha_heads(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.sha256(d).digest()[:8] for d in data), ">u8").astype(np.uint64)


@F.pandas_udf(LongType())
def murmur64(text: pd.Series) -> pd.Series:
    return pd.Series(murmur3_low([(t or "").encode() for t in text]))
