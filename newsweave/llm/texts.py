"""Vectorised helpers over batches of texts: words, 64-bit hashes, bounded slabs.

Used inside pandas functions only. A text is handled as UTF-8 bytes; a null counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

#: Words are runs of bytes outside space, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of digits, lower-case letters and bytes of non-ASCII characters.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SLAB = 1 << 19  # bytes handled at once, so that work arrays stay small whatever the batch holds
_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.default_rng(20240611).integers(1, 1 << 63, 256, np.uint64)
_powers: dict[str, np.ndarray] = {}


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows that a Python worker gets at once; long texts make large rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def plain(texts) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


def objects(values) -> pd.Series:
    """A column of Python objects; an empty plain list would become numbers."""
    return pd.Series(list(values), dtype=object)


def slabs(raw: list[bytes], limit: int = SLAB) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` bytes together; a longer text has a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(raw):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(raw):
        yield start, len(raw)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))  # a copy, which the rest changes in place
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash base modulo 2**64 and their inverses, ``n`` of each."""
    if len(_powers.get("up", ())) < max(n, 1):
        size = max(n, SLAB + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hashes(symbols: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Running hash, one longer than ``symbols``; ``span_hash`` reads the hash of any span from it."""
    up, _ = powers(len(symbols))
    out = np.zeros(len(symbols) + 1, np.uint64)
    if values is None:
        values = _VALUES.take(symbols)
        values *= up
    else:
        values = values * up
    np.cumsum(values, out=out[1:])
    return out


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal spans; spans of different length are told apart by their length."""
    _, down = powers(len(running))
    return mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def joined_hash(running: np.ndarray, start: np.ndarray, cut: np.ndarray, again: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``span_hash`` of the span from ``start`` to ``end`` without what stands from ``cut`` to ``again``."""
    _, down = powers(len(running))
    raw = (running[cut] - running[start]) * down[start] + (running[end] - running[again]) * down[start + (again - cut)]
    return mix(raw + (end - start - (again - cut)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The lower-cased (A-Z only) words of several texts, in order, with 64-bit hashes.

    ``starts``/``ends`` are places in ``buffer``; ``first[i]:first[i + 1]`` are the words of text ``i``.
    """

    def __init__(self, raw: list[bytes], inside: np.ndarray):
        self.count = len(raw)
        self.buffer = np.frombuffer(b"\n".join(raw).lower() + b"\n", np.uint8)
        self.text_ends = np.cumsum([len(t) + 1 for t in raw])
        edges = np.flatnonzero(np.diff(inside[self.buffer], prepend=False))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.concatenate([[0], np.searchsorted(self.starts, self.text_ends)])
        self.text = np.repeat(np.arange(self.count), np.diff(self.first))
        self.hashes = span_hash(prefix_hashes(self.buffer), self.starts, self.ends)

    def string(self, i: int) -> str:
        return self.buffer[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")


def ngram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring words; runs that cross texts are the caller's to leave out."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = mix(hashes[:n])
    for j in range(1, width):
        found = mix(found * np.uint64(0x9FB21C651E98DF25) + hashes[j : j + n])
    return found
