"""Importance resampling of documents towards a target collection.

Features are all runs of 1 to ``WIDTH`` consecutive words, repeats counted, hashed to buckets by CRC-32. The gain of a
bucket is how much likelier it is in the target than in the documents; a document's weight is the mean gain of its
features, and the highest sums of weight and Gumbel noise are drawn, which samples without replacement in proportion
to the exponentials of the weights.

Inside a task the n-grams of a batch are interned in an open-addressed NumPy table: keys are xxHash64 values, places are
probed linearly, and equal keys count as equal only if their bytes are. A slot stores the bucket and the count, so CRC-32
is taken once per distinct n-gram; every occurrence remembers its slot, and scoring gathers gains by these slot numbers.
Only bucket totals leave the tasks: at most ``BUCKETS`` rows reach the driver, whatever the input.

Texts are cut into pieces of about ``PIECE`` bytes between words (a run that crosses a cut is counted with the second
piece), so that work arrays stay small for texts of any length.

Edge cases: null texts have no words, no features and weight 0, as have texts without words; an empty target or an empty
table gives gains from the added ones alone. A null ``doc_id`` draws its noise like an empty one and loses ties.
Repeated rows count and are ranked each.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.llm.texts import WORD_BYTE, Words, plain, small_batches
from newsweave.operators.numbering import numbered
from newsweave.session import cut

BUCKETS, WIDTH, SEED = 10_000, 2, 7
MIN_WORDS, PERCENT = 20, 25
PIECE = 1 << 19
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_SHORT = 32  # spans below this length are hashed together


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def lanes(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, little-endian; zeros follow the end."""
    padded = np.append(buffer, np.zeros(_SHORT, np.uint8))
    return np.ndarray((len(buffer) + _SHORT - 8,), "<u8", padded, strides=(1,)).copy()


def xxhash64(eights: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of spans below 32 bytes: whole eights, then a four, then single bytes, then the final mixing."""
    found = _P5 + sizes.astype(np.uint64)
    at = starts.copy()
    for i in range(3):
        go = np.flatnonzero(sizes >= 8 * (i + 1))
        lane = _rotated(eights[at[go]] * _P2, 31) * _P1
        found[go] = _rotated(found[go] ^ lane, 27) * _P1 + _P4
        at[go] += 8
    go = np.flatnonzero(sizes & 4)
    found[go] = _rotated(found[go] ^ (eights[at[go]] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
    at[go] += 4
    for i in range(3):
        go = np.flatnonzero((sizes & 3) > i)
        found[go] = _rotated(found[go] ^ (eights[at[go]] & np.uint64(0xFF)) * _P5, 11) * _P1
        at[go] += 1
    found = (found ^ (found >> np.uint64(33))) * _P2
    found = (found ^ (found >> np.uint64(29))) * _P3
    return found ^ (found >> np.uint64(32))


class Interned:
    """An open-addressed table of the distinct spans of a buffer.

    ``slot[i]`` is the place of span i in the table; ``used`` are the taken places, and per place ``bucket`` and ``count``.
    """

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray, buckets: int, keys: np.ndarray | None = None):
        """keys: hashes of the spans; xxHash64 if not given."""
        self.buffer, self.starts, self.sizes = buffer, starts, sizes
        self.eights = lanes(buffer)
        self.raw = buffer.tobytes()
        self.keys = self._hashes() if keys is None else keys
        room = 1 << max(4, int(2 * len(starts)).bit_length())
        self.owner = np.full(room, -1, np.int64)  # the span that took the place
        self.slot = (self.keys & np.uint64(room - 1)).astype(np.int64)
        left = np.arange(len(starts))
        while len(left):
            at = self.slot[left]
            free = self.owner[at] < 0
            self.owner[at[free]] = left[free]
            left = left[~self._same(left, self.owner[at])]
            self.slot[left] = (self.slot[left] + 1) & (room - 1)
        self.count = np.bincount(self.slot, minlength=room)
        self.used = np.flatnonzero(self.count)
        first = self.owner[self.used]
        ends = starts[first] + sizes[first]
        self.bucket = np.zeros(room, np.int64)
        self.bucket[self.used] = [zlib.crc32(self.raw[s:e]) % buckets for s, e in zip(starts[first].tolist(), ends.tolist(), strict=True)]

    def _hashes(self) -> np.ndarray:
        out = np.zeros(len(self.starts), np.uint64)
        short = self.sizes < _SHORT
        out[short] = xxhash64(self.eights, self.starts[short], self.sizes[short])
        for i in np.flatnonzero(~short):
            out[i] = xxhash.xxh64_intdigest(self.raw[self.starts[i] : self.starts[i] + self.sizes[i]])
        return out

    def _same(self, spans: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Whether the bytes of two lists of spans are the same, pair by pair."""
        same = (self.keys[spans] == self.keys[others]) & (self.sizes[spans] == self.sizes[others])
        check = np.flatnonzero(same & (spans != others))
        one, two, size = self.starts[spans[check]], self.starts[others[check]], self.sizes[spans[check]]
        equal, passed = np.ones(len(check), bool), 0
        go = np.flatnonzero((size > 0) & (size < _SHORT))
        while len(go):
            room = np.minimum(size[go] - passed, 8).astype(np.uint64)
            mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - room * np.uint64(8))
            equal[go] &= (self.eights[one[go] + passed] ^ self.eights[two[go] + passed]) & mask == 0
            passed += 8
            go = go[size[go] > passed]
        for i in np.flatnonzero(size >= _SHORT):
            equal[i] = self.raw[one[i] : one[i] + size[i]] == self.raw[two[i] : two[i] + size[i]]
        same[check] = equal
        return same


def pieces(raw: list[bytes], limit: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """Groups of (text, bytes, words carried over) of about ``limit`` bytes; long texts are cut in front of a word."""
    group, size = [], 0
    for i, text in enumerate(raw):
        if len(text) <= limit:
            parts = [(i, text, 0)]
        else:
            parts = _cut(i, text.lower(), limit)
        for part in parts:
            if group and size + len(part[1]) > limit:
                yield group
                group, size = [], 0
            group.append(part)
            size += len(part[1]) + 1
    if group:
        yield group


def _cut(number: int, text: bytes, limit: int) -> Iterator[tuple[int, bytes, int]]:
    """Pieces of a lower-cased text; each but the first begins with the last ``WIDTH - 1`` words before it, which are counted already."""
    inside, start, carried = WORD_BYTE[np.frombuffer(text, np.uint8)], 0, []
    while start < len(text):
        end = min(start + limit, len(text))
        after = np.flatnonzero(~inside[end : end + limit])  # the word at the cut stays whole
        while end < len(text) and not len(after):
            end = min(end + limit, len(text))
            after = np.flatnonzero(~inside[end : end + limit])
        end = min(end + int(after[0]) + 1, len(text)) if len(after) else len(text)
        yield number, b" ".join([*carried, text[start:end]]), len(carried)
        carried = _last_words([*carried, text[start:end]])
        start = end


def _last_words(parts: list[bytes]) -> list[bytes]:
    words = Words([b" ".join(parts)], WORD_BYTE)
    last = range(max(len(words.starts) - (WIDTH - 1), 0), len(words.starts))
    return [words.buffer[words.starts[i] : words.ends[i]].tobytes() for i in last]


def features(group: list[tuple[int, bytes, int]], buckets: int = BUCKETS) -> tuple[Interned, np.ndarray, np.ndarray]:
    """The interned n-grams of some pieces, the number of the piece of each occurrence, and the words of each piece."""
    words = Words([text for _, text, _ in group], WORD_BYTE)
    carried = np.array([c for _, _, c in group], np.int64)
    sizes = words.ends - words.starts
    # all words again, one space behind each: every run of words of a piece is a span here
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
    own = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    joined[own] = words.buffer[np.repeat(words.starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    starts, lengths, places = [], [], []
    within = np.arange(len(sizes)) - words.first[words.text]
    for width in range(1, WIDTH + 1):
        last = np.arange(width - 1, len(sizes))
        first = last - (width - 1)
        # runs inside a piece that end behind the words carried over
        keep = (words.text[first] == words.text[last]) & (within[last] >= carried[words.text[last]])
        first, last = first[keep], last[keep]
        starts.append(begins[first])
        lengths.append(begins[last] + sizes[last] - begins[first])
        places.append(words.text[last])
    table = Interned(joined, np.concatenate(starts), np.concatenate(lengths), buckets)
    return table, np.concatenate(places), np.diff(words.first) - carried


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for group in pieces(plain(batch["text"]), PIECE):
                table, _, _ = features(group, buckets)
                total += np.bincount(table.bucket[table.used], table.count[table.used], buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    found = texts.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in found.collect():  # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of add-one shares, per bucket, floored."""
    buckets = len(documents)
    s_all, t_all = float(documents.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(documents.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(text: Column, gain: np.ndarray) -> Column:
    """Struct (n_words, n_features, weight) of a text; the weight is the floored mean gain of its features."""
    sent = gain  # one number per bucket, travels with the function

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        n_words, n_features, summed = (np.zeros(len(texts), np.int64) for _ in range(3))
        for group in pieces(plain(texts), PIECE):
            table, place, words = features(group, len(sent))
            each = sent[table.bucket][table.slot]
            number = np.array([i for i, _, _ in group])
            np.add.at(n_words, number, words)
            np.add.at(n_features, number, np.bincount(place, minlength=len(group)))
            np.add.at(summed, number, np.bincount(place, each, len(group)).astype(np.int64))
        return pd.DataFrame({"n_words": n_words, "n_features": n_features, "weight": summed // np.maximum(n_features, 1)})

    return weigh(text)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw from the SHA-256 of ``seed:doc_id``, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def score(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    small_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    found = docs.select("doc_id", weighed(F.col("text"), gain).alias("found"))
    return found.select("doc_id", "found.*", (F.col("found.weight") + noise(F.col("doc_id"), seed)).alias("score"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``score`` with ``rank``, counting from 1 over the drawn: ``percent`` of the documents of at least ``min_words`` words.

    Scores are whole numbers, so counts per score give the lowest score that is drawn; only documents from there on are
    dealt to ranges of the order and numbered.
    """
    rows = cut(score(docs, target, buckets, seed).withColumn("row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= min_words
    drawn = rows.where(able).count() * percent // 100
    # one row per score: gains and noise are logarithms of ratios of counts below 2**63, so there are below 300,000
    kinds = sorted(((r["score"], r["n"]) for r in rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, room = None, drawn
    for value, n in kinds:
        if room <= 0:
            break
        least, room = value, room - n
    chosen = able & (F.col("score") >= least) if least is not None else F.lit(False)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = numbered(rows.where(chosen), "rank", *order, start=1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(rows.where(~chosen).withColumn("rank", F.lit(None).cast("long"))).drop("row")
