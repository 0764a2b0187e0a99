"""Removal of long repeated byte strings with a logarithmic family of sparse suffix arrays.

A string of ``LENGTH`` bytes that repeats is found through one sampled suffix: among the ``GRAM``-byte strings in it
the one with the least hash (the leftmost of equals) is its anchor, so equal strings have equal anchors in equal
places. A suffix array holds only suffixes that start at an anchor, about one byte in fifty, in the order of the
fingerprint of their first ``GRAM`` bytes (an order in which equal beginnings stand together, which is all that a
search for repeats needs) with the number of places.

Documents arrive in batches (by a hash of the row). Each batch gets a suffix array; whenever two arrays of one rank
exist they are merged into one of the next rank, like the digits of a binary counter, so that an entry is rewritten
only as often as the logarithm of the number of batches. Merging scans both in step and adds up the places of equal
beginnings; arrays left at different ranks are scanned against each other when matches are asked for.

Matches are then made exact. The windows whose anchor is a given place form one stretch. Equal stretches repeat as a
whole; stretches that share the beginning but differ elsewhere, the edges of passages, are compared window by window.
Their windows are counted by (beginning, hash), whatever the number of stretches. Stretches carry at least 128 bits of
hash (beginning and stretch, or beginning and window).

Edge cases: null and empty texts, and texts shorter than a window, keep all bytes; a row that stands twice in the
table repeats itself; ``doc_id`` may be null or repeated, rows are told apart by doc_id and text. Texts of any length are
handled whole, in slices that overlap by a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave.llm.bitmaps import bitmap, holds
from newsweave.llm.texts import mix, objects, plain, powers, prefix_hashes, slabs, small_batches, span_hash
from newsweave.session import cut, discarding, work_path

LENGTH, GRAM = 200, 100
BATCHES = 4
_PLACE_BITS = np.uint64(22)
_SLICE = 1 << 18  # windows of one text handled at once
_SLAB = 1 << 16  # bytes of short texts handled at once, so that work arrays stay in the cache of a core
_TOGETHER = 8  # slabs whose results are sent together
GROUP = 5000  # neighbouring places of a text whose windows are put together at once
_STRETCH = "beginning bigint, stretch bigint, row_key bigint, first bigint, n_windows int"


class Stretches:
    """The stretches of a slab: arrays over stretches, and the running hash for windows in them."""

    def __init__(self, raw: list[bytes], length: int, gram: int):
        self.length = length
        buffer = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(t) for t in raw])
        empty = np.zeros(0, np.int64)
        self.first = self.windows = self.anchor = self.text = self.offset = empty
        self.beginning = self.stretch = np.zeros(0, np.uint64)
        if len(buffer) < length:
            return
        self.running = prefix_hashes(buffer)
        grams = len(buffer) - gram + 1
        _, down = powers(len(self.running))
        # hashes that only rank the beginnings; those of anchors are mixed below
        raw_hashes = self.running[gram:] - self.running[:-gram]
        raw_hashes *= down[:grams]
        low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
        least = raw_hashes & ~low
        least |= np.arange(grams, dtype=np.uint64)
        width, size = length - gram + 1, 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[: size - width], least[width - size :])
        # a stretch begins where the anchor changes, and at the first window of a text; it ends with the last one
        sizes = np.array([len(t) for t in raw])
        begin = (ends - sizes)[sizes >= length]
        after = ends[sizes >= length] - (length - 1)
        edge = np.zeros(len(least) + 1, bool)
        np.not_equal(least[1:], least[:-1], out=edge[1:-1])
        edge[begin] = edge[after] = True
        edge = np.flatnonzero(edge)
        text = np.searchsorted(ends, edge, side="right")
        inside = np.flatnonzero(edge + length <= np.append(ends, 0)[text])
        if not len(inside):
            return
        self.first, self.text = edge[inside], text[inside]
        self.windows = edge[inside + 1] - self.first
        self.anchor = (least[self.first] & low).astype(np.int64)
        self.offset = self.first - (ends - sizes)[self.text]  # place in the text
        self.beginning = mix(raw_hashes[self.anchor])
        ahead = (self.anchor - self.first).astype(np.uint64)
        self.stretch = mix(span_hash(self.running, self.first, self.first + (self.windows + (length - 1))) ^ mix(ahead))

    def window_hashes(self, chosen: np.ndarray) -> list[bytes]:
        """Hashes of the windows of each chosen stretch, each with its distance from the anchor."""
        sizes = self.windows[chosen]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        start = np.arange(bounds[-1]) + np.repeat(self.first[chosen] - bounds[:-1], sizes)
        ahead = (np.repeat(self.anchor[chosen], sizes) - start).astype(np.uint64)
        hashes = mix(span_hash(self.running, start, start + self.length) ^ mix(ahead + np.uint64(7))).tobytes() if len(chosen) else b""
        return [hashes[8 * a : 8 * b] for a, b in pairwise(bounds.tolist())]


def _slices(raw: list[bytes], length: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, long ones in overlapping slices, with the text and place of each."""
    parts, owner, place = [], [], []
    for i, text in enumerate(raw):
        for start in range(0, max(1, len(text) - length + 1), _SLICE):
            parts.append(text[start : start + _SLICE + length - 1] if len(text) > _SLICE else text)
            owner.append(i)
            place.append(start)
    return parts, np.array(owner, np.int64), np.array(place, np.int64)


def _scan(raw: list[bytes], length: int, gram: int) -> Iterator[tuple[Stretches, np.ndarray, np.ndarray]]:
    """The stretches of all texts, with the number of the text and the place in it of each."""
    parts, owner, place = _slices(raw, length)
    for lo, hi in slabs(parts, _SLAB):
        found = Stretches(parts[lo:hi], length, gram)
        yield found, owner[lo + found.text], place[lo + found.text] + found.offset


def _together(parts: Iterable[dict[str, np.ndarray | pd.Series]]) -> Iterator[pd.DataFrame]:
    """The results of several slabs in one frame; many small ones cost more to send than to make."""
    held: list[dict] = []
    for part in parts:
        held.append(part)
        if len(held) == _TOGETHER:
            yield pd.DataFrame({name: np.concatenate([h[name] for h in held]) for name in part})
            held = []
    if held:
        yield pd.DataFrame({name: np.concatenate([h[name] for h in held]) for name in held[0]})


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "text")


class SuffixIndex:
    """Ranked suffix arrays, each a table (beginning, n) in the shared folder."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM):
        self.spark, self.length, self.gram = spark, length, gram
        self.levels: dict[int, DataFrame] = {}

    def add(self, docs: DataFrame, batches: int = 1) -> None:
        """Index the documents in so many batches; one scan makes the arrays of all of them."""
        length, gram = self.length, self.gram
        small_batches(self.spark)

        def beginnings(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
            for frame in frames:
                batch = frame["batch"].to_numpy()
                for found, text, _ in _scan(plain(frame["text"]), length, gram):
                    yield {"batch": batch[text], "beginning": found.beginning.view(np.int64)}

        def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            return _together(beginnings(frames))

        rows = rows_of(docs).select(F.pmod("row_key", F.lit(batches)).cast("int").alias("batch"), "text")
        arrays = rows.mapInPandas(read, "batch int, beginning bigint").groupBy("batch", "beginning").agg(F.count(F.lit(1)).alias("n"))
        path = work_path(self.spark, "suffixes")
        arrays.sortWithinPartitions("batch", "beginning").write.partitionBy("batch").parquet(path)
        table = self.spark.read.schema("beginning bigint, n bigint, batch int").parquet(path)
        for batch in range(batches):
            self._insert(table.where(F.col("batch") == batch).select("beginning", "n"))

    def _insert(self, array: DataFrame) -> None:
        rank = 0
        while rank in self.levels:
            both = array.unionByName(self.levels.pop(rank)).groupBy("beginning").agg(F.sum("n").alias("n"))
            array = cut(both.sortWithinPartitions("beginning"))
            rank += 1
        self.levels[rank] = array

    def repeated(self) -> DataFrame:
        """Beginnings with two places or more: within an array, or by a scan of arrays against each other."""
        ranks = sorted(self.levels)
        if not ranks:
            return self.spark.createDataFrame([], "beginning bigint")
        found = [self.levels[r].where("n > 1").select("beginning") for r in ranks]
        found += [self.levels[a].join(self.levels[b], "beginning", "left_semi").select("beginning") for i, a in enumerate(ranks) for b in ranks[i + 1 :]]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return cut(out if len(found) == 1 else out.distinct())


def _stretch_table(docs: DataFrame, wanted: Broadcast, length: int, gram: int) -> DataFrame:
    """Stretches whose beginning may repeat."""

    def stretches(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for frame in frames:
            key = frame["row_key"].to_numpy()
            for found, text, place in _scan(plain(frame["text"]), length, gram):
                hit = np.flatnonzero(holds(wanted.value, found.beginning))
                yield {
                    "beginning": found.beginning[hit].view(np.int64), "stretch": found.stretch[hit].view(np.int64), "row_key": key[text[hit]],
                    "first": place[hit], "n_windows": found.windows[hit],
                }

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(stretches(frames))

    return rows_of(docs).mapInPandas(read, _STRETCH)


def _window_table(docs: DataFrame, wanted: Broadcast, length: int, gram: int) -> DataFrame:
    """Stretches with the hashes of all their windows, for the places that may be asked for."""

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for frame in frames:
            key = frame["row_key"].to_numpy()
            for found, text, place in _scan(plain(frame["text"]), length, gram):
                stretch = found.stretch.view(np.int64)
                hit = np.flatnonzero(holds(wanted.value, (stretch ^ key[text] ^ place).view(np.uint64)))
                yield {"stretch": stretch[hit], "row_key": key[text[hit]], "first": place[hit], "windows": objects(found.window_hashes(hit))}

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(windows(frames))

    return rows_of(docs).mapInPandas(read, "stretch bigint, row_key bigint, first bigint, windows binary")


def _edge_spans(docs: DataFrame, kinds: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans covered by repeated windows in stretches that do not repeat as a whole.

    Windows are counted by a partially aggregated sum, and only those of single stretches that may repeat meet the
    counts again, so a window that all stretches of a beginning share is never gathered.
    """
    mixed = kinds.groupBy("beginning").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
    asked = cut(kinds.join(mixed.select("beginning"), "beginning", "left_semi"))
    rows = asked.select("beginning", "stretch", "n", F.col("at.row_key").alias("row_key"), F.col("at.first").alias("first"))
    place = F.col("stretch").bitwiseXOR(F.col("row_key")).bitwiseXOR(F.col("first"))
    windows = _window_table(docs, bitmap(rows.select(place.alias("place")), "place"), length, gram)
    rows = cut(windows.join(rows, ["stretch", "row_key", "first"]).select("beginning", "n", "row_key", "first", "windows"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            beginning, window, _ = _exploded(frame)
            yield pd.DataFrame({"beginning": beginning, "window": window})

    counts = rows.select("beginning", "windows").mapInPandas(count, "beginning bigint, window bigint")
    again = counts.groupBy("beginning", "window").agg(F.count(F.lit(1)).alias("places")).where("places > 1").select("beginning", "window")
    again = cut(again)
    both = F.col("beginning").bitwiseXOR(F.col("window"))
    wanted = bitmap(again.select(both.alias("both")), "both")

    def single(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            beginning, window, at = _exploded(frame)
            hit = np.flatnonzero(holds(wanted.value, (beginning ^ window).view(np.uint64)))
            yield pd.DataFrame({"beginning": beginning[hit], "window": window[hit], "row_key": frame["row_key"].to_numpy()[at[0][hit]], "start": at[1][hit]})

    alone = rows.where("n = 1").select("beginning", "row_key", "first", "windows")
    alone = alone.mapInPandas(single, "beginning bigint, window bigint, row_key bigint, start bigint")
    hits = alone.join(again, ["beginning", "window"], "left_semi")
    # runs of neighbouring windows are put together in bounded stretches of a text
    hits = hits.groupBy("row_key", F.floor(F.col("start") / GROUP).alias("part")).agg(F.collect_set("start").alias("starts"))

    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, firsts, ends = [], [], []
            for key, found in zip(frame["row_key"], frame["starts"], strict=True):
                found = np.sort(np.asarray(found, np.int64))
                fresh = np.flatnonzero(np.diff(found, prepend=found[0] - 2) != 1)
                keys.append(np.full(len(fresh), key, np.int64))
                firsts.append(found[fresh])
                ends.append(found[np.append(fresh[1:], len(found)) - 1] + length)
            if keys:
                yield pd.DataFrame({"row_key": np.concatenate(keys), "first": np.concatenate(firsts), "end": np.concatenate(ends)})

    return hits.select("row_key", "starts").mapInPandas(runs, "row_key bigint, first bigint, end bigint")


def _exploded(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Beginning and hash of all windows of the stretches, with the row and (where rows have ``first``) the place of each."""
    sizes = np.array([len(w) // 8 for w in rows["windows"]], np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    window = np.frombuffer(b"".join(rows["windows"]), np.int64)
    ahead = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    start = rows["first"].to_numpy()[row] + ahead if "first" in rows else ahead
    return rows["beginning"].to_numpy(np.int64)[row], window, (row, start)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """(row_key, spans): for each row of ``docs`` with any, spans (first, end) whose bytes are in repeated strings.

    Tables that were made on the way go as soon as what follows from them is written.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with discarding(spark) as keep_spans:
        with discarding(spark) as keep:
            index = SuffixIndex(spark, length, gram)
            index.add(docs, batches)
            repeated = keep(index.repeated())
        found = _stretch_table(docs, bitmap(repeated, "beginning"), length, gram)
        found = cut(found.join(repeated, "beginning", "left_semi"))
        kinds = cut(found.groupBy("beginning", "stretch").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "first")).alias("at")))
        with discarding(spark) as keep:
            whole = found.join(kinds.where("n > 1").select("beginning", "stretch"), ["beginning", "stretch"], "left_semi")
            whole = whole.select("row_key", "first", (F.col("first") + F.col("n_windows") + (length - 1)).alias("end"))
            edges = keep(_edge_spans(docs, kinds, length, gram))
        spans = whole.unionByName(edges)
        return keep_spans(spans.groupBy("row_key").agg(F.collect_set(F.struct("first", "end")).alias("spans")))


def covered(spans, size: int) -> np.ndarray:
    """Separate runs (start, end) of the bytes in any of the spans."""
    if spans is None or not len(spans):
        return np.zeros((0, 2), np.int64)
    pairs = np.array([(s["first"], s["end"]) for s in spans], np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    fresh = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > reach[:-1]]))
    return np.stack([pairs[fresh, 0], np.minimum(reach[np.append(fresh[1:], len(pairs)) - 1], size)], 1)


def kept_bytes(text: Column, spans: Column) -> Column:
    """Struct: n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes."""

    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    def keep(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for raw, own in zip(plain(texts), found, strict=True):
            runs = covered(own, len(raw))
            edges = [0, *runs.reshape(-1).tolist(), len(raw)]
            rest = b"".join(raw[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True))
            out.append((len(raw), len(raw) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return keep(text, spans)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (``kept``) per document.

    Only rows with repeats, found by a bitmap of their keys, are shuffled to meet their spans.
    """
    spans = repeated_spans(docs.select("doc_id", "text"), length, gram, batches)
    marked = bitmap(spans, "row_key")

    @F.pandas_udf("boolean")
    def may_have(keys: pd.Series) -> pd.Series:
        return pd.Series(holds(marked.value, keys.to_numpy().astype(np.int64).view(np.uint64)))

    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key")).withColumn("marked", may_have("row_key"))
    touched = rows.where("marked").join(spans, "row_key", "left").select("doc_id", "text", "spans")
    clean = rows.where("NOT marked").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    found = touched.unionByName(clean).select("doc_id", kept_bytes(F.col("text"), F.col("spans")).alias("found"))
    return found.select("doc_id", "found.*")
