"""Line deduplication within one edit, by a deletion-neighbourhood join over the whole collection.

A line is compared by its text without surrounding white space; blank lines stay. A line goes if an earlier line, by
(doc_id, hash of the text, line number), is equal or, where both have ``min_chars`` characters, differs by one inserted, deleted or replaced
character. The relation is direct: whether the earlier line goes itself does not matter. Lines of ``equal_chars``
characters and more are compared for equality, shorter ones stay. The
default is all lines (1), with one edit for a near copy from ``NEAR_CHARS`` on.

Equal lines meet by their hash. For the rest, every variant of a line with one character deleted is a hashed key:
two lines with equal variants for the same place differ by a replacement there; a variant that equals another whole
line differs from it by a deletion. Groups of equal keys keep their earliest members only, so nothing is paired within
a group. The matches found are verified by edit distance on the texts.

Most lines have no neighbour, and a line has as many variants as characters. So passes of coarser variants go before:
each line without one of its pieces, for the two lengths a neighbour can share with it, then without one of the pieces
of such a piece. Keys that only one line has are forgotten, and those left become a bitmap of at most 2**30 bits; the
next pass divides only pieces that the bitmap holds, the last emits variants for the places within them. A full
bitmap would cost work but lose nothing.

Edge cases: null texts have no lines; rows that share a doc_id are documents of their own unless their texts are equal too,
which makes them one document that is not compared with itself; lines of rows without a
doc_id have no place in the order and stay; texts of any length are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.llm.bitmaps import bitmap, holds
from newsweave.llm.texts import joined_hash, mix, objects, prefix_hashes, slabs, small_batches, span_hash
from newsweave.session import cut

EQUAL_CHARS = 1
NEAR_CHARS = 11  # fewest characters at which, as measured, one edit left the letters of a line as they were
PIECES = (4, 8)  # a line is divided into so many pieces, each of these into so many
_LINE = "line bigint, doc_id bigint, row_hash bigint, place int"
_SHARE = "part bigint, tag int"
_VARIANT = "variant bigint, role int, line bigint"
REPLACED, WHOLE, SHORTENED = 0, 1, 2


class _Spans(NamedTuple):
    """Spans of lines (places in the array of characters); shorter: 1 if they stand for a neighbour of one character less."""

    which: np.ndarray
    shorter: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def where(self, mask: np.ndarray) -> _Spans:
        return _Spans(*(x[mask] for x in self))


class _Lines:
    """The compared lines of a slab of texts as one array of characters."""

    def __init__(self, texts: list[str], min_chars: int):
        found = [(i, j, s) for i, text in enumerate(texts) for j, line in enumerate(text.split("\n")) if len(s := line.strip()) >= min_chars]
        self.owner = np.array([f[0] for f in found], np.int64)
        self.place = np.array([f[1] for f in found], np.int64)
        self.text = [f[2] for f in found]
        sizes = np.array([len(t) for t in self.text], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        points = np.frombuffer("".join(self.text).encode("utf-32-le", "replace"), np.uint32)
        self.running = prefix_hashes(points, mix(points.astype(np.uint64) + np.uint64(0x51ED2701)))
        self.hashes = self.span(self.starts, self.ends)

    def span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hash(self.running, starts, ends)

    def without(self, which: np.ndarray, begin: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """Hash of the lines without their characters from ``begin`` to ``end`` (places in the array).

        With salt 0 it equals the hash of a whole line of what is left.
        """
        start, last = self.starts[which], self.ends[which]
        found = joined_hash(self.running, start, begin, end, last)
        salt = np.asarray(salt).astype(np.uint64)
        return np.where(salt == 0, found, mix(found ^ salt * np.uint64(0xC2B2AE3D27D4EB4F)))

    def once(self) -> np.ndarray:
        """One of each group of equal lines."""
        return np.unique(self.hashes, return_index=True)[1]

    def divided(self, spans: _Spans, pieces: int) -> _Spans:
        """The pieces of the given spans."""
        which, shorter, begin, end = (np.repeat(x, pieces) for x in (spans.which, spans.shorter, spans.begin, spans.end))
        piece = np.tile(np.arange(pieces), len(spans.which))
        base = end - begin - shorter
        return _Spans(which, shorter, begin + base * piece // pieces, begin + base * (piece + 1) // pieces + shorter)

    def keys(self, spans: _Spans) -> np.ndarray:
        """Equal for lines that agree outside of a span of the same place and the same shared length."""
        start = self.starts[spans.which]
        shared = self.ends[spans.which] - start - spans.shorter
        size = spans.end - spans.begin - spans.shorter
        return self.without(spans.which, spans.begin, spans.end, 1 + (shared << 32) + ((spans.begin - start) << 8) + size)

    def narrowed(self, found: list[Broadcast], pieces: tuple[int, ...]) -> _Spans:
        """The spans, divided once more than there are bitmaps, that lie within spans whose keys the bitmaps hold."""
        once = self.once()
        which, shorter = np.tile(once, 2), np.repeat([0, 1], len(once))
        spans = _Spans(which, shorter, self.starts[which], self.ends[which])
        for level, count in enumerate(pieces[: len(found) + 1]):
            spans = self.divided(spans, count)
            if level < len(found):
                spans = spans.where(holds(found[level].value, self.keys(spans)))
        return spans


def _read(batch: pd.DataFrame) -> list[str]:
    return [t if isinstance(t, str) else "" for t in batch["text"]]


def _slabs(texts: list[str]) -> Iterator[tuple[int, int]]:
    return slabs(texts, 1 << 18)  # type: ignore[arg-type]


def _compared(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("row_hash"), "text")
    return rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())


def line_table(docs: DataFrame, min_chars: int = NEAR_CHARS) -> DataFrame:
    """Every compared line: its hash, document and place."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids, rows = _read(batch), batch["doc_id"].to_numpy(), batch["row_hash"].to_numpy()
            for lo, hi in _slabs(texts):
                found = _Lines(texts[lo:hi], min_chars)
                yield pd.DataFrame({"line": found.hashes.view(np.int64), "doc_id": ids[lo + found.owner], "row_hash": rows[lo + found.owner], "place": found.place})

    return _compared(docs).mapInPandas(lines, _LINE)


def shared_parts(docs: DataFrame, found: list[Broadcast], min_chars: int = NEAR_CHARS) -> DataFrame:
    """Keys of lines without a piece that at least two different lines have; pieces of those in the bitmaps found before."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _read(batch)
            for lo, hi in _slabs(texts):
                lines = _Lines(texts[lo:hi], min_chars)
                spans = lines.narrowed(found, PIECES)
                tag = (lines.hashes[spans.which] >> np.uint64(33)).astype(np.int32)
                yield pd.DataFrame({"part": lines.keys(spans).view(np.int64), "tag": tag})

    rows = _compared(docs).mapInPandas(parts, _SHARE)
    return rows.groupBy("part").agg(F.min("tag").alias("low"), F.max("tag").alias("high")).where("low < high").select("part")


def candidates(docs: DataFrame, found: list[Broadcast], min_chars: int) -> DataFrame:
    """(line, text): one row for each different line that agrees with another outside of a small piece."""

    def hit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _read(batch)
            for lo, hi in _slabs(texts):
                lines = _Lines(texts[lo:hi], min_chars)
                which = np.unique(lines.narrowed(found, PIECES).which)
                yield pd.DataFrame({"line": lines.hashes[which].view(np.int64), "text": objects(lines.text[i] for i in which)})

    return _compared(docs).mapInPandas(hit, "line bigint, text string").groupBy("line").agg(F.first("text").alias("text"))


def variants(lines: DataFrame, found: list[Broadcast]) -> DataFrame:
    """Deletion variants of different lines (line, text) within the pieces whose rest another line shares, and their whole hashes."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _read(batch)
            for lo, hi in _slabs(texts):
                lines = _Lines(texts[lo:hi], 0)
                spans = lines.narrowed(found, PIECES)
                each = spans.end - spans.begin
                which, shorter = np.repeat(spans.which, each), np.repeat(spans.shorter, each)
                at = np.repeat(spans.begin, each) + np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)
                # with a character less it equals a whole line, else it equals its like without the same place
                salt = np.where(shorter == 1, 0, 1 + at - lines.starts[which])
                yield _rows(lines.without(which, at, at + 1, salt), np.where(shorter == 1, SHORTENED, REPLACED), lines, which)
                every = np.arange(len(lines.hashes))
                yield _rows(lines.hashes, np.full(len(every), WHOLE), lines, every)

    return lines.mapInPandas(emit, _VARIANT)


def _rows(keys: np.ndarray, role: np.ndarray, lines: _Lines, which: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"variant": keys.view(np.int64), "role": role, "line": lines.hashes[which].view(np.int64)})


def near_lines(docs: DataFrame, firsts: DataFrame, min_chars: int = NEAR_CHARS) -> DataFrame:
    """(line, earlier): hashes of different lines with a verified edit distance of one whose second one comes earlier."""
    maps: list[Broadcast] = []
    for _ in PIECES:
        maps.append(bitmap(cut(shared_parts(docs, maps, min_chars)), "part"))
    texts = cut(candidates(docs, maps, min_chars))
    rows = variants(texts, maps).distinct()
    rows = cut(rows.join(firsts, "line").select("variant", F.col("role").alias("side"), "line", F.col("first").alias("at")))
    best = rows.groupBy("variant", "side").agg(F.min(F.struct("at", "line")).alias("best"))
    # a shortened line meets whole lines and the other way round; replaced ones meet their like
    facing = F.when(F.col("side") == SHORTENED, WHOLE).when(F.col("side") == WHOLE, SHORTENED).otherwise(REPLACED)
    best = best.select("variant", facing.alias("side"), "best")
    pairs = rows.join(best, ["variant", "side"]).where((F.col("best.at") < F.col("at")) & (F.col("best.line") != F.col("line")))
    pairs = cut(pairs.select("line", F.col("best.line").alias("earlier")).distinct())
    both = pairs.join(texts, "line").join(texts.select(F.col("line").alias("earlier"), F.col("text").alias("other")), "earlier")
    return both.where(F.levenshtein("text", "other", 1) == 1).select("line", "earlier")


def _position() -> Column:
    """(doc_id, 28 bits of the row's hash, place) as one number of the same order, which a hash aggregate can keep."""
    row = F.col("row_hash").bitwiseAND((1 << 28) - 1) * F.lit(1 << 31) + F.col("place")
    return F.col("doc_id").cast("decimal(19,0)") * F.lit(1 << 59).cast("decimal(18,0)") + row


def dropped_lines(docs: DataFrame, min_chars: int = NEAR_CHARS, equal_chars: int = EQUAL_CHARS) -> DataFrame:
    """(doc_id, row_hash, places, near): the line numbers (from 0) that go in each document, and how many of them had only near matches.

    Documents that keep all lines have no row.
    """
    small_batches(docs.sparkSession)
    lines = cut(line_table(docs, min(equal_chars, min_chars)))
    firsts = cut(lines.groupBy("line").agg(F.min(_position()).alias("first")))
    near = near_lines(docs, firsts, min_chars).select("line").distinct().withColumn("near", F.lit(True))
    firsts = cut(firsts.join(near, "line", "left").withColumn("near", F.coalesce("near", F.lit(False))))
    later = _position() > F.col("first")
    marked = lines.join(firsts, "line").where(F.col("near") | later)
    return marked.groupBy("doc_id", "row_hash").agg(F.collect_set("place").alias("places"), F.count_if(~later).alias("near"))


def _rest(texts: pd.Series, places: pd.Series) -> pd.Series:
    out = []
    for text, gone in zip(texts, places, strict=True):
        if isinstance(text, str) and gone is not None and len(gone):
            out_of = {int(p) for p in gone}
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in out_of)
        out.append(text)
    return pd.Series(out, dtype=object)


def with_rest(docs: DataFrame, prefix: str, min_chars: int = NEAR_CHARS, equal_chars: int = EQUAL_CHARS) -> DataFrame:
    """``docs`` with columns named by ``prefix``: the text that stays, lines removed, and of those the near ones."""
    dropped = dropped_lines(docs.select("doc_id", "text"), min_chars, equal_chars)
    dropped = dropped.select(*(F.col(c).alias(f"{prefix}_{n}") for c, n in (("doc_id", "id"), ("row_hash", "row"), ("places", "places"), ("near", "near"))))
    same = (F.col("doc_id").cast("bigint") == F.col(f"{prefix}_id")) & (F.xxhash64(docs["text"]) == F.col(f"{prefix}_row"))
    both = docs.join(dropped, same, "left")
    return both.select(
        *(docs[c] for c in docs.columns),
        F.pandas_udf(_rest, "string")(docs["text"], F.col(f"{prefix}_places")).alias(f"{prefix}_text"),
        F.coalesce(F.size(f"{prefix}_places"), F.lit(0)).cast("bigint").alias(f"{prefix}_removed"),
        F.coalesce(f"{prefix}_near", F.lit(0)).cast("bigint").alias(f"{prefix}_near"),
    )


def line_report(docs: DataFrame, min_chars: int = NEAR_CHARS, equal_chars: int = EQUAL_CHARS) -> DataFrame:
    """doc_id, n_lines, n_removed, n_near (removed for near matches only), kept_sha256 of the text that stays, per document."""
    found = with_rest(docs.select("doc_id", "text"), "kept", min_chars, equal_chars)
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    return found.select(
        "doc_id", lines.cast("bigint").alias("n_lines"), F.col("kept_removed").alias("n_removed"), F.col("kept_near").alias("n_near"),
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = NEAR_CHARS, equal_chars: int = EQUAL_CHARS) -> DataFrame:
    """The documents without their repeated lines, columns as they came; ``n_chars`` follows where it is a column.

    A document of which nothing but white space stays, though lines went, goes itself.
    """
    prefix = "_".join(["line", *docs.columns])  # a name no column has
    found = with_rest(docs, prefix, min_chars, equal_chars)
    text, removed = F.col(f"{prefix}_text"), F.col(f"{prefix}_removed")
    found = found.where((removed == 0) | text.rlike(r"\S"))
    size = F.when(removed == 0, F.col("n_chars")).otherwise(F.length(text)) if "n_chars" in docs.columns else None
    new = {"text": text, "n_chars": size}
    return found.select(*(new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(c) for c in docs.columns))
