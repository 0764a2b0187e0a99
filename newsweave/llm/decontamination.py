"""Benchmark decontamination by a prefix-filtered join of word windows.

Every benchmark item is cut into windows of ``width`` neighbouring words. A document contains a window only if it
contains the window's rarest word, so that one word (rarity counted over all documents, ties by hash) is the
join prefix. Where it stands in the window fixes where the window would start in the document; starts that leave the
document are dropped by that positional bound, windows longer than the document by the length bound, and the rest
is verified on all words of the window.

The windows are the query set: they go to the scan of the documents in blocks of at most ``block`` windows, so a
block's size is bounded whatever the benchmark's size; the documents' texts are never shuffled.

Edge cases: null or empty texts have no words and are clean; an item of fewer than ``width`` words is one window, an
item without words has none; repeated items count each; items without an ``item_id`` mark words like others, count as one
item and leave no name in the digest; rows with a null or repeated ``doc_id`` are handled one by one;
an empty benchmark leaves every document clean. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.llm.texts import WORD_BYTE, Words, ngram_hashes, plain, slabs, small_batches

WIDTH = 10
BLOCK = 500_000  # windows sent to the scan at once, about 20 MB
_WINDOW = "item_id string, size int, words array<bigint>"
_HITS = "n_words bigint, starts array<int>, ends array<int>, items array<string>"


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per window of every item: item_id as text, number of words, word hashes in order."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            words = Words(plain(batch["text"]), WORD_BYTE)
            signed = words.hashes.view(np.int64)
            for i, item in enumerate(batch["item_id"]):
                own = signed[words.first[i] : words.first[i + 1]]
                size = min(width, len(own))
                if size:
                    rows += [(item, size, own[s : s + size]) for s in range(len(own) - size + 1)]
            yield pd.DataFrame(rows, columns=["item_id", "size", "words"])

    return items.select(F.col("item_id").cast("string"), "text").mapInPandas(cut, _WINDOW)


def word_counts(docs: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """How often each of the ``wanted`` word hashes (sorted, unsigned) stands in all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            raw = plain(batch["text"])
            for lo, hi in slabs(raw):
                found = Words(raw[lo:hi], WORD_BYTE).hashes
                at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                total += np.bincount(at[wanted[at] == found], minlength=len(wanted))
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"word": wanted[seen].view(np.int64), "n": total[seen]})

    if not len(wanted):
        return {}
    rows = docs.select("text").mapInPandas(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in rows.toLocalIterator()}


class _Index:
    """Windows of one block by their rarest word."""

    def __init__(self, rows: list, rarity: dict[int, int]):
        self.items = [r["item_id"] for r in rows]
        self.sizes = np.array([r["size"] for r in rows], np.int64)
        prefix = [min(range(r["size"]), key=lambda j, w=r["words"]: (rarity.get(w[j], 0), w[j])) for r in rows]
        self.places = np.array(prefix, np.int64)
        keys = np.array([r["words"][p] for r, p in zip(rows, prefix, strict=True)], np.int64).view(np.uint64)
        self.whole = np.array([ngram_hashes(np.array(r["words"], np.int64).view(np.uint64), r["size"])[0] for r in rows], np.uint64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Windows found and the word at which each starts."""
        at = np.searchsorted(self.keys, words.hashes)
        at[at == len(self.keys)] = 0
        hits = np.flatnonzero(self.keys[at] == words.hashes)
        until = np.searchsorted(self.keys, words.hashes[hits], side="right")
        each = until - at[hits]
        word = np.repeat(hits, each)
        run = np.arange(len(word)) - np.repeat(np.cumsum(each) - each, each)
        window = self.order[np.repeat(at[hits], each) + run]
        start = word - self.places[window]
        text = words.text[word]
        inside = (start >= words.first[text]) & (start + self.sizes[window] <= words.first[text + 1])  # position and length
        window, start = window[inside], start[inside]
        sizes, equal = self.sizes[window], np.zeros(len(window), bool)
        for size in np.unique(sizes):
            of_size = np.flatnonzero(sizes == size)
            found = ngram_rows(np.stack([words.hashes[start[of_size] + j] for j in range(size)]))
            equal[of_size] = found == self.whole[window[of_size]]
        return window[equal], start[equal]


def ngram_rows(spans: np.ndarray) -> np.ndarray:
    """The hash of ``ngram_hashes`` for each column of word hashes."""
    width, n = spans.shape
    return np.array([], np.uint64) if not n else ngram_hashes(spans.T.reshape(-1), width)[::width]


def _scan(text: Column, index) -> Column:
    """Struct of the word count, hit runs and items of each text against one broadcast block."""

    @F.pandas_udf(_HITS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        windows, raw, out = index.value, plain(texts), []
        for lo, hi in slabs(raw):
            words = Words(raw[lo:hi], WORD_BYTE)
            window, start = windows.search(words)
            order = np.argsort(start, kind="stable")
            window, start = window[order], start[order]
            bounds = np.searchsorted(start, words.first)
            for i in range(hi - lo):
                own = slice(bounds[i], bounds[i + 1])
                begin = start[own] - words.first[i]
                runs = merge(begin, begin + windows.sizes[window[own]])
                out.append((words.first[i + 1] - words.first[i], *runs, sorted({windows.items[w] for w in window[own]}, key=lambda n: (n is None, n))))
        return pd.DataFrame(out, columns=["n_words", "starts", "ends", "items"])

    return scan(text)


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted spans united into separate runs."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    reach = np.maximum.accumulate(ends)
    fresh = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return starts[fresh], reach[np.concatenate([fresh[1:] - 1, [len(starts) - 1]])]


def _united(starts: pd.Series, ends: pd.Series, items: pd.Series) -> pd.DataFrame:
    """Runs and items of all blocks as one: hit words, items, digest of the items sorted as strings."""
    out = []
    for s, e, found in zip(starts, ends, items, strict=True):
        begin, end = np.asarray(s, np.int64), np.asarray(e, np.int64)
        order = np.argsort(begin, kind="stable")
        runs = merge(begin[order], end[order])
        names = sorted({n for n in found if n is not None})
        out.append((int((runs[1] - runs[0]).sum()), len(set(found)), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return pd.DataFrame(out, columns=["n_hit", "n_items", "items_sha256"])


def find_contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, block: int = BLOCK, into: str = "contamination") -> DataFrame:
    """``docs`` with a struct column: n_words, starts and ends of hit word runs, items, n_hit, n_items, items_sha256."""
    spark = docs.sparkSession
    small_batches(spark)
    windows = item_windows(items, width)
    blocks = _blocks(windows, block)
    found = []
    for rows in blocks:
        words = np.unique(np.array([w for r in rows for w in r["words"]], np.int64).view(np.uint64))
        found.append(spark.sparkContext.broadcast(_Index(rows, word_counts(docs, words))))
    if not found:
        found = [spark.sparkContext.broadcast(_Nothing())]
    names = [f"{into}_{i}" for i in range(len(found))]
    out = docs.select("*", *(_scan(F.col("text"), index).alias(n) for n, index in zip(names, found, strict=True)))
    joined = {f: reduce(F.concat, [F.col(n)[f] for n in names]) for f in ("starts", "ends", "items")}
    digest = F.pandas_udf(_united, "n_hit bigint, n_items bigint, items_sha256 string")(joined["starts"], joined["ends"], joined["items"])
    out = out.withColumn(f"{into}_all", digest)
    fields = [F.col(names[0])["n_words"].alias("n_words"), *(c.alias(f) for f, c in joined.items())]
    fields += [F.col(f"{into}_all")[f].alias(f) for f in ("n_hit", "n_items", "items_sha256")]
    return out.withColumn(into, F.struct(*fields)).drop(*names, f"{into}_all")


class _Nothing:
    """A block without windows."""

    items: list[str] = []
    sizes = np.zeros(0, np.int64)

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _blocks(windows: DataFrame, block: int) -> Iterator[list]:
    """All windows, at most ``block`` in memory at a time."""
    rows = []
    for row in windows.toLocalIterator():
        rows.append(row)
        if len(rows) == block:
            yield rows
            rows = []
    if rows:
        yield rows


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document."""
    found = find_contamination(docs.select("doc_id", "text"), items.select("item_id", "text"), width)
    columns = [F.col("contamination")[c].alias(c) for c in ("n_words", "n_hit", "n_items", "items_sha256")]
    return found.select("doc_id", *columns).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without a benchmark window, columns as they came."""
    tag = "_".join(["contamination", *docs.columns])  # a name no column has
    found = find_contamination(docs, items.select("item_id", "text"), width, into=tag)
    return found.where(F.col(tag)["n_hit"] == 0).drop(tag)
