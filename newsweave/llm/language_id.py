"""Language identification by prediction by partial matching.

Per language a variable-order context tree over folded bytes (64 symbols: letters, any digit, any other ASCII, and
the bytes of other characters with Latin case folded) with the counts seen after each context. The probability of a
symbol is read from the longest context the language has seen; a symbol new to the context pays the escape
probability (method C: different symbols / (occurrences + different symbols)) and is looked up one order lower,
with the symbols of the longer context excluded, down to the uniform distribution. Statistics are frozen after
training, so the code length of a text is exact and the trees of all languages compile into one table with a row per
context: texts are scored by table look-ups.

Training takes at most about ``per_language`` labelled documents of each language (chosen by a hash of ``doc_id``),
a bound that keeps the collected counts small. Whole texts are scored, whatever their length.

Edge cases: null texts and texts without a letter get ``und`` and score 0; without training rows every text does. Ties
go to the first language in alphabetical order. Rows with null ``lang`` are scored but never learned from. Rows with a
null ``doc_id`` are not held out and are learned from; sampling by the id takes all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.llm.texts import objects, plain, slabs, small_batches

UNKNOWN = "und"
ORDER = 3
BITS = 6
SYMBOLS = 1 << BITS
PER_LANGUAGE = 2000
#: A text that costs more bits a symbol than the uniform code is not in any learned language.
REJECT_BITS = float(BITS)
_SLAB = 1 << 18
_LETTER = regex.compile(r"\p{L}")
_ANSWER = "lang_pred string, score double, bits double"


def _fold_table() -> np.ndarray:
    table = np.full(256, 27, np.uint8)  # any other ASCII
    letters = np.arange(26)
    table[ord("a") + letters] = table[ord("A") + letters] = letters
    table[ord("0") : ord("9") + 1] = 26
    table[0x80:0xC0] = 28 + (np.arange(0x80, 0xC0) & 0x1F)
    table[0xC0:] = 60 + (np.arange(0xC0, 0x100) >> 4 & 3)
    return table


_FOLD = _fold_table()
_PAD = b" " * ORDER


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """crc32 of the id's text leaves ``part`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def contexts(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, the code of the ORDER symbols before each, and where each text starts; padding stands before each text."""
    symbols = _FOLD[np.frombuffer(_PAD + _PAD.join(raw), np.uint8)]
    sizes = np.array([len(t) for t in raw])
    starts = np.cumsum(sizes + ORDER) - sizes
    code = np.zeros(len(symbols), np.int32)
    for back in range(1, ORDER + 1):
        code[back:] |= symbols[:-back].astype(np.int32) << (BITS * (back - 1))
    keep = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return symbols[keep], code[keep], np.cumsum(sizes) - sizes


def count_contexts(docs: DataFrame) -> DataFrame:
    """(lang, code, n): how often each context with its next symbol stands in the texts of each language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang", sort=True):
                raw = plain(rows["text"])
                for lo, hi in slabs(raw, _SLAB):
                    symbols, code, _ = contexts(raw[lo:hi])
                    codes, n = np.unique(code << BITS | symbols, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "code": codes, "n": n})

    return docs.select("lang", "text").mapInPandas(count, "lang string, code int, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Trees:
    """Compiled context trees: ``rows`` finds the row of a full context, ``bits`` the code length there, a column per language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """counts: language to codes (context and symbol) and their counts."""
        self.languages = sorted(counts)
        self.rows = np.zeros(1 << BITS * ORDER, np.int32)
        chances = np.full((1, len(self.languages), SYMBOLS), 1.0 / SYMBOLS)
        parents = np.zeros(1, np.int64)  # context code of the order below to its row
        for order in range(ORDER + 1 if counts else 0):
            per = []
            for lang in self.languages:
                codes, n = counts[lang]
                short = codes & ((1 << BITS * (order + 1)) - 1)
                per.append(np.unique(short, return_inverse=True) + (n,))
            seen = np.unique(np.concatenate([p[0] >> BITS for p in per]))
            above = parents[seen & ((1 << BITS * max(order - 1, 0)) - 1)] if order else np.zeros(len(seen), np.int64)
            table = np.zeros((len(seen), len(self.languages), SYMBOLS))
            for column, (codes, inverse, n) in enumerate(per):
                total = np.bincount(inverse, weights=n, minlength=len(codes))
                table[np.searchsorted(seen, codes >> BITS), column, codes & (SYMBOLS - 1)] = total
            base = chances[above]
            fresh = table == 0
            total, kinds = table.sum(2, keepdims=True), (~fresh).sum(2, keepdims=True)
            left = (base * fresh).sum(2, keepdims=True)
            room = np.where(left > 0, total + kinds, total)
            with np.errstate(divide="ignore", invalid="ignore"):
                found = np.where(fresh, kinds / room * base / left, table / room)
            found = np.where(total == 0, base, found)
            size = 1 << BITS * order
            lookup = np.full(size, -1, np.int64)
            lookup[seen] = np.arange(len(seen)) + len(chances)
            inherit = parents[np.arange(size) & ((size >> BITS) - 1)] if order else parents
            parents = np.where(lookup < 0, inherit, lookup)
            chances = np.concatenate([chances, found])
        self.rows[:] = parents if counts else 0
        self.bits = np.ascontiguousarray(-np.log2(chances).transpose(0, 2, 1), np.float32)

    def code_lengths(self, raw: list[bytes]) -> np.ndarray:
        """Bits for each text (rows) in each language (columns)."""
        out = np.zeros((len(raw), len(self.languages)))
        for lo, hi in slabs(raw, _SLAB):
            symbols, code, starts = contexts(raw[lo:hi])
            running = np.zeros((len(symbols) + 1, len(self.languages)))
            np.cumsum(self.bits[self.rows[code], symbols], axis=0, dtype=np.float64, out=running[1:])
            ends = np.append(starts[1:], len(symbols))
            out[lo:hi] = running[ends] - running[starts]
        return out

    def answer(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, its probability under equal chances beforehand, and bits a symbol."""
        raw = plain(texts)
        known = np.array([isinstance(t, str) and _LETTER.search(t) is not None for t in texts], bool)
        if not self.languages or not len(raw):
            return [UNKNOWN] * len(raw), np.zeros(len(raw)), np.full(len(raw), np.inf)
        bits = self.code_lengths(raw)
        best = bits.argmin(1)
        least = bits.min(1)
        score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        each = least / np.maximum(1, [len(t) for t in raw])
        return names, np.where(known, score, 0.0), np.where(known, each, np.inf)


def train(docs: DataFrame, learn_from: Column, per_language: int = PER_LANGUAGE) -> Broadcast:
    """Count on a sample of the labelled rows of at most about ``per_language`` documents each; broadcast the trees."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "lang", "text").where(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts: dict[str, list] = {lang: [] for lang in sizes}
    if sizes:
        share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
        chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
        for r in count_contexts(chosen).toLocalIterator():
            counts[r["lang"]].append((r["code"], r["n"]))
    learned = {lang: tuple(np.array(found, np.int64).T) for lang, found in counts.items() if found}
    return spark.sparkContext.broadcast(Trees(learned))


def identify(text: Column, trees: Broadcast) -> Column:
    """Struct (lang_pred, score, bits a symbol) of a text column."""

    @F.pandas_udf(_ANSWER)
    def answer(texts: pd.Series) -> pd.DataFrame:
        names, score, bits = trees.value.answer(texts)
        return pd.DataFrame({"lang_pred": objects(names), "score": score, "bits": bits})

    return answer(text)


def predict(docs: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the documents that are not held out."""
    out = held_out(F.col("doc_id"), parts, part)
    trees = train(docs, ~out)
    found = docs.select("doc_id", out.alias("held_out"), identify(F.col("text"), trees).alias("answer"))
    return found.select("doc_id", "held_out", "answer.lang_pred", "answer.score")


def keep_identified(docs: DataFrame, parts: int = 4, part: int = 2, reject_bits: float = REJECT_BITS) -> DataFrame:
    """The documents written in one of the learned languages, columns as they came.

    Rejected are null texts, texts without a letter, and texts that the best language codes in more than
    ``reject_bits`` bits a symbol, the price of coding them without any language.
    """
    trees = train(docs, ~held_out(F.col("doc_id"), parts, part))
    tag = "_".join(["language", *docs.columns])  # a name no column has
    found = docs.withColumn(tag, identify(F.col("text"), trees))
    return found.where((F.col(tag)["lang_pred"] != UNKNOWN) & (F.col(tag)["bits"] <= reject_bits)).drop(tag)
