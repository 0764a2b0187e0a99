"""Fill-in-the-middle transformation: cuts texts in three and puts the middle last.

Texts of a batch lie one after another in a buffer of UTF-8 bytes divided into blocks of ``BLOCK`` bytes. A Fenwick tree
over the blocks holds how many units end and how many code points begin in each. A cut after k units descends the tree
by binary lifting to the block that holds the k-th end, carrying the code points passed, and finds the place inside that
block; all cuts of a batch descend together. Prefix sums at the borders of texts come from the same tree.

A unit is a code point, or a match of ``unit`` (a regular expression, matched left to right, empty matches left out);
what follows the last match belongs to the suffix.

Edge cases: null texts count as empty; empty texts and texts that hold a marker stay plain, so ``restored`` always gives
the text back. A null ``doc_id`` draws like an empty one. Repeated rows are cut alike. Texts of any length are cut whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.llm.texts import objects, plain, slabs, small_batches

BLOCK = 256
MARKERS = ("<P>", "<S>", "<M>")
TRANSFORM_PERCENT, SPM_PERCENT, SEED = 90, 20, 1
_CUTS = 4096  # cuts located inside their blocks at once
_ANSWER = "n long, form string, output string, prefix_chars long, middle_chars long"


def unit_ends(raw: list[bytes], buffer: np.ndarray, pattern: regex.Pattern | None) -> np.ndarray:
    """For each byte of the joined texts, whether a unit ends with it."""
    if pattern is None:
        return np.append(buffer[1:] & 0xC0 != 0x80, True)[: len(buffer)]
    ends, at = np.zeros(len(buffer), bool), 0
    for text in raw:
        letters = text.decode("utf-8")
        places = [m.end() for m in pattern.finditer(letters) if m.end() > m.start()]
        if places:
            after = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80), len(text))
            ends[at + after[places] - 1] = True
        at += len(text)
    return ends


class Blocks:
    """Fenwick trees over fixed blocks of bytes: ends of units and beginnings of code points."""

    def __init__(self, buffer: np.ndarray, ends: np.ndarray):
        self.count = -(-len(buffer) // BLOCK)
        room = self.count * BLOCK - len(buffer)
        self.ends = np.append(ends, np.zeros(room, bool)).reshape(self.count, BLOCK)
        self.firsts = np.append(buffer & 0xC0 != 0x80, np.zeros(room, bool)).reshape(self.count, BLOCK)
        self.units, self.points = self._tree(self.ends), self._tree(self.firsts)

    def _tree(self, marks: np.ndarray) -> np.ndarray:
        tree = np.append(0, marks.sum(1, dtype=np.int64))
        step = 1
        while step <= self.count:
            own = tree[2 * step :: 2 * step]
            own += tree[step :: 2 * step][: len(own)]
            step *= 2
        return tree

    def before(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units and code points in front of each place."""
        units, points = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        node = places // BLOCK
        for own, out, marks in ((self.units, units, self.ends), (self.points, points, self.firsts)):
            at = node.copy()
            while at.any():
                out += own[at]
                at &= at - 1
            for lo in range(0, len(places), _CUTS):
                part = slice(lo, lo + _CUTS)
                inside = np.arange(BLOCK) < (places[part] % BLOCK)[:, None]
                out[part] += (marks[np.minimum(node[part], self.count - 1)] & inside).sum(1)
        return units, points

    def after(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte behind each of the units counted from 1, and the code points in front of it."""
        node, left, points = (np.zeros(len(unit), np.int64) for _ in range(3))
        left += unit
        step = 1 << max(self.count.bit_length() - 1, 0)
        while step:
            ahead = np.minimum(node + step, self.count)
            go = (node + step <= self.count) & (self.units[ahead] < left)
            left -= np.where(go, self.units[ahead], 0)
            points += np.where(go, self.points[ahead], 0)
            node += np.where(go, step, 0)
            step >>= 1
        place = np.zeros(len(unit), np.int64)
        for lo in range(0, len(unit), _CUTS):
            part = slice(lo, lo + _CUTS)
            place[part] = (np.cumsum(self.ends[node[part]], 1, dtype=np.int32) >= left[part, None]).argmax(1)
            points[part] += (self.firsts[node[part]] & (np.arange(BLOCK) <= place[part, None])).sum(1)
        return node * BLOCK + place + 1, points


def cut_texts(raw: list[bytes], draws: np.ndarray, pattern: regex.Pattern | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text; per text the bytes at which prefix and middle end; code points of prefix and middle.

    draws: two numbers per text; their remainders by units + 1, in order, are the units in front of each cut.
    """
    count = len(raw)
    sizes = np.array([len(t) for t in raw], np.int64)
    borders = np.append(0, np.cumsum(sizes))
    if not borders[-1]:
        return np.zeros(count, np.int64), np.zeros((count, 2), np.int64), np.zeros((count, 2), np.int64)
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    blocks = Blocks(buffer, unit_ends(raw, buffer, pattern))
    units, points = blocks.before(borders)
    n = np.diff(units)
    wanted = np.sort(draws.astype(np.int64) % (n + 1)[:, None], 1)
    places = np.repeat(borders[:-1, None], 2, 1)
    passed = np.repeat(points[:-1, None], 2, 1)
    some = wanted > 0
    places[some], passed[some] = blocks.after((units[:-1, None] + wanted)[some])
    passed -= points[:-1, None]
    return n, places - borders[:-1, None], np.stack([passed[:, 0], passed[:, 1] - passed[:, 0]], 1)


def arranged(text: bytes, first: int, second: int, form: str) -> bytes:
    prefix, suffix, middle = (m.encode() for m in MARKERS)
    if form == "psm":
        return b"".join([prefix, text[:first], suffix, text[second:], middle, text[first:second]])
    return b"".join([suffix, text[second:], prefix, text[:first], middle, text[first:second]])


def restored(output: Column, form: Column) -> Column:
    """The text again, from the transformed one and its form alone."""
    p, s, m = MARKERS
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned numbers of 32 bits from the SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def transformed(text: Column, four: Column, unit: str | None = None, transform_percent: int = TRANSFORM_PERCENT, spm_percent: int = SPM_PERCENT) -> Column:
    """Struct (n, form, output, prefix_chars, middle_chars) of a text and its four draws; lengths are null where the form is plain."""

    @F.pandas_udf(_ANSWER)
    def answer(texts: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        pattern = regex.compile(unit) if unit else None
        raw, drawn = plain(texts), np.stack(numbers.to_numpy()) if len(numbers) else np.zeros((0, 4), np.int64)
        out = []
        for lo, hi in slabs(raw):
            n, places, points = cut_texts(raw[lo:hi], drawn[lo:hi, :2], pattern)
            for i in range(lo, hi):
                text = raw[i]
                if not text or drawn[i, 2] % 100 >= transform_percent or any(m.encode() in text for m in MARKERS):
                    out.append((n[i - lo], "plain", text.decode(), None, None))
                    continue
                form = "spm" if drawn[i, 3] % 100 < spm_percent else "psm"
                out.append((n[i - lo], form, arranged(text, *places[i - lo], form).decode(), *points[i - lo]))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        return pd.DataFrame({
            "n": pd.Series(columns[0], dtype="int64"), "form": objects(columns[1]), "output": objects(columns[2]),
            "prefix_chars": pd.Series(columns[3], dtype="Int64"), "middle_chars": pd.Series(columns[4], dtype="Int64"),
        })

    return answer(text, four)


def fill_in_middle(docs: DataFrame, unit: str | None = None, seed: int = SEED, transform_percent: int = TRANSFORM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n, form, output, prefix_chars, middle_chars of each document."""
    small_batches(docs.sparkSession)
    found = transformed(F.col("text"), draws(F.col("doc_id"), seed), unit, transform_percent, spm_percent)
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def report(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` with digests of the output and of the text rebuilt from it."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
