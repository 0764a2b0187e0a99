"""Token counts of a byte-level BPE vocabulary by a compiled finite-state transducer.

The merges of a piece of text are a deterministic function of its bytes from left to right: the last token of every
prefix is the one vocabulary entry that ends there and forms a stable pair with the last token of the prefix before
it. A state keeps what later bytes can still change: the longest tail that may grow into an entry, with the last
token and the relative token count at each of its places. A transition reads a byte and is annotated with the number
of tokens it emits (negative where a merge takes tokens back). Transitions are compiled when first needed and kept
for the life of the worker.

Texts are cut into chunks that run through the table in step. A chunk's state map is constant after the first place
where a new piece must begin, whatever the state before; only the head before that place depends on the arriving state.
The maps are composed along the text: exit states pass to the next chunk's head, again for all chunks in step.

Pieces begin where the vocabulary's splitting rule says so; the rule looks at most three characters around, so it is
evaluated on whole arrays. Character classes come from the library's own splitter. The tokenizer's special strings
count as one token each and separate their surroundings, the library's default.

Edge cases: null or empty texts have 0 bytes and 0 tokens; texts of any length are counted whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsweave.llm.texts import plain, slabs, small_batches

LIMIT = 512
CHUNK = 512
MAX_STATES = 250_000  # compiled states are dropped beyond and compiled anew
LETTER, NUMBER, BLANK, SPACE, OTHER = 1, 2, 3, 4, 5
_NEVER = 1 << 60
_SHIFT, _ZERO = 6, 48  # a transition holds the next state and, in the low bits, its token count plus _ZERO
_COUNTS = "n_bytes bigint, n_tokens bigint"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such vocabularies: printable ones for themselves, the others from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transducer:
    """Compiled states of one tokenizer file; grows as texts ask for it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.tokens = {as_bytes(t) for t in described["model"]["vocab"]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in described["model"]["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        self.beginnings = {t[:n] for t in self.tokens for n in range(1, len(t) + 1)}
        self.special = [t["content"] for t in described.get("added_tokens", ())]
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.classes = np.zeros(0x110000, np.uint8)
        self.spines: tuple[dict, dict] = ({}, {})
        self.reset()

    def reset(self) -> None:
        """State 0 is the start of a piece; state 1 is unknown: it stays and emits nothing."""
        self.stable: dict[tuple[bytes | None, bytes], bool] = {}
        self.states = [(b"", (None,), (0,)), None]
        self.numbers = {self.states[0]: 0}
        self.column = np.full(256, -1, np.int16)  # only bytes met so far have a column
        self.byte: list[int] = []
        self.table = np.full((4096, 32), -1, np.int32)
        self.table[1] = 1 << _SHIFT | _ZERO

    def columns_of(self, data: np.ndarray) -> np.ndarray:
        """The table column of each byte; new bytes get new ones."""
        new = np.flatnonzero((self.column < 0) & (np.bincount(data, minlength=256) > 0))
        used = len(self.byte)
        self.byte += new.tolist()
        self.column[new] = np.arange(used, used + len(new))
        if used + len(new) > self.table.shape[1]:
            more = np.full((len(self.table), used + len(new) + 16 - self.table.shape[1]), -1, np.int32)
            more[1] = 1 << _SHIFT | _ZERO
            self.table = np.concatenate([self.table, more], axis=1)
        return self.column[data]

    def merge(self, piece: bytes, down_to: int = 1) -> list[bytes]:
        """Plain byte-pair merging, lowest rank first, until ``down_to`` parts are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > down_to:
            rank, at = min((self.ranks.get(pair, _NEVER), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == _NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at one end (0 left, 1 right) of ``token`` while it is merged, with the rank that ends each."""
        known = self.spines[side].get(token)
        if known is None:
            known = [(token, _NEVER)]
            if len(token) > 1:
                halves = self.merge(token, 2)
                rank = self.ranks.get(tuple(halves), _NEVER) if len(halves) == 2 else _NEVER
                if rank == _NEVER:
                    known = []  # merging never yields this entry
                else:
                    known += [(t, min(end, rank)) for t, end in self.spine(halves[side], side)]
            self.spines[side][token] = known
        return known

    def stays(self, left: bytes | None, right: bytes) -> bool:
        """Do the two tokens side by side come out of merging as they are?

        They do not if, while both are built, a pair of end tokens that stand side by side merges across: before
        its left member ends, and before or with its right member, since equal ranks merge from the left.
        """
        key = (left, right)
        known = self.stable.get(key)
        if known is None:
            inner = self.spine(right, 0)
            known = bool(inner)
            for a, a_end in self.spine(left, 1) if left and inner else ():
                for b, b_end in inner:
                    rank = self.ranks.get((a, b), _NEVER)
                    if rank < a_end and rank <= b_end and rank < _NEVER:
                        known = False
            self.stable[key] = known
        return known

    def compile(self, state: int, byte: int) -> None:
        """Add the transition of ``state`` on ``byte``."""
        tail, last, counts = self.states[state]
        grown = tail + bytes([byte])
        for start in range(len(grown)):
            token = grown[start:]
            if token in self.tokens and self.stays(last[start], token):
                break
        count = counts[start] + 1
        last, counts = (*last, token), (*counts, count)
        cut = 0
        while grown[cut:] not in self.beginnings:
            cut += 1
        key = (grown[cut:], last[cut:], tuple([c - count for c in counts[cut:]]))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            if number >= len(self.table):
                self.table = np.concatenate([self.table, np.full((len(self.table) // 2, self.table.shape[1]), -1, np.int32)])
        self.table[state, self.column[byte]] = number << _SHIFT | count + _ZERO

    def step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        found = self.table[state, column]
        if found.min(initial=0) < 0:
            missing = np.flatnonzero(found < 0)
            for s, c in set(zip(state[missing].tolist(), column[missing].tolist(), strict=True)):
                self.compile(s, self.byte[c])
            found = self.table[state, column]
        return found

    def emitted(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Tokens emitted at each byte; ``begins`` marks the bytes that begin a piece, the first byte among them."""
        if len(self.states) > MAX_STATES:
            self.reset()
        size = len(data)
        width = -(-size // CHUNK)
        bytes_in_step = np.zeros(width * CHUNK, np.int16)
        bytes_in_step[:size] = self.columns_of(data)
        fresh = np.zeros(width * CHUNK, bool)
        fresh[:size] = begins
        fresh[size:] = True  # the filling is single bytes
        by_step, fresh_step = bytes_in_step.reshape(width, CHUNK).T.copy(), fresh.reshape(width, CHUNK).T.copy()
        out = np.zeros((CHUNK, width), np.int8)
        state = np.ones(width, np.int64)
        for t in range(CHUNK):
            state[fresh_step[t]] = 0
            found = self.step(state, by_step[t])
            state = (found >> _SHIFT).astype(np.int64)
            out[t] = (found & (1 << _SHIFT) - 1) - _ZERO
        heads = np.where(fresh_step.any(0), fresh_step.argmax(0), CHUNK)
        waiting = np.flatnonzero(heads > 0)
        while len(waiting):
            ready = waiting[state[waiting - 1] != 1]
            arriving = state[ready - 1].copy()
            for t in range(int(heads[ready].max())):
                on = heads[ready] > t
                found = self.step(arriving[on], by_step[t, ready[on]])
                arriving[on] = found >> _SHIFT
                out[t, ready[on]] = (found & (1 << _SHIFT) - 1) - _ZERO
            whole = heads[ready] == CHUNK
            state[ready[whole]] = arriving[whole]
            waiting = np.setdiff1d(waiting, ready, assume_unique=True)
        return out.T.reshape(-1)[:size]

    def learn_classes(self, points: np.ndarray) -> None:
        """Classes of characters not met before, asked from the library's splitter."""
        for point in np.unique(points[self.classes[points] == 0]):
            char = chr(point)
            kinds = [k for k, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.splitter.pre_tokenize_str(beside + char)) == 1]
            self.classes[point] = SPACE if char == " " else kinds[0] if kinds else BLANK

    def piece_starts(self, points: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Which characters begin a piece; ``segment`` marks the first character of each separate stretch."""
        self.learn_classes(points)
        kind = self.classes[points]
        before = np.concatenate([[BLANK], kind[:-1]])
        blank, blank_before = (kind == BLANK) | (kind == SPACE), (before == BLANK) | (before == SPACE)
        more = np.append(~segment[1:], False)  # the next character belongs to the same stretch
        solid_next = more & ~np.append(blank[1:], True)
        starts = np.where(blank, ~blank_before | solid_next, np.where(blank_before, before == BLANK, kind != before))
        starts |= segment
        quote = np.flatnonzero((points == 0x27) & (segment | (before == LETTER) | (before == NUMBER) | (before == BLANK)))
        padded = np.concatenate([points, [0, 0, 0]])
        apart = np.concatenate([segment, [True, True, True]])
        one, two = np.where(apart[quote + 1], 0, padded[quote + 1]), np.where(apart[quote + 1] | apart[quote + 2], 0, padded[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        taken = short | long
        starts[quote[taken] + 1] = False
        after = quote[taken] + np.where(short[taken], 2, 3)
        starts[after[after < len(starts)]] = True
        return starts

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        parts, owner, total = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = [text]
            for mark in self.special:
                if mark in text:
                    pieces = [p for piece in pieces for p in piece.split(mark)]
            total[i] = len(pieces) - 1
            parts += [p for p in pieces if p]
            owner += [i for p in pieces if p]
        if not parts:
            return total
        whole = "".join(parts)
        points = np.frombuffer(whole.encode("utf-32-le", "replace"), np.uint32)
        lengths = np.array([len(p) for p in parts])
        first = np.cumsum(lengths) - lengths
        segment = np.zeros(len(points), bool)
        segment[first] = True
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        place = np.cumsum(width) - width
        data = np.frombuffer(whole.encode("utf-8", "replace"), np.uint8)
        begins = np.zeros(len(data), bool)
        begins[place[self.piece_starts(points, segment)]] = True
        emitted = np.add.reduceat(self.emitted(data, begins).astype(np.int64), place[first])
        np.add.at(total, owner, emitted)
        return total


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per worker process and file."""
    return Transducer(path)


def token_count(text: Column, path: str) -> Column:
    """Struct (n_bytes, n_tokens) of a text column; ``path`` is the tokenizer's file on every executor."""

    @F.pandas_udf(_COUNTS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = transducer(path)
        for texts in batches:
            raw = plain(texts)
            tokens = np.zeros(len(raw), np.int64)
            for lo, hi in slabs(raw):
                tokens[lo:hi] = machine.count([t if isinstance(t, str) else "" for t in texts.iloc[lo:hi]])
            yield pd.DataFrame({"n_bytes": [len(t) for t in raw], "n_tokens": tokens})

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document."""
    small_batches(docs.sparkSession)
    found = docs.select("doc_id", token_count(F.col("text"), path).alias("count"))
    return found.select("doc_id", "count.n_bytes", "count.n_tokens", (F.col("count.n_tokens") > limit).alias("over_limit"))
