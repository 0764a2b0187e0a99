"""Language-model scores of documents: a smoothed unigram base and a hashed maximum-entropy model.

Tokens are lower-cased (A-Z) words and one end per document; both the counts and the model learn from the training
documents only. The base is exact: counts of all distinct tokens stay distributed. The counts of the most frequent
ones (at most ``FREQUENT``, some 30 MB with their classes) travel to the scan, where most occurrences find theirs; the
rest are joined.

The model factors a token's probability over a tree of classes: every node has up to ``SLOTS`` children of about the same
share of the training tokens, so frequent tokens have short paths. All tokens seen at least ``LEAST`` times whose counts
travel are leaves. One more leaf stands for the others; they have their add-one shares of it, one share going to the
unseen, and what is seen too seldom teaches when to expect it. Each step of a path is a softmax over a sum of weight rows on
top of the unigram shares; the rows are picked by hashing the node with each feature (the token before, the two tokens
before, and the token before the last by skipping).

Sizes follow the data: the tree has as many leaves as there are such tokens, the number of weight rows grows with the square
root of the training tokens (``ROWS`` times it; at most ``MOST_ROWS``, 143 MB, the bound of what is broadcast, reached at
about a thousand million tokens). Training goes once over the training documents in ``ROUNDS`` parts chosen by hash. In a round each
learner makes adaptive gradient updates over its minibatches of sparse rows; the rows it touched are averaged over the
learners, weighted by how often each used them, and the next round starts from there. There are as many learners as
partitions, but no more than leaves each ``TOKENS_PER_ROW`` tokens a weight row, so what they send stays in proportion to
the input. The model's score therefore depends on how the documents are partitioned; the base does not.

Edge cases: null and empty texts are the end alone; with no training tokens every score is 0 (one empty outcome);
rows with a null doc_id are training rows; repeated rows count and are scored each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.llm.language_id import held_out
from newsweave.llm.texts import NOT_SPACE, Words, mix, plain, slabs, small_batches
from newsweave.session import cut

FREQUENT = 1 << 20
LEAST, SLOTS = 2, 16
ROWS, MOST_ROWS = 64, 1 << 21
ROUNDS, TOKENS_PER_ROW = 3, 8
RATE, MINIBATCH = 0.4, 4096  # tokens; each has a decision per step of its path
END, NONE = np.uint64(0x656E6400), np.uint64(0x6E6F6E65)
_CHUNK = 1024  # weight rows averaged together
_FAN = 64  # learners averaged by one task
_EXTREME, _ONES = 80.0, np.ones(SLOTS, np.float32)
_LINE = 16  # numbers in a line of the processor's cache
_PART = "part int, learner int, uses binary, weights binary"


def tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts in order, and the text of each."""
    words = Words(raw, NOT_SPACE)
    ends = words.first[1:]
    return np.insert(words.hashes, ends, END), np.insert(words.text, ends, np.arange(words.count))


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = plain(batch["text"])
            for lo, hi in slabs(raw):
                found, n = np.unique(tokens(raw[lo:hi])[0], return_counts=True)
                yield pd.DataFrame({"token": found.view(np.int64), "n": n})

    return docs.select("text").mapInPandas(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def class_tree(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node and slot of each outcome, node and slot above each node (-1 above the root), log shares of the slots.

    ``mass`` is in descending order. A node deals its outcomes to its slots by the middle of their share, so two
    neighbours never stay together at all levels; a slot with one outcome is a leaf.
    """
    node, slot = np.full(len(mass), -1, np.int32), np.zeros(len(mass), np.int8)
    bounds = np.concatenate([[0.0], np.cumsum(mass, dtype=np.float64)])
    middle = (bounds[1:] + bounds[:-1]) / 2
    up, up_slot, shares, made = [], [], [], 0
    lo, hi = np.array([0]), np.array([len(mass)])
    above, above_slot = np.array([-1]), np.array([0])
    while len(lo) and len(mass) > 1:
        up.append(above)
        up_slot.append(above_slot)
        size = hi - lo
        group = np.repeat(np.arange(len(lo)), size)
        item = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
        bottom, width = bounds[lo][group], (bounds[hi] - bounds[lo])[group]
        own = np.minimum((SLOTS * (middle[item] - bottom) / width).astype(np.int64), SLOTS - 1)
        key = group * SLOTS + own
        with np.errstate(divide="ignore"):
            share = np.log(np.bincount(key, mass[item] / width, len(lo) * SLOTS)).reshape(-1, SLOTS)
        shares.append(np.maximum(share, -1e4).astype(np.float32))
        first = np.flatnonzero(np.diff(key, prepend=-1))
        held = np.diff(np.append(first, len(key)))
        alone, more = first[held == 1], first[held > 1]
        node[item[alone]], slot[item[alone]] = made + group[alone], own[alone]
        above, above_slot = made + group[more], own[more]
        made += len(lo)
        lo = item[more]
        hi = lo + held[held > 1]
    if not up:
        return node, slot, np.zeros(0, np.int32), np.zeros(0, np.int8), np.zeros((0, SLOTS), np.float32)
    return node, slot, np.concatenate(up).astype(np.int32), np.concatenate(up_slot).astype(np.int8), np.concatenate(shares)


class Vocabulary:
    """Frequent tokens with counts, the totals, and the tree of classes."""

    def __init__(self, found: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        """found: hashes, each once; the last entry of the sorted tables stands for the tokens that are no leaves."""
        order = np.argsort(found)
        found, counts = found[order], counts[order]
        self.size, self.total, self.distinct = len(found), total, distinct
        leaves = np.flatnonzero(counts >= LEAST)
        self.rest_total, self.rest_distinct = total - int(counts[leaves].sum()), distinct - len(leaves)
        mass = np.append(counts[leaves], self.rest_total + 1)
        rank = np.lexsort((np.append(leaves, len(found)), -mass))
        node, slot, self.up, self.up_slot, self.shares = class_tree(mass[rank])
        self.tokens = np.append(found, np.uint64(2**64 - 1))
        self.counts = np.append(counts, 0)
        self.is_leaf = np.append(counts >= LEAST, False)
        self.node, self.slot = np.zeros(len(found) + 1, np.int32), np.zeros(len(found) + 1, np.int8)
        at = np.append(leaves, len(found))[rank]
        self.node[at], self.slot[at] = node, slot
        seldom = np.flatnonzero(~self.is_leaf)
        self.node[seldom], self.slot[seldom] = self.node[-1], self.slot[-1]
        self.shift = np.uint64(64 - max(1, len(found).bit_length()))
        firsts = np.arange(1 << int(64 - self.shift), dtype=np.uint64) << self.shift
        self.first = np.searchsorted(found, firsts).astype(np.int32)

    @cached_property
    def logs(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each token's add-one share of all, and of the rest (0 for leaves)."""
        share = np.log10((self.counts + 1) / (self.total + self.distinct + 1))
        return share, np.where(self.is_leaf, 0.0, np.log10((self.counts + 1) / (self.rest_total + self.rest_distinct + 1)))

    def look_up(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the tables (the last one for tokens that are not there), and whether the token is there."""
        at = self.first[wanted >> self.shift]
        behind = np.flatnonzero(self.tokens[at] < wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self.tokens[at[behind]] < wanted[behind]]
        known = (self.tokens[at] == wanted) & (at < self.size)
        return np.where(known, at, self.size), known

    def path(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All steps of the tokens' paths: which token, the node, the slot taken there."""
        token, node, slot = np.arange(len(at)), self.node.take(at), self.slot.take(at)
        found = []
        while True:
            going = np.flatnonzero(node >= 0)
            token, node, slot = token.take(going), node.take(going), slot.take(going)
            found.append((token, node, slot))
            if not len(node):
                return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))
            node, slot = self.up.take(node), self.up_slot.take(node)


def vocabulary(counts: DataFrame, most: int = FREQUENT) -> Vocabulary:
    """The most frequent tokens, at most ``most``, cut at a step of the count so that ties stay together where they fit."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = sorted(((r["step"], r["tokens"]) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("tokens")).collect()), reverse=True)
    room, least = most, None
    for value, size in steps:
        if size > room:
            break
        room, least = room - size, value
    rows = counts.where(step >= least) if least is not None else counts.orderBy(F.desc("n"), "token").limit(most)
    rows = rows.toPandas()
    return Vocabulary(rows["token"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64), int(total), int(distinct))


def features(found: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Three hashed features of each token's history; histories do not cross texts."""
    before = []
    for back in (1, 2):
        shifted = np.full(len(found), NONE, np.uint64)
        same = text[back:] == text[:-back] if len(found) > back else np.zeros(0, bool)
        shifted[back:][same] = found[:-back][same] if len(found) > back else 0
        before.append(shifted)
    one, two = before
    # each feature of all tokens in one piece of memory
    return np.stack([mix(one + np.uint64(1)), mix(mix(two + np.uint64(2)) ^ one), mix(two + np.uint64(3))]).T


def weight_rows(total: int) -> int:
    """Rows of weights for so many training tokens, in whole chunks."""
    return min(MOST_ROWS, _CHUNK * -(-int(ROWS * np.sqrt(max(total, 1))) // _CHUNK))


def in_lines(weights: np.ndarray) -> np.ndarray:
    """A copy whose rows each fill one line of the processor's cache."""
    room = np.empty(weights.size + _LINE, weights.dtype)
    skip = -room.ctypes.data // room.itemsize % _LINE
    out = room[skip : skip + weights.size].reshape(weights.shape)
    out[:] = weights
    return out


class Model:
    """Weight rows, one per hashed node and feature, and the sums of their squared gradients."""

    def __init__(self, words: Vocabulary, weights: np.ndarray | None = None, squares: np.ndarray | None = None):
        self.words = words
        self.weights = np.zeros((weight_rows(words.total), SLOTS), np.float32) if weights is None else weights
        self.squares = np.ones(len(self.weights), np.float32) if squares is None else squares

    def __setstate__(self, state: dict) -> None:
        """What comes from a broadcast is laid out anew for reading rows at random."""
        self.__dict__ |= state | {"weights": in_lines(state["weights"])}
        self.words.shares = in_lines(self.words.shares)

    def rows(self, hashed: np.ndarray, node: np.ndarray) -> np.ndarray:
        salted = mix(hashed.T ^ (node.astype(np.uint64) + np.uint64(11)) * np.uint64(0x9E3779B97F4A7C15))
        salted >>= np.uint64(32)
        salted *= np.uint64(len(self.weights))
        salted >>= np.uint64(32)
        return salted.view(np.int64).T

    def logits(self, picked: Iterable[np.ndarray], node: np.ndarray) -> np.ndarray:
        """Unscaled sums of the weights picked for each feature, within what an exponential can take."""
        out = self.words.shares.take(node, 0)
        for weights in picked:
            out += weights
        return np.clip(out, -_EXTREME, _EXTREME, out=out)

    def log10(self, at: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """log10 of each token's leaf, given its history."""
        out = np.zeros(len(at))
        for lo in range(0, len(at), MINIBATCH):
            token, node, slot = self.words.path(at[lo : lo + MINIBATCH])
            rows = self.rows(hashed.T.take(lo + token, 1).T, node)
            logits = self.logits((self.weights.take(column, 0) for column in rows.T), node)
            own = logits.reshape(-1).take(np.arange(len(node)) * SLOTS + slot).astype(np.float64)
            own -= np.log(np.exp(logits, out=logits) @ _ONES)
            out[lo : lo + MINIBATCH] = np.bincount(token, own, len(out[lo : lo + MINIBATCH])) / np.log(10)
        return out


class Trainer:
    """Adaptive gradient updates of a learner's own copy of the weights.

    ``state`` has two numbers a weight row that are read and written together: the sum of squares, and (imaginary) the uses.
    """

    def __init__(self, model: Model):
        self.model = Model(model.words, in_lines(model.weights), model.squares)
        self.state = model.squares.astype(np.complex64)
        self.last = np.zeros(len(model.weights), np.int32)

    def shared(self, rows: np.ndarray, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows that several of the decisions use: the rows, their summed slopes, and the number of uses."""
        place = np.arange(len(rows), dtype=np.int32)
        self.last[rows] = place
        several = self.last.take(rows) != place
        several[self.last.take(rows.compress(several))] = True
        place = np.flatnonzero(several)
        # one sort of row and decision together
        flat = np.sort(rows.take(place) << 32 | place % len(slope))
        step, flat = flat & 0xFFFFFFFF, flat >> 32
        first = np.flatnonzero(np.diff(flat, prepend=-1))
        # summed as pairs of numbers, which takes half as many steps
        summed = np.add.reduceat(slope.take(step, 0).view(np.complex64), first, axis=0).view(np.float32) if len(first) else slope[:0]
        return flat[first], summed, np.diff(np.append(first, len(flat)))

    def learn(self, at: np.ndarray, hashed: np.ndarray) -> None:
        model = self.model
        whole = model.weights.view(f"V{model.weights.strides[0]}")[:, 0]  # a row as one item, which is quicker to write
        for lo in range(0, len(at), MINIBATCH):
            token, node, slot = model.words.path(at[lo : lo + MINIBATCH])
            if not len(node):
                continue
            rows = model.rows(hashed.T.take(lo + token, 1).T, node)
            old = [model.weights.take(column, 0) for column in rows.T]
            slope = model.logits(old, node)
            np.exp(slope, out=slope)
            slope *= (1 / (slope @ _ONES))[:, None]
            slope.reshape(-1)[np.arange(len(node)) * SLOTS + slot] -= 1
            again, summed, times = self.shared(rows.T.reshape(-1), slope)
            both = self.state.take(again)
            both += np.einsum("ij,ij->i", summed, summed) + 1j * times
            summed *= (RATE / np.sqrt(both.real))[:, None]
            summed = model.weights.take(again, 0) - summed
            # every row as if it were used once, then those used oftener
            once = np.einsum("ij,ij->i", slope, slope) + np.complex64(1j)
            for column, weights in zip(rows.T, old, strict=True):
                state = self.state.take(column)
                state += once
                self.state[column] = state
                weights -= slope * (RATE / np.sqrt(state.real))[:, None]
                whole.put(column, weights.view(whole.dtype))
            self.state[again], model.weights[again] = both, summed


def _chunks(trainer: Trainer, learner: int, parts: range) -> pd.DataFrame:
    """The chunks of weight rows that were used."""
    out = []
    for p in parts:
        part = slice(p * _CHUNK, (p + 1) * _CHUNK)
        state = trainer.state[part]
        if state.imag.any():
            weights = np.column_stack([trainer.model.weights[part], state.real])
            out.append((p, learner, state.imag.astype(np.float64).tobytes(), weights.tobytes()))
    return pd.DataFrame(out, columns=["part", "learner", "uses", "weights"])


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """Mean of one chunk over its learners, weighted by their uses of each row; unused rows keep the first one's values."""
    uses, summed = np.zeros(_CHUNK), np.zeros((_CHUNK, SLOTS + 1))
    for own, weights in zip(rows["uses"], rows["weights"], strict=True):
        own = np.frombuffer(own, np.float64)
        uses += own
        summed += own[:, None] * np.frombuffer(weights, np.float32).reshape(-1, SLOTS + 1)
    start = np.frombuffer(rows["weights"].iloc[0], np.float32).reshape(-1, SLOTS + 1)
    mean = np.where(uses[:, None] > 0, summed / np.maximum(uses, 1)[:, None], start).astype(np.float32)
    return pd.DataFrame([(rows["part"].iloc[0], rows["learner"].iloc[0] // _FAN, uses.tobytes(), mean.tobytes())], columns=rows.columns)


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Rounds of local updates by the learners and a weighted mean of what they touched."""
    spark = docs.sparkSession
    model = Model(words)
    if not words.total:
        return model
    size = len(model.weights)
    learners = max(1, words.total // (rounds * size * TOKENS_PER_ROW))
    for number in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def local(batches: Iterator[pd.DataFrame], sent: Broadcast = sent) -> Iterator[pd.DataFrame]:
            trainer = Trainer(sent.value)
            for batch in batches:
                raw = plain(batch["text"])
                for lo, hi in slabs(raw):
                    found, text = tokens(raw[lo:hi])
                    trainer.learn(trainer.model.words.look_up(found)[0], features(found, text))
            for lo in range(0, size // _CHUNK, 64):
                yield _chunks(trainer, TaskContext.get().partitionId(), range(lo, min(lo + 64, size // _CHUNK)))

        own = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == number).select("text").coalesce(learners)
        found, left = own.mapInPandas(local, _PART), learners
        while left > 1:  # at most _FAN copies of a chunk meet in a task
            found, left = found.groupBy("part", F.floor(F.col("learner") / _FAN)).applyInPandas(_mean, _PART), -(-left // _FAN)
        model = Model(words, model.weights.copy(), model.squares.copy())
        for row in found.toLocalIterator():
            part, learned = slice(row["part"] * _CHUNK, (row["part"] + 1) * _CHUNK), np.frombuffer(row["weights"], np.float32).reshape(-1, SLOTS + 1)
            model.weights[part], model.squares[part] = learned[:, :SLOTS], learned[:, SLOTS]
        sent.unpersist()
    return model


_SCORE = "n_tokens bigint, n_known bigint, base double, model double, rest array<bigint>, times array<int>"


def _scan(model: Broadcast):
    """What a text's frequent tokens give, and its other tokens with their numbers."""

    @F.pandas_udf(_SCORE)
    def scan(texts: pd.Series) -> pd.DataFrame:
        own, raw, out = model.value, plain(texts), []
        words = own.words
        share, rest_share = words.logs
        for lo, hi in slabs(raw):
            found, text = tokens(raw[lo:hi])
            size = hi - lo
            at, known = words.look_up(found)
            base = np.where(known, share[at], 0.0)
            chance = own.log10(at, features(found, text)) + np.where(known, rest_share[at], 0.0)
            sums = [np.bincount(text, w, size) for w in (known, base, chance)]
            counts = np.bincount(text, minlength=size)
            rare = np.flatnonzero(~known)
            order = np.lexsort((found[rare], text[rare]))
            rare_text, rare_token = text[rare][order], found[rare][order]
            fresh = np.flatnonzero(np.concatenate([[True], (rare_text[1:] != rare_text[:-1]) | (rare_token[1:] != rare_token[:-1])])) if len(rare) else rare
            times = np.diff(np.append(fresh, len(rare)))
            bounds = np.searchsorted(rare_text[fresh], np.arange(size + 1))
            token = rare_token[fresh].view(np.int64)
            out += [(counts[i], int(sums[0][i]), sums[1][i], sums[2][i], token[bounds[i] : bounds[i + 1]], times[bounds[i] : bounds[i + 1]]) for i in range(size)]
        return pd.DataFrame(out, columns=["n_tokens", "n_known", "base", "model", "rest", "times"])

    return scan


def score(docs: DataFrame, parts: int = 7, part: int = 2, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document."""
    spark = docs.sparkSession
    small_batches(spark)
    out = held_out(F.col("doc_id"), parts, part)
    learned = docs.select("doc_id", "text").where(~out)
    counts = cut(token_counts(learned))
    words = vocabulary(counts, frequent)
    model = spark.sparkContext.broadcast(train(learned, words, rounds))
    rows = docs.select("doc_id", out.alias("held_out"), _scan(model)("text").alias("found"), F.monotonically_increasing_id().alias("row"))
    rows = cut(rows.select("row", "doc_id", "held_out", "found.*"))
    # occurrences whose counts did not travel with the scan meet them here
    rare = rows.where(F.size("rest") > 0).select("row", F.explode(F.arrays_zip("rest", "times")).alias("z"))
    rare = rare.select("row", F.col("z.rest").alias("token"), F.col("z.times").alias("times")).join(counts, "token", "left")
    count = F.coalesce("n", F.lit(0))
    rest_room = words.rest_total + words.rest_distinct + 1
    sums = rare.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((count + 1) / F.lit(float(words.total + words.distinct + 1)))).alias("base_rest"),
        F.sum(F.col("times") * F.log10((count + 1) / F.lit(float(rest_room)))).alias("model_rest"),
    )
    both = rows.join(sums, "row", "left")
    zero = F.lit(0.0)
    return both.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rest", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("model_rest", zero)).alias("score"),
    )
