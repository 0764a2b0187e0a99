"""Packing of tokenised documents into sequences of bounded length by a grouping genetic algorithm.

Documents become token ids; longer ones than a sequence are cut into full sequences and a rest. The pieces are dealt
at random (by hash) into districts of about ``DISTRICT`` pieces. Every district evolves on ``ISLANDS`` islands: a
solution is a list of bins; crossover takes well-filled bins of one parent whole, removes the bins of the other that
hold any of the same pieces, and puts the displaced pieces back by best fit; mutation dissolves badly filled bins. After
an epoch each island's elite moves to the next island, and evolution goes on there. The best island's solution stands;
its bins that are not nearly full are dealt and packed again in a next round, in fewer districts, until one
district holds all of them. A district that needs no more bins than its tokens fill at least is finished at once.

Token ids are found piece by piece, see ``Encoder``; a worker keeps the ids of pieces it has met.

Edge cases: a null or empty text is the end id alone; repeated rows are packed each; an empty table has no pieces.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.llm.texts import small_batches
from newsweave.llm.token_counts import byte_letters
from newsweave.session import cut

CAPACITY = 2048
END_ID = 0
DISTRICT = 4000
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 2, 2, 5, 8
FULL = 0.998  # bins filled to this share are not packed again
CACHE = 600_000  # pieces of a kind whose ids a worker keeps, about 110 MB
#: Ids pass pandas as text, which holds nulls beside large numbers.
_PIECE = "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Ids(dict):
    """Ids of pieces as bytes, made when first asked for; when full, the half that was not asked for lately goes."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.make(piece)
        self.keep(piece, found)
        return found

    def keep(self, piece: str, found: bytes) -> None:
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = found


class Encoder:
    """Ids of whole texts from the cached ids of their pieces.

    The vocabulary joins nothing across white space, so any text is the ids of its blank-separated chunks in order. Texts
    of Latin-1 characters are divided further, by the vocabulary's own splitting rule, whose classes are plain there; new
    pieces then need the merges only. All others go through the whole library.
    """

    #: The splitting rule within lower-cased Latin-1 (fixed values: contractions, letters, numbers).
    PIECE = re.compile(r"[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-z0-9ªµºß-öø-ÿ²³¹¼½¾]+")
    ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")  # separators that are no white space to the vocabulary; special strings

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # executors already use every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        letter = {b: c for c, b in byte_letters().items()}
        self.letters = {p: "".join(letter[b] for b in chr(p).encode()) for p in range(256)}
        self.merge = self.tokenizer.model.tokenize
        self.merged, self.chunks = _Ids(self.learn), _Ids(lambda chunk: self.encoded([chunk])[0])

    def learn(self, piece: str) -> bytes:
        return _packed([t.id for t in self.merge(piece.translate(self.letters))])

    def encoded(self, chunks: list[str]) -> list[bytes]:
        return [_packed(found.ids) for found in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if _latin(text) and not any(mark in text for mark in self.ODD):
            return b"".join(map(self.merged.__getitem__, self.PIECE.findall(text.lower())))
        chunks, known = text.replace("\n", " ").split(" "), self.chunks
        new = [c for c in set(chunks) if c not in known and c not in known.older]
        for chunk, found in zip(new, self.encoded(new), strict=True):
            known.keep(chunk, found)
        return b"".join(map(known.__getitem__, chunks))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document as token ids with the end id, cut at ``capacity``."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = (make.ids(text) if isinstance(text, str) else b"") + end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    rows.append((doc, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(encode, _PIECE)
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))


class _Bins:
    """A partial solution: bins of piece numbers, and their free room in order for best fit."""

    def __init__(self, lengths: np.ndarray, capacity: int, bins: list[list[int]]):
        self.lengths, self.bins = lengths, bins
        self.free = sorted((capacity - int(lengths[b].sum()), i) for i, b in enumerate(bins))
        self.capacity = capacity

    def fit(self, item: int) -> None:
        """Into the fullest bin with room enough, or a new one."""
        size = int(self.lengths[item])
        at = bisect.bisect_left(self.free, (size, -1))
        if at == len(self.free):
            self.bins.append([item])
            left = (self.capacity - size, len(self.bins) - 1)
        else:
            room, i = self.free.pop(at)
            self.bins[i].append(item)
            left = (room - size, i)
        bisect.insort(self.free, left)


def best_fit(lengths: np.ndarray, capacity: int, order: np.ndarray, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Pieces in the given order by best fit, beside the bins there are."""
    made = _Bins(lengths, capacity, [list(b) for b in bins or ()])
    for item in order:
        made.fit(int(item))
    return made.bins


def fitness(lengths: np.ndarray, capacity: int, bins: list[list[int]]) -> tuple[int, float]:
    """Fewer bins first, then bins as unevenly filled as can be."""
    return -len(bins), sum((float(lengths[b].sum()) / capacity) ** 2 for b in bins)


def cross(lengths: np.ndarray, capacity: int, giver: list[list[int]], taker: list[list[int]], rng: np.random.Generator) -> list[list[int]]:
    """The giver's best bins whole, the taker's bins without their pieces, the displaced pieces by best fit."""
    fills = np.array([lengths[b].sum() for b in giver])
    best = np.argsort(-fills, kind="stable")[: max(1, len(giver) // 2)]
    injected = [giver[i] for i in best[rng.random(len(best)) < 0.7]]
    taken = {item for b in injected for item in b}
    kept = [b for b in taker if taken.isdisjoint(b)]
    loose = [item for b in taker if not taken.isdisjoint(b) for item in b if item not in taken]
    return best_fit(lengths, capacity, sorted(loose), injected + kept)


def mutate(lengths: np.ndarray, capacity: int, bins: list[list[int]], rng: np.random.Generator) -> list[list[int]]:
    """Dissolve the emptiest bins and some others, best-fit their pieces."""
    order = np.argsort([lengths[b].sum() for b in bins], kind="stable")
    gone = set(order[:3].tolist()) | set(rng.integers(0, len(bins), 2).tolist())
    loose = sorted(item for i in gone for item in bins[i])
    return best_fit(lengths, capacity, loose, [b for i, b in enumerate(bins) if i not in gone])


def evolve(lengths: np.ndarray, capacity: int, seed: int, elites: list[list[list[int]]]) -> list[list[int]]:
    """One epoch on one island; ``lengths`` fall, so that smaller numbers are longer pieces. Repeats with the same seed are equal."""
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // capacity)
    people = [*elites, best_fit(lengths, capacity, np.arange(len(lengths)))]
    while len(people) < POPULATION:
        if min(map(len, people)) <= least:
            return min(people, key=len)
        blur = lengths * rng.uniform(0.7, 1.3, len(lengths))
        people.append(best_fit(lengths, capacity, np.argsort(-blur, kind="stable")))
    score = lambda bins: fitness(lengths, capacity, bins)
    for _ in range(GENERATIONS):
        people.sort(key=score, reverse=True)
        if len(people[0]) <= least:
            break
        one, two = rng.choice(POPULATION, 2, replace=False)
        child = mutate(lengths, capacity, cross(lengths, capacity, people[one], people[two], rng), rng)
        people = [*people[: POPULATION - 1], child]
    return max(people, key=score)


def _bins_of(numbers) -> list[list[int]]:
    found: dict[int, list[int]] = {}
    for item, number in enumerate(numbers):
        found.setdefault(int(number), []).append(item)
    return list(found.values())


def _numbers(bins: list[list[int]], count: int) -> np.ndarray:
    out = np.zeros(count, np.int32)
    for number, items in enumerate(bins):
        out[items] = number
    return out


_ORDER = ["length", "doc_id", "piece", "ids_crc32", "start"]
_SOLUTION = "district bigint, island int, n_bins int, fill double, bins array<int>"


def _sorted(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(_ORDER, ascending=[False, True, True, True, True], kind="stable")


def _living(capacity: int, epoch: int):
    """One epoch of an island as a function of its key and pieces."""

    def live(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return settle(key, rows, None)

    def settle(key: tuple, rows: pd.DataFrame, arrived: pd.DataFrame | None) -> pd.DataFrame:
        lengths = _sorted(rows)["length"].to_numpy()
        guests = [] if arrived is None else [_bins_of(b) for b in arrived.sort_values("from_island")["bins"]]
        bins = evolve(lengths, capacity, int(key[0]) * 1009 + int(key[1]) * 31 + epoch, guests)
        count, fill = fitness(lengths, capacity, bins)
        return pd.DataFrame({"district": [key[0]], "island": [key[1]], "n_bins": [-count], "fill": [fill], "bins": [_numbers(bins, len(lengths))]})

    return live if epoch == 0 else settle


def pack_round(items: DataFrame, districts: int, capacity: int) -> DataFrame:
    """``items`` with a district and, within it, a bin."""
    dealt = items.withColumn("district", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(districts)), F.lit(districts)))
    dealt = cut(dealt)
    on_islands = dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    found = on_islands.groupBy("district", "island").applyInPandas(_living(capacity, 0), _SOLUTION)
    for epoch in range(1, EPOCHS):
        elites = cut(found)
        stay = elites.select("district", "island", F.col("island").alias("from_island"), "bins")
        move = elites.select("district", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("island").alias("from_island"), "bins")
        guests = stay.unionByName(move).groupBy("district", "island")
        found = on_islands.groupBy("district", "island").cogroup(guests).applyInPandas(_living(capacity, epoch), _SOLUTION)
    elites = cut(found)
    best = elites.groupBy("district").agg(F.max_by("bins", F.struct(-F.col("n_bins"), "fill", -F.col("island"))).alias("bins"))

    def assign(key: tuple, rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        rows = _sorted(rows)
        rows["bin"] = np.asarray(chosen["bins"].iloc[0], np.int64)
        rows["offset"] = rows.groupby("bin")["length"].cumsum() - rows["length"]
        rows["filled"] = rows.groupby("bin")["length"].transform("sum")
        return rows

    schema = f"{_PIECE}, district bigint, bin bigint, offset bigint, filled bigint"
    return dealt.groupBy("district").cogroup(best.groupBy("district")).applyInPandas(assign, schema)


def pack(found: DataFrame, capacity: int = CAPACITY, district: int = DISTRICT) -> DataFrame:
    """``pieces`` with sequence_id and offset; sequence ids count from the round and district."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = cut(found.select(F.col("doc_id").cast("string"), *columns[1:]))
    whole = found.where(F.col("length") == capacity)
    packed = whole.select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    loose, count, step = found.where(F.col("length") < capacity), 0, 0
    count = loose.count()
    while count:
        districts = -(-count // district)
        rows = cut(pack_round(loose, districts, capacity))
        open_ = F.col("filled") < FULL * capacity
        left = rows.where(open_).count()
        last = districts == 1 or 2 * left > count  # what does not shrink is as full as its sizes allow
        done = rows if last else rows.where(~open_)
        number = F.lit(step << 56) + F.col("district") * (1 << 24) + F.col("bin")
        packed = packed.unionByName(done.select(*columns, number.alias("sequence_id"), "offset"))
        loose, count, step = rows.where(open_).select(*columns), 0 if last else left, step + 1
    return packed.withColumn("doc_id", F.col("doc_id").cast("bigint"))
