"""Mixing sources to target weights by balanced sampling (the cube method).

Sources get targets in words: shares of a budget by weight, none above ``most`` times its words, the excess reshared by
weight. A document of a source is due target / source words copies, the same for all: a whole part and a fraction, its
inclusion probability. The fractions are decided by the cube method, so that documents are drawn with just these
probabilities and the drawn words and documents of each source stay at what is due.

Flight: of any three undecided documents the probabilities can move along the null space of the two constraints (words
and documents) until one of them is 0 or 1; the direction is drawn so that every probability keeps its mean. Blocks of
``BLOCK`` documents of a source fly in parallel and leave two undecided documents each; these are dealt to blocks again
until a source has one block. Landing: ``LANDING`` documents of that block, from its longest to its shortest, wait until
the others have flown; of all roundings of them and the two left, the one is taken that keeps the documents of the source
within one and its words closest to what is due.

A block's number and every draw come from hashes of the rows, never from where a row lies, so reruns agree however the
input is partitioned. Rows that are alike in doc_id, source and text travel as one with a multiplicity and share their
copies evenly.

Edge cases: null texts and texts without words have size 0 and are drawn like others; a null source is a source of its own,
last in the order; empty tables give no rows. Documents of a null or repeated ``doc_id`` are kept apart by their texts.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.operators.numbering import numbered
from newsweave.session import cut

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BLOCK = 500
LANDING = 12
WORD = r"[^\x20\x09-\x0D]+"
_TINY = 1e-9
_FLOWN = "source string, id string, text_hash long, size long, source_size long, target double, rows long, whole long, chance double, draw long, decided boolean"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Weights repeat over the sources by code point, null last. Every source gets its weight times one level, but at most
    ``most`` times its words; the level rises by what the full ones leave until no other is full.
    """
    place = numbered(sizes, "place", F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    rows = cut(place.select("source", "source_size", weight.alias("weight")))
    limit = F.col("source_size") * most
    budget = float((rows.agg(F.sum("source_size")).first()[0] or 0) * share)
    level = 0.0
    while True:
        full = F.col("weight") * level > limit
        taken = F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0))
        room, left = rows.agg(F.sum(F.when(~full, F.col("weight"))), F.lit(budget) - taken).first()
        if not room or left / room <= level:
            return rows.select("source", "source_size", F.least(F.col("weight") * level, limit).alias("target"))
        level = left / room


def units(docs: DataFrame) -> DataFrame:
    """(source, doc_id, text_hash, size, rows): one row for all rows that are alike."""
    each = docs.select("source", "doc_id", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"))
    return each.groupBy("source", "doc_id", "text_hash", "size").agg(F.count(F.lit(1)).alias("rows"))


def fly(size: np.ndarray, chance: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move the chances, keeping their sum and the sum of size * chance, until at most two are neither 0 nor 1."""
    size, chance, held = size.tolist(), chance.tolist(), []
    for i, draw in enumerate(draws.tolist()):
        if 0.0 < chance[i] < 1.0:
            held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        move = (size[b] - size[c], size[c] - size[a], size[a] - size[b])  # orthogonal to the sizes and to (1, 1, 1)
        if not any(move):
            move = (1.0, -1.0, 0.0)  # equal sizes: any two may trade
        ahead = back = float("inf")
        for k, u in zip(held, move, strict=True):
            if u:
                up, down = (1.0 - chance[k]) / abs(u), chance[k] / abs(u)
                ahead, back = min(ahead, up if u > 0 else down), min(back, down if u > 0 else up)
        # with these odds the mean of every chance stays
        step = ahead if draw * (ahead + back) < back else -back
        for k, u in zip(held, move, strict=True):
            moved = chance[k] + step * u
            chance[k] = 0.0 if moved < _TINY else 1.0 if moved > 1.0 - _TINY else moved
        held = [k for k in held if 0.0 < chance[k] < 1.0]
    return np.array(chance)


def land(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Of all roundings of the chances still open that change their sum by less than one document, the one that changes the words least."""
    still = np.flatnonzero((chance > 0) & (chance < 1))
    tries = (np.arange(1 << len(still))[:, None] >> np.arange(len(still)) & 1) - chance[still]
    words, documents = np.abs(tries @ size[still]), np.abs(tries.sum(1))
    out = chance.copy()
    out[still] = np.round(tries[np.where(documents < 1 - _TINY, words, np.inf).argmin()] + chance[still])
    return out


def _decide(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: flight, and landing where it is the only block of its source."""
    rows = rows.sort_values(["size", "draw", "text_hash", "id"], ascending=[False, True, True, True], ignore_index=True)
    size, first = rows["size"].to_numpy(np.float64), rows.iloc[0]
    rng = np.random.default_rng([int(first["draw"]) & (2**64 - 1), len(rows), int(first["level"])])
    chance, last = rows["chance"].to_numpy(np.float64, copy=True), first["blocks"] == 1
    # documents of all lengths wait for the landing, so that there are sums of words close to what is due
    flying = np.setdiff1d(np.arange(len(rows)), np.linspace(0, len(rows) - 1, LANDING).astype(int)) if last else np.arange(len(rows))
    chance[flying] = fly(size[flying], chance[flying], rng.random(len(flying)))
    rows["chance"] = land(size, chance) if last else chance
    rows["decided"] = rows["chance"].isin([0.0, 1.0])
    return rows.drop(columns=["blocks", "level", "number"])


def _drawn(due: DataFrame, block: int) -> DataFrame:
    """``due`` with every chance decided: blocks fly, what they leave open is dealt to blocks again, the last block lands."""
    columns = [c.split()[0] for c in _FLOWN.split(", ")]
    done, left = [due.where("decided").select(columns)], cut(due.where(~F.col("decided")).select(columns))
    for level in count():
        sizes = left.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("n"))
        sizes = cut(sizes.select("name", F.ceil(F.col("n") / block).alias("blocks")))
        most = sizes.agg(F.max("blocks")).first()[0]
        if most is None:
            return reduce(DataFrame.unionByName, done)
        dealt = left.join(sizes, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        dealt = dealt.withColumns({"level": F.lit(level), "number": F.pmod(F.xxhash64("draw", F.lit(level)), F.col("blocks"))})
        flown = cut(dealt.groupBy("source", "number").applyInPandas(_decide, _FLOWN))
        done.append(flown.where("decided"))
        left = flown.where(~F.col("decided"))


def mixed_units(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """(source, doc_id, text_hash, size, source_size, target, rows, total): the copies taken of all rows that are alike."""
    kinds = cut(units(docs))
    sizes = kinds.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).cast("long").alias("source_size"))
    known = cut(source_targets(sizes, weights, share, most)).withColumnRenamed("source", "name")
    due = kinds.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    copies = F.when(F.col("source_size") > 0, F.col("rows") * F.col("target") / F.col("source_size")).otherwise(F.col("rows") * min(share, most))
    copies = F.when(F.abs(copies - F.round(copies)) < _TINY, F.round(copies)).otherwise(copies)
    due = due.withColumns({"whole": F.floor(copies), "chance": copies - F.floor(copies), "draw": F.xxhash64("source", "doc_id", "text_hash", "size", F.lit(seed))})
    due = due.withColumns({"decided": F.col("chance") == 0, "id": F.col("doc_id").cast("string")})  # a long with nulls would lose digits in pandas
    found = _drawn(due, block)
    return found.select(
        "source", F.col("id").cast(dict(kinds.dtypes)["doc_id"]).alias("doc_id"), "text_hash", "size", "source_size", "target", "rows",
        (F.col("whole") + F.col("chance").cast("long")).alias("total"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target, times: a row per row of ``docs``, taken ``times`` times. Options as of ``mixed_units``."""
    rows = mixed_units(docs, **options).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("copy"))
    times = F.floor(F.col("total") / F.col("rows")) + (F.col("copy") < F.pmod("total", "rows")).cast("long")
    return rows.select("doc_id", "source", "text_hash", "size", "source_size", "target", times.alias("times"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken; one of several alike in doc_id, source and text stands for all."""
    tag = "_".join(["mix", *docs.columns])  # a name no column has
    key = {"source": f"{tag}_source", "doc_id": f"{tag}_id", "text_hash": f"{tag}_hash"}
    taken = mixed_units(docs, **options).where("total > 0").select(*[F.col(c).alias(n) for c, n in key.items()], F.col("total").alias(tag))
    one = docs.withColumn(f"{tag}_text", F.xxhash64("text")).dropDuplicates(["source", "doc_id", f"{tag}_text"])
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("source", key["source"]), ("doc_id", key["doc_id"]), (f"{tag}_text", key["text_hash"]))]
    both = one.join(taken, reduce(Column.__and__, same))
    return both.withColumn(f"{tag}_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(tag)))).select(docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (the words the mix takes of the document), source, times."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source", "times")
