"""Entity resolution: unique names, vectors, greedy clusters, overrides and rewriting."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.functions import text as tx
from newsweave.functions import vectors as vx
from newsweave.operators.filters import drop_self_loops
from newsweave.operators.joins import replace_by_map
from newsweave.operators.numbering import numbered
from newsweave.operators.ordering import keep_one
from newsweave.operators.similarity import ROWS_PER_BLOCK, pairs_above, pairs_between
from newsweave.session import cut

FIRST_BATCH = 8192

def unique_names(edges: DataFrame, entities: DataFrame, normalize: bool = True) -> DataFrame:
    """Distinct non-null names (name, seq) ordered as first seen over all sources, then targets, then entities.

    ``seq`` is the struct (part, row) of the first sighting. With ``normalize`` honorifics are removed and
    the names that become equal are merged.
    """

    def part(df: DataFrame, column: str, number: int) -> DataFrame:
        return df.select(F.col(column).alias("name"), F.struct(F.lit(number).alias("part"), F.col("seq").alias("row")).alias("seq"))

    names = part(edges, "source", 0).unionByName(part(edges, "target", 1)).unionByName(part(entities, "entity", 2))
    raw = names.filter("name is not null").groupBy("name").agg(F.min("seq").alias("seq"))
    if not normalize:
        return raw
    return raw.select(tx.normalize_title(F.col("name")).alias("name"), "seq").groupBy("name").agg(F.min("seq").alias("seq"))


def character_grams(name: Column, size: int = 3) -> Column:
    """Overlapping character pieces of the padded lower-case name."""
    padded = F.concat(F.lit(" "), F.lower(name), F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - size + 1, F.lit(1)))
    return F.transform(starts, lambda at: F.substr(padded, at, F.lit(size)))


def name_embedding(names: DataFrame, dims: int = 256) -> DataFrame:
    """Default vectors: hashed character trigrams of unit length. Any other encoder may supply ``embedding``."""
    grams = names.withColumn("_grams", character_grams(F.col("name")))
    counted = HashingTF(inputCol="_grams", outputCol="_tf", numFeatures=dims).transform(grams)
    scaled = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(counted)
    return scaled.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_grams", "_tf", "_unit")


def letter_embedding(names: DataFrame, letters: str = "abcdefghijklmnopqrstuvwxyz0123456789 ") -> DataFrame:
    """Vectors of how often each letter stands in the lower-case name."""
    lowered = F.lower("name")
    counts = F.transform(F.array(*map(F.lit, letters)), lambda c: (F.length(lowered) - F.length(F.replace(lowered, c, F.lit("")))).cast("float"))
    return names.withColumn("embedding", counts)


def ranked_names(edges: DataFrame, entities: DataFrame, normalize: bool = True) -> DataFrame:
    """``unique_names`` with ``seq`` as one number, from 0 in the order first seen, as ``cluster_names`` takes it."""
    names = unique_names(edges, entities, normalize).withColumnRenamed("seq", "first")
    return numbered(names, "seq", F.asc("first.part"), F.asc("first.row"), F.asc("name")).select("name", "seq")


def _leaders(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """(seq) of the rows of ``reps`` (id) that no earlier leader is paired with: in rounds, those without an earlier open partner lead."""
    taken, active = None, pairs
    while not active.isEmpty():
        leading = cut(
            active.select("left_seq").distinct().join(active.select(F.col("right_seq").alias("left_seq")), "left_seq", "left_anti")
        )
        newly = cut(active.join(leading, "left_seq", "left_semi").select(F.col("right_seq").alias("seq")).distinct())
        taken = newly if taken is None else cut(taken.unionByName(newly))
        active = cut(
            active.join(newly.toDF("left_seq"), "left_seq", "left_anti").join(newly.toDF("right_seq"), "right_seq", "left_anti")
        )
    leaders = reps.select(F.col("id").alias("seq"))
    return leaders if taken is None else leaders.join(taken, "seq", "left_anti")


def cluster_names(vectors: DataFrame, threshold: float = 0.88, rows_per_block: int = ROWS_PER_BLOCK, first_batch: int = FIRST_BATCH) -> DataFrame:
    """Greedy leader clusters (alias, canonical, is_leader) over (name, seq, embedding).

    Names are taken in order; one that no earlier leader is similar to leads, and a name similar to several
    leaders goes to the last of them. The leaders are the lexicographically first maximal independent set of
    the similarity graph. They are found batch by batch, each as large as all before it: a batch first meets the leaders so
    far, and only the names that none of them is similar to are paired with each other, so that a large cluster makes
    no pairs beyond the batch it begins in. Names with equal vectors have equal neighbours, so only the first of them takes part.
    """
    # a zero vector is similar to nothing, not even to its copies
    own_key = F.when(vx.norm(F.col("embedding")) == 0, F.col("seq")).otherwise(F.lit(-1))
    keyed = vectors.select("name", "seq", "embedding", own_key.alias("_zero"))
    firsts = cut(keyed.groupBy("embedding", "_zero").agg(F.min("seq").alias("rep")))
    names = cut(keyed.join(firsts, ["embedding", "_zero"]).select("name", "seq", "rep"))
    reps, total = firsts.select(F.col("rep").alias("id"), "embedding"), firsts.count()
    if total > first_batch:
        reps = cut(numbered(reps, "place", F.asc("id")))

    leaders, done = None, 0
    while leaders is None or done < total:
        batch = reps if total <= first_batch else reps.where(F.col("place").between(done, max(2 * done, first_batch) - 1)).drop("place")
        if leaders is not None:
            led = pairs_between(batch, leaders, threshold, rows_per_block).select(F.col("a").alias("id")).distinct()
            batch = cut(batch.join(led, "id", "left_anti"))
        pairs = cut(pairs_above(batch, threshold, rows_per_block).select(F.col("a").alias("left_seq"), F.col("b").alias("right_seq")))
        new = batch.join(_leaders(batch, pairs).toDF("id"), "id", "left_semi")
        leaders = cut(new if leaders is None else leaders.unionByName(new))
        done = max(2 * done, first_batch)

    # leaders similar to each representative, itself included when it leads
    itself = leaders.select(F.col("id").alias("rep"), F.col("id").alias("leader"))
    if total <= first_batch:
        both = pairs.toDF("rep", "leader").unionByName(pairs.toDF("leader", "rep"))
        near = both.join(itself.select("leader"), "leader", "left_semi").unionByName(itself)
    else:
        near = pairs_between(reps.drop("place"), leaders, threshold, rows_per_block).select(F.col("a").alias("rep"), F.col("b").alias("leader"))
        near = near.unionByName(itself).distinct()
    # leaders are not similar to each other, so few of them surround a name
    lists = near.groupBy("rep").agg(F.collect_list("leader").alias("leaders"))
    last = F.array_max(F.filter("leaders", lambda leader: leader <= F.col("seq")))
    chosen = names.join(lists, "rep").select("seq", F.col("name").alias("alias"), last.alias("leader"))
    titles = names.select(F.col("seq").alias("leader"), F.col("name").alias("canonical"))
    return chosen.join(titles, "leader").select("alias", "canonical", (F.col("leader") == F.col("seq")).alias("is_leader"))


def build_resolution_map(clusters: DataFrame, overrides: DataFrame) -> DataFrame:
    """(alias, canonical): cluster results, replaced or extended by hand-made corrections, as a written table."""
    ranked = clusters.select("alias", "canonical", F.lit(0).alias("rank")).unionByName(
        overrides.select("alias", "canonical", F.lit(1).alias("rank"))
    )
    return cut(ranked.groupBy("alias").agg(F.max_by("canonical", "rank").alias("canonical")))


def follow_chains(mapping: DataFrame) -> DataFrame:
    """Mapping followed to its end, however long; a name met again on the way stops the walk.

    Each round doubles the steps made, so chains end after the logarithm of their length. Only names that run into a
    cycle are walked step by step.
    """
    mapping = cut(mapping.select("alias", "canonical"))
    current = mapping
    for _ in range(mapping.count().bit_length()):
        ahead = current.select(F.col("alias").alias("canonical"), F.col("canonical").alias("_next"))
        end = F.coalesce("_next", "canonical")
        current = cut(current.join(ahead, "canonical", "left").select("alias", end.alias("canonical"), (end != F.col("canonical")).alias("moved")))
        if current.filter("moved").isEmpty():
            break
    step = mapping.select(F.col("alias").alias("canonical"), F.col("canonical").alias("_next"))
    cyclic = current.join(step, "canonical").filter("_next <> canonical").select("alias")
    ended = current.join(cyclic, "alias", "left_anti").select("alias", "canonical")
    walked = cut(mapping.join(cyclic, "alias", "left_semi").withColumn("path", F.array("alias", "canonical")))
    while not walked.isEmpty():
        moved = walked.join(step, "canonical", "left")
        free = F.col("_next").isNotNull() & ~F.array_contains("path", F.col("_next"))
        walked = cut(
            moved.select(
                "alias",
                F.when(free, F.col("_next")).otherwise(F.col("canonical")).alias("canonical"),
                F.when(free, F.array_append("path", F.col("_next"))).otherwise(F.col("path")).alias("path"),
                free.alias("moved"),
            )
        )
        done = walked.filter("NOT moved").select("alias", "canonical")
        ended, walked = ended.unionByName(done), walked.filter("moved").drop("moved")
    return ended


def apply_resolution(
    df: DataFrame, columns: list[str], mapping: DataFrame, normalize_before_lookup: bool = False, transitive: bool = False
) -> DataFrame:
    """Rewrite name columns through the map.

    By default raw names are looked up although the keys are normalised, and one hop is made: titled names
    stay. ``normalize_before_lookup`` and ``transitive`` change either rule.
    """
    if transitive:
        mapping = follow_chains(mapping)
    if normalize_before_lookup:
        df = df.withColumns({c: tx.normalize_title(F.col(c)) for c in columns})
    return replace_by_map(df, columns, mapping)


def clean_resolved(edges: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct edges without loops or missing ends; first entity row per (url, entity)."""
    return drop_self_loops(edges.drop("seq").distinct()), keep_one(entities, ["url", "entity"])
