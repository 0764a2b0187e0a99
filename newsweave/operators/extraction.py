"""Extraction as a batch job: prompts, a pluggable extractor, reply parsing, exploding and a dictionary extractor."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.functions import nested as nx
from newsweave.functions import text as tx
from newsweave.operators.filters import nonblank_text
from newsweave.session import cut

Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
RESPONSE_SCHEMA = "url string, response_text string, error string"
SHORT_LEXICON = 1000


def with_prompts(articles: DataFrame) -> DataFrame:
    """Prompt per article with text; blank articles produce no row."""
    return nonblank_text(articles).select("url", "text", tx.build_prompt(F.col("text")).alias("prompt"))


def call_each(call: Callable[[str], str], pause: float = 1.0, retry_wait: float = 60.0) -> Extractor:
    """Extractor around a one-prompt call: a pause per row and one retry for rate-limit failures only."""

    def attempt(prompt: str) -> tuple[str | None, str | None]:
        try:
            return call(prompt).strip(), None
        except Exception as failure:  # any failure of the remote call becomes an error row
            message = str(failure)
        if not any(sign in message.lower() for sign in tx.RATE_LIMIT_SIGNS):
            return None, message
        time.sleep(retry_wait)
        try:
            return call(prompt).strip(), None
        except Exception as failure:
            return None, str(failure)

    def extractor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies = []
            for prompt in batch["prompt"]:
                replies.append(attempt(prompt))
                time.sleep(pause)
            yield pd.DataFrame(
                {"url": batch["url"], "response_text": [r[0] for r in replies], "error": [r[1] for r in replies]}
            )

    return extractor


def extract(articles: DataFrame, extractor: Extractor, max_partitions: int | None = None) -> DataFrame:
    """(url, response_text, error) per article with text; ``max_partitions`` bounds the concurrent callers."""
    prompts = with_prompts(articles)
    if max_partitions:
        prompts = prompts.repartition(max_partitions)
    return prompts.select("url", "prompt").mapInPandas(extractor, RESPONSE_SCHEMA)


def parse_responses(responses: DataFrame) -> DataFrame:
    """url, extracted_entities, entity_relationships (JSON text) and error.

    A missing field gives its empty default; a reply that cannot be read gives an error and empty fields.
    """
    block = tx.json_block(F.col("response_text"))
    # as the only element of a list: anything behind the object makes the whole unreadable
    strict = {"allowSingleQuotes": "false"}
    listed = F.from_json(F.concat(F.lit("["), block, F.lit("]")), "array<map<string,string>>", strict)
    parsed = F.when(F.size(listed) == 1, listed[0])

    def last(key: str) -> Column:
        """The value of a key; of repeated keys the last one counts."""
        values = F.filter(F.map_entries("parsed"), lambda e: e["key"] == key)
        return F.try_element_at(values, F.lit(-1))["value"]

    replied = F.coalesce(F.col("response_text") != "", F.lit(False))
    error = (
        F.when(~replied, F.col("error"))
        .when(F.col("block").isNull(), F.lit("no JSON object in the reply"))
        .when(F.col("parsed").isNull(), F.lit("the reply is not valid JSON"))
    )
    return (
        responses.withColumn("block", block)
        .withColumn("parsed", parsed)
        .select(
            *[c for c in responses.columns if c not in ("response_text", "error")],
            F.coalesce(last("entities"), F.lit("{}")).alias("extracted_entities"),
            F.coalesce(last("entity_relationships"), F.lit("[]")).alias("entity_relationships"),
            error.alias("error"),
        )
    )


def extraction_errors(parsed: DataFrame) -> DataFrame:
    """Error rows and whether each was a rate limit."""
    return parsed.filter("error is not null").select("url", "error", tx.is_rate_limit(F.col("error")).alias("rate_limited"))


def extraction_results(parsed: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Result rows; failed articles count as done (with empty fields) unless they are to be retried."""
    kept = parsed.filter("error is null") if retry_failed else parsed
    return kept.select("url", "extracted_entities", "entity_relationships")


def parse_nested(df: DataFrame) -> DataFrame:
    """Text cells turned into native columns, empty where unreadable.

    ``entities`` keeps every category, with a null list where the value was no list.
    """
    return df.withColumns(
        {
            "entities": nx.entity_lists(F.col("extracted_entities")),
            "relationships": nx.relationship_maps(F.col("entity_relationships")),
        }
    )


def explode_relationships(parsed: DataFrame, key: str = "url", date: str = "date") -> DataFrame:
    """One edge per list element that has all four keys; ``seq`` is (article order, position)."""
    # the outer form: for the plain one the planner adds a filter that parses every cell again
    exploded = parsed.select(F.col("seq").alias("_article"), key, date, F.posexplode_outer("relationships").alias("position", "element"))
    return exploded.filter(nx.has_relationship_keys(F.col("element"))).select(
        *[F.col("element")[k].alias(k) for k in nx.RELATIONSHIP_KEYS],
        key,
        date,
        F.struct(F.col("_article").alias("article"), F.col("position")).alias("seq"),
    )


def explode_entities(parsed: DataFrame, key: str = "url", date: str = "date") -> DataFrame:
    """One row per (category, name); a category that is not a list is skipped."""
    categories = parsed.select(F.col("seq").alias("_article"), key, date, F.posexplode_outer("entities").alias("_place", "entity_type", "_names"))
    return categories.select("*", F.posexplode("_names").alias("_at", "entity")).select(
        key, date, "entity", "entity_type", F.struct(F.col("_article").alias("article"), F.col("_place"), F.col("_at")).alias("seq")
    )


def entity_features(parsed: DataFrame) -> DataFrame:
    """entity_count, entity_to_word_ratio (null without words) and mentions_organizations; needs ``text``."""
    words = tx.word_count(F.col("text"))
    total = nx.entity_total(F.col("entities"))
    return parsed.withColumns(
        {
            "entity_count": total,
            "entity_to_word_ratio": total / F.when(words > 0, words),
            "mentions_organizations": nx.mentions_organizations(F.col("entities")),
        }
    )


def count_lexicon(articles: DataFrame, lexicon: DataFrame, tag: str = "VERB", key: str = "seq") -> DataFrame:
    """(key, count) of tokens carrying the tag.

    A lexicon measured to be short becomes a set test inside the scan; a longer one is joined, after counting
    equal tokens within each article.
    """
    words = lexicon.filter(F.col("tag") == tag).select(F.lower("token").alias("token")).distinct()
    head = [r["token"] for r in words.limit(SHORT_LEXICON + 1).collect()]
    if len(head) <= SHORT_LEXICON:
        return articles.select(key, tx.lexicon_count(F.col("text"), head).alias("count"))
    counted = (
        articles.select(key, F.explode(tx.tokens(F.lower("text"))).alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))
    )
    hits = counted.join(cut(words), "token").groupBy(key).agg(F.sum("n").alias("count"))
    return articles.select(key).join(hits, key, "left").select(key, F.coalesce("count", F.lit(0)).cast("int").alias("count"))


#: Gives the tags of the tokens of each text of a batch.
Tagger = Callable[[Sequence[str]], Sequence[Sequence[str]]]
_started: dict[str, Tagger] = {}


def count_tags(articles: DataFrame, name: str, start: Callable[[], Tagger], tag: str = "VERB", key: str = "seq", texts_per_batch: int = 500) -> DataFrame:
    """(key, count) of tokens with the tag, by any tagger.

    ``start`` makes the tagger, loading what it needs; each Python worker calls it once for each ``name`` and keeps it for the tasks
    it runs later. The tagger gets whole texts, ``texts_per_batch`` at most at a time. A null text has no tokens.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _started:
            _started[name] = start()
        for batch in batches:
            for lo in range(0, len(batch), texts_per_batch):
                part = batch.iloc[lo : lo + texts_per_batch]
                tags = _started[name](["" if text is None else text for text in part["text"]])
                yield pd.DataFrame({key: part[key], "count": [sum(t == tag for t in own) for own in tags]})

    return articles.select(key, "text").mapInPandas(count, f"{key} {dict(articles.dtypes)[key]}, count int")


def lexicon_tagger(lexicon: Sequence[tuple[str, str]]) -> Callable[[], Tagger]:
    """Start of a tagger that looks lower-case tokens up; unknown ones have the tag ``X``."""

    def start() -> Tagger:
        tags = {token.lower(): tag for token, tag in lexicon}
        return lambda texts: [[tags.get(token, "X") for token in text.lower().split()] for text in texts]

    return start


BREAK = rf"{tx.UNICODE}[{tx.SPACE}.,;:!?\"()\[\]]+"


def sentence_words(articles: DataFrame) -> DataFrame:
    """(url, seq, sentence, words): lower-case words per sentence; sentences end at . ! ? or a line break."""
    sentences = articles.select("url", "seq", F.posexplode(F.split(F.lower("text"), r"[.!?\n]+")).alias("sentence", "body"))
    words = F.filter(F.split("body", BREAK), lambda word: word != "")
    return sentences.select("url", "seq", "sentence", words.alias("words"))


def mentions_in(words: Column, gazetteer: Sequence[tuple[str, str]]) -> Column:
    """Array of (position, size, entity) in a word array: every place of every dictionary entry, whatever its number of words."""
    by_size: dict[int, list[str]] = {}
    for surface in sorted({" ".join(surface.lower().split()) for surface, _ in gazetteer}):
        by_size.setdefault(len(surface.split(" ")), []).append(surface)

    def places(size: int) -> Column:
        """Positions whose word begins an entry; the rest is never looked at again."""
        last = F.size(words) - (size - 1)
        at = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        heads = sorted({surface.split(" ")[0] for surface in by_size[size]})
        return F.filter(at, lambda i: F.element_at(words, i).isin(heads))

    def found(size: int) -> Column:
        entries = F.transform(
            places(size),
            lambda i: F.struct(
                i.alias("position"), F.lit(size).alias("size"), F.concat_ws(" ", *[F.element_at(words, i + j) for j in range(size)]).alias("entity")
            ),
        )
        return entries if size == 1 else F.filter(entries, lambda m: m["entity"].isin(by_size[size]))

    none = F.array().cast("array<struct<position:int,size:int,entity:string>>")
    return F.concat(none, *[found(size) for size in by_size])


def gazetteer_mentions(articles: DataFrame, gazetteer: Sequence[tuple[str, str]]) -> DataFrame:
    """Mentions (url, seq, sentence, position, entity, entity_type) of dictionary entries of any number of words.

    The dictionary is a parameter list, so it travels with the plan and no article text is shuffled.
    """
    parts = [F.lit(part) for surface, kind in gazetteer for part in (" ".join(surface.lower().split()), kind)]
    table = F.create_map(*parts) if parts else F.expr("cast(map() as map<string,string>)")
    found = sentence_words(articles).select("url", "seq", "sentence", F.explode(mentions_in(F.col("words"), gazetteer)).alias("m"))
    return found.select("url", "seq", "sentence", "m.position", "m.entity", table[F.col("m.entity")].alias("entity_type"))


def gazetteer_entities(articles: DataFrame, gazetteer: Sequence[tuple[str, str]]) -> DataFrame:
    """Entities of the dictionary per article with their number of mentions."""
    return gazetteer_mentions(articles, gazetteer).groupBy("url", "seq", "entity", "entity_type").agg(F.count(F.lit(1)).alias("mentions"))


def _steps(names: Column) -> Column:
    """Each name with the one that follows; the last has none."""
    return nx.bound(
        names, lambda n: F.zip_with(n, F.slice(n, F.lit(2), F.size(n)), lambda one, other: F.struct(one.alias("source"), other.alias("target")))
    )


def cooccurrence_edges(
    articles: DataFrame, gazetteer: Sequence[tuple[str, str]], relationship: str = "partners with", sentiment: str = "NEUTRAL"
) -> DataFrame:
    """Edges between successive, different mentions of a sentence, with the number of times each occurs.

    Mentions follow each other by their first word, shorter ones first. Linking neighbours only keeps the output
    linear in the number of mentions.
    """
    found = nx.bound(F.array_sort(mentions_in(F.col("words"), gazetteer)), lambda m: _steps(F.transform(m, lambda x: x["entity"])))
    return (
        sentence_words(articles).select("url", "seq", F.explode_outer(found).alias("s"))
        .select("url", "seq", "s.source", "s.target")
        .filter("source <> target")
        .groupBy("url", "seq", "source", "target")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"relationship": F.lit(relationship), "sentiment": F.lit(sentiment)})
    )


def gazetteer_extractor(gazetteer: Sequence[tuple[str, str]]) -> Callable[[DataFrame], DataFrame]:
    """Default extraction without any model: replies (url, response_text, error) with the agreed JSON fields."""

    def run(articles: DataFrame) -> DataFrame:
        kept = nonblank_text(articles)
        found = gazetteer_entities(kept, gazetteer).groupBy("url", "seq", "entity_type").agg(F.sort_array(F.collect_set("entity")).alias("names"))
        entities = found.groupBy("url", "seq").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("entity_type", "names")))).alias("entities"))
        linked = cooccurrence_edges(kept, gazetteer)
        relations = linked.groupBy("url", "seq").agg(
            F.sort_array(F.collect_list(F.struct("source", "target", "relationship", "sentiment"))).alias("entity_relationships")
        )
        joined = kept.select("url", "seq").join(entities, ["url", "seq"], "left").join(relations, ["url", "seq"], "left")
        return joined.select(
            "url", F.to_json(F.struct("entities", "entity_relationships")).alias("response_text"), F.lit(None).cast("string").alias("error")
        )

    return run
