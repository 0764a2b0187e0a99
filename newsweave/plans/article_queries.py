"""Queries over the article tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsweave.functions import dates as dx
from newsweave.functions import text as tx
from newsweave.operators import aggregates as ag
from newsweave.operators import extraction as ex
from newsweave.operators import filters as fl
from newsweave.operators.joins import pending
from newsweave.operators.ordering import duplicate_count, duplicate_rows, keep_one, top
from newsweave.plans.fixture_sql import ARTICLES, PUBLISHER, quote, with_
from newsweave.plans.views import article_features
from newsweave.session import work_path
from newsweave.sources import fixtures as fx
from newsweave.sources import tables as tb

FLAGS = ["is_us_election", "is_french_election", "is_german_election"]
KINDS = (("thand", "analysis"), ("ander", "interview"))


def english(spark, sf, heavy=False, text=None):
    return fl.language_is(fx.articles(spark, sf, heavy, text))


def unfilled(spark, sf):
    """English articles for counting nulls: an empty text stands for any text."""
    return english(spark, sf, text=ag.presence("text"))


def latest(spark, sf, *columns):
    """Some columns of the latest row per address: the others, the text above all, are not moved."""
    return keep_one(english(spark, sf).select("seq", "url", *columns), ["url"], "seq", "last")


def article_lengths(spark, sf):
    """Words per article, counted before the latest rows are picked so that no text is shuffled."""
    counted = english(spark, sf, heavy=True, text=tx.text_length(F.col("text")))
    return keep_one(counted.select("seq", "url", F.col("text").alias("words")), ["url"], "seq", "last")


def published(spark, sf):
    found = latest(spark, sf, "relevance_text", "datetime")
    return found.withColumns({"publisher": tx.publisher(F.col("url")), "date": F.to_date("datetime")})


def flag_union(spark, sf):
    whole = fx.articles(spark, sf)
    us = tb.flag_source(whole.filter("is_us_election = 1").drop(*FLAGS), {FLAGS[0]: 1, FLAGS[1]: 0, FLAGS[2]: 0})
    french = tb.flag_source(whole.filter("is_french_election = 1").drop(*FLAGS), {FLAGS[0]: 0, FLAGS[1]: 1, FLAGS[2]: 0})
    return tb.stack_tables([us, french]).select("seq", "url", "language", *FLAGS)


def copies(spark, sf):
    return fx.articles(spark, sf).select("text", "language", "is_us_election")


def url_variants(spark, sf):
    """Article URLs and rarer shapes of them."""
    kind, url = F.col("seq") % 6, F.col("url")
    shaped = (
        F.when(kind == 1, F.replace(url, F.lit("://"), F.lit("://Ann:pw@")))
        .when(kind == 2, F.regexp_replace(url, "^[a-z]+:", ""))
        .when(kind == 3, F.regexp_replace(url, "^[a-z]+://", ""))
        .when(kind == 4, F.regexp_replace(url, r"(\.example\.[a-z]+)", "$1:8080"))
        .when(kind == 5, F.upper(url))
        .otherwise(url)
    )
    return fx.articles(spark, sf).select("seq", F.when(F.col("seq") % 40 != 0, shaped).alias("url"))


def some_text(spark, sf):
    return with_odd_texts(fx.texts(spark, sf))


def with_odd_texts(articles):
    """Texts with nulls, and odd blanks added to some."""
    odd = F.concat("text", F.lit(" x y\u0085z​w "))
    text = F.when(F.col("seq") % 50 == 0, F.lit(None)).when(F.col("seq") % 7 == 0, odd).otherwise(F.col("text"))
    return articles.withColumn("text", text)


SOME_TEXT = """some_text AS (
  SELECT seq, url, CASE WHEN seq % 50 = 0 THEN NULL
    WHEN seq % 7 = 0 THEN text || chr(160) || 'x' || chr(8195) || 'y' || chr(133) || 'z' || chr(8203) || 'w ' ELSE text END AS text
  FROM articles
)"""
BLANK = r"\s\x0b\x1c-\x1f\x{85}\pZ"


def token_sql(text: str) -> str:
    return f"regexp_extract_all({text}, '[^{BLANK}]+')"



def features(spark, sf):
    lexicon = spark.createDataFrame(fx.LEXICON, "token string, tag string")
    df = article_features(fx.articles(spark, sf, heavy=True), lexicon, fx.KEYWORDS, KINDS)
    return df.select(
        "seq", "news_org", "date", "day_of_week", "month", "is_weekend", "days_until_us_election",
        "days_until_french_election", "word_count", "verb_count", "mentions_election_keywords", "language", "article_type",
    )


def date_features(spark, sf):
    """Calendar columns from timestamps kept as text, some of them unreadable."""
    text = F.when(F.col("seq") % 13 == 0, F.lit("not a date")).otherwise(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    ts = dx.parse_lenient(F.col("stamp"))
    return (
        fx.articles(spark, sf)
        .select("seq", text.alias("stamp"))
        .select(
            "seq",
            dx.calendar_date(ts).alias("date"),
            dx.day_name(ts).alias("day_of_week"),
            F.month(ts).alias("month"),
            dx.is_weekend(ts).alias("is_weekend"),
        )
    )


def csv_roundtrip(spark, sf):
    """Article rows written as CSV (texts hold line breaks and quotes) and read back."""
    path = work_path(spark, "csv")
    tb.write_csv(fx.articles(spark, sf).select("seq", "url", "text", "relevance_text"), path)
    return tb.read_csv(spark, path, "seq bigint, url string, text string, relevance_text int")


def appended_results(spark, sf):
    """Two batches appended to one table, with a stamped copy of each."""
    rows = fx.articles(spark, sf).select("seq", "url", "is_us_election")
    path = work_path(spark, "results")
    for flag, stamp in ((1, "20240601_0000"), (0, "20240601_0005")):
        batch = rows.filter(F.col("is_us_election") == flag).select("seq", "url")
        tb.append_results(batch, f"{path}/master")
        tb.snapshot(batch, f"{path}/backups", stamp)
    kept = tb.load_parquet(spark, f"{path}/backups").select("seq", F.col("batch_stamp").cast("string").alias("batch_stamp"))
    return tb.load_parquet(spark, f"{path}/master").join(kept, "seq").select("seq", "url", "batch_stamp")


QUERIES = {
    "flag_union": flag_union,
    "filter_lang": lambda s, d: english(s, d).select("seq", "url", "language"),
    "relevant_only": lambda s, d: fl.relevant_only(fx.articles(s, d)).select("seq", "url", "relevance_text"),
    "label_queue": lambda s, d: fl.label_queue(fx.articles(s, d)).select("seq", "url"),
    "column_counts": lambda s, d: ag.column_counts(unfilled(s, d)),
    "value_counts": lambda s, d: ag.value_counts(fx.articles(s, d), "language"),
    "value_ratios": lambda s, d: ag.value_ratios(
        latest(s, d, "relevance_description"), "relevance_description"
    ).withColumn("ratio", F.round("ratio", 6)),
    "publisher_nunique": lambda s, d: ag.distinct_count(published(s, d), "publisher"),
    "publisher_counts": lambda s, d: ag.value_counts(published(s, d), "publisher"),
    "null_profile": lambda s, d: ag.null_profile(keep_one(unfilled(s, d), ["url"], "seq", "last")),
    "duplicate_count": lambda s, d: duplicate_count(copies(s, d)),
    "duplicate_rows": lambda s, d: duplicate_rows(copies(s, d)),
    "relevance_by_publisher": lambda s, d: ag.mean_by(published(s, d), "publisher", "relevance_text")
    .withColumn("mean", F.round("mean", 6))
    .orderBy(F.desc("mean"), "publisher"),
    "daily_relevance": lambda s, d: ag.mean_by(published(s, d), "date", "relevance_text").withColumn("mean", F.round("mean", 6)),
    "spike_days": lambda s, d: top(ag.mean_by(published(s, d), "date", "relevance_text"), 10, F.desc("mean"), F.col("date")).withColumn(
        "mean", F.round("mean", 6)
    ),
    "relevant_share_by_flag": lambda s, d: ag.share_of_all(latest(s, d, "relevance_text", *FLAGS[:2]), FLAGS[:2]).withColumn("ratio", F.round("ratio", 6)),
    "length_histogram": lambda s, d: ag.histogram(article_lengths(s, d), "words", 500),
    "dedupe_keep_last": lambda s, d: keep_one(english(s, d).select("seq", "url", "relevance_text"), ["url"], "seq", "last"),
    "publisher": lambda s, d: url_variants(s, d).select("seq", tx.publisher(F.col("url")).alias("publisher")),
    "word_count": lambda s, d: some_text(s, d).select(
        "seq", tx.word_count(F.col("text")).alias("word_count"), tx.text_length(F.col("text")).alias("text_length")
    ),
    "keyword_flag": lambda s, d: some_text(s, d).select("seq", tx.mentions_any(F.col("text"), fx.KEYWORDS).alias("mentioned")),
    "article_type": lambda s, d: some_text(s, d).select("seq", tx.article_type(F.col("text"), KINDS).alias("article_type")),
    "date_features": date_features,
    "days_until": lambda s, d: fx.articles(s, d).select(
        "seq",
        dx.days_until(F.col("datetime"), dx.US_ELECTION).alias("days_until_us_election"),
        dx.days_until(F.col("datetime"), dx.FRENCH_ELECTION).alias("days_until_french_election"),
    ),
    "build_prompt": lambda s, d: ex.with_prompts(with_odd_texts(fx.articles(s, d, heavy=True))).select("url", "prompt"),
    "lexicon_count": lambda s, d: ex.count_lexicon(some_text(s, d), s.createDataFrame(fx.LEXICON, "token string, tag string")),
    "tagged_counts": lambda s, d: ex.count_tags(some_text(s, d), "lexicon", ex.lexicon_tagger(fx.LEXICON)),
    "article_features": features,
    "pending_articles": lambda s, d: pending(
        fx.articles(s, d).select("seq", "url"), fx.articles(s, d).filter("relevance_description is not null").select("url")
    ).select("seq", "url"),
    "gazetteer_entities": lambda s, d: ex.gazetteer_entities(fx.articles(s, d, heavy=True), fx.GAZETTEER),
    "cooccurrence_edges": lambda s, d: ex.cooccurrence_edges(fx.articles(s, d, heavy=True), fx.GAZETTEER),
    "csv_roundtrip": csv_roundtrip,
    "appended_results": appended_results,
}

COLUMNS = ["seq", "url", "text", "datetime", "language", "relevance_text", "relevance_description", *FLAGS]
VERBS = "[" + ", ".join(quote(token) for token, tag in fx.LEXICON if tag == "VERB") + "]"
SURFACES = "[" + ", ".join(quote(surface) for surface, _ in fx.GAZETTEER) + "]"
MENTION_TYPE = "CASE entity " + " ".join(f"WHEN {quote(s)} THEN {quote(k)}" for s, k in fx.GAZETTEER) + " END"
KEYWORD_TEST = f"coalesce(regexp_matches(text, '(?i)({'|'.join(fx.KEYWORDS)})'), false)"
TYPE_CASE = f"CASE WHEN contains(lower(text), '{KINDS[0][0]}') THEN '{KINDS[0][1]}' WHEN contains(lower(text), '{KINDS[1][0]}') THEN '{KINDS[1][1]}' ELSE 'other' END"


def _days(day: str) -> str:
    return f"CAST(floor((epoch_us(TIMESTAMP '{day} 00:00:00') - epoch_us(datetime)) / CAST(86400000000 AS DOUBLE)) AS INTEGER)"


PUBLISHED = f"published AS (SELECT *, {PUBLISHER.format('url')} AS publisher, CAST(datetime AS DATE) AS date FROM uniq)"
SENTENCES = r"""sentences AS (
  SELECT url, seq, unnest(regexp_split_to_array(lower(text), '[.!?\n]+')) AS body,
         generate_subscripts(regexp_split_to_array(lower(text), '[.!?\n]+'), 1) AS sentence
  FROM articles
), worded AS (
  SELECT url, seq, sentence, regexp_extract_all(body, '[^\s\x0b\x1c-\x1f\x{85}\pZ.,;:!?"()\[\]]+') AS words FROM sentences
)"""
VERB_COUNTS = f"""SELECT seq, CAST(coalesce(len(list_filter({token_sql('lower(text)')}, lambda t: list_contains({VERBS}, t))), 0) AS INTEGER)
  AS count FROM some_text"""
# the entries of the dictionary per sentence, in order
MENTIONED = f""", named AS (
  SELECT url, seq, list(entity ORDER BY i, n) AS names FROM (
    SELECT url, seq, sentence, i, 1 AS n, words[i] AS entity FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM worded)
    UNION ALL
    SELECT url, seq, sentence, i, 2 AS n, words[i] || ' ' || words[i + 1] AS entity FROM (SELECT *, unnest(range(1, len(words))) AS i FROM worded)
  ) WHERE list_contains({SURFACES}, entity) GROUP BY url, seq, sentence
)"""

ORACLE = {
    "flag_union": with_(ARTICLES) + f"SELECT seq, url, language, {', '.join(FLAGS)} FROM articles",
    "filter_lang": with_(ARTICLES) + "SELECT seq, url, language FROM articles WHERE language = 'en'",
    "relevant_only": with_(ARTICLES) + "SELECT seq, url, relevance_text FROM articles WHERE relevance_text = 1",
    "label_queue": with_(ARTICLES) + "SELECT seq, url FROM articles WHERE relevance_text IS NULL",
    "column_counts": with_(ARTICLES)
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n FROM english" for c in COLUMNS),
    "value_counts": with_(ARTICLES) + "SELECT language AS value, count(*) AS n FROM articles WHERE language IS NOT NULL GROUP BY 1",
    "value_ratios": with_(ARTICLES)
    + """SELECT relevance_description AS value, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS ratio
FROM uniq WHERE relevance_description IS NOT NULL GROUP BY 1""",
    "publisher_nunique": with_(ARTICLES, PUBLISHED) + "SELECT count(DISTINCT publisher) AS n FROM published",
    "publisher_counts": with_(ARTICLES, PUBLISHED)
    + "SELECT publisher AS value, count(*) AS n FROM published WHERE publisher IS NOT NULL GROUP BY 1",
    "null_profile": with_(ARTICLES)
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n FROM uniq" for c in COLUMNS),
    "duplicate_count": with_(ARTICLES)
    + """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM articles GROUP BY text, language, is_us_election)""",
    "duplicate_rows": with_(ARTICLES)
    + """SELECT text, language, is_us_election FROM articles
QUALIFY count(*) OVER (PARTITION BY text, language, is_us_election) > 1""",
    "relevance_by_publisher": with_(ARTICLES, PUBLISHED)
    + "SELECT publisher, round(avg(relevance_text), 6) AS mean FROM published WHERE publisher IS NOT NULL GROUP BY 1",
    "daily_relevance": with_(ARTICLES, PUBLISHED)
    + "SELECT date, round(avg(relevance_text), 6) AS mean FROM published WHERE date IS NOT NULL GROUP BY 1",
    "spike_days": with_(ARTICLES, PUBLISHED)
    + """SELECT date, round(mean, 6) AS mean FROM (
  SELECT date, avg(relevance_text) AS mean FROM published WHERE date IS NOT NULL GROUP BY 1
  ORDER BY mean DESC NULLS LAST, date LIMIT 10)""",
    "relevant_share_by_flag": with_(ARTICLES)
    + " UNION ALL ".join(
        f"SELECT '{f}' AS flag, round(sum(CASE WHEN relevance_text = 1 THEN {f} ELSE 0 END) / CAST(count(*) AS DOUBLE), 6) AS ratio FROM uniq"
        for f in FLAGS[:2]
    ),
    "length_histogram": with_(ARTICLES, f"lengths AS (SELECT len({token_sql('text')}) AS words FROM uniq WHERE text IS NOT NULL)")
    + """, bins AS (SELECT greatest(CAST(ceil(max(words) / 500.0) AS BIGINT), 1) AS b FROM lengths)
SELECT CAST(i * 500 AS BIGINT) AS bin_start, CAST((i + 1) * 500 AS BIGINT) AS bin_end,
       (SELECT count(*) FROM lengths WHERE least(words // 500, b - 1) = i) AS n
FROM (SELECT unnest(range(0, b)) AS i, b FROM bins)""",
    "dedupe_keep_last": with_(ARTICLES) + "SELECT seq, url, relevance_text FROM uniq",
    "publisher": with_(ARTICLES)
    + f"""SELECT seq, {PUBLISHER.format('u')} AS publisher FROM (
  SELECT seq, CASE WHEN seq % 40 = 0 THEN NULL ELSE CASE seq % 6
    WHEN 1 THEN replace(url, '://', '://Ann:pw@')
    WHEN 2 THEN regexp_replace(url, '^[a-z]+:', '')
    WHEN 3 THEN regexp_replace(url, '^[a-z]+://', '')
    WHEN 4 THEN regexp_replace(url, '(\\.example\\.[a-z]+)', '\\1:8080', 'g')
    WHEN 5 THEN upper(url) ELSE url END END AS u
  FROM articles)""",
    "word_count": with_(ARTICLES, SOME_TEXT)
    + f"""SELECT seq, CAST(coalesce(len({token_sql('text')}), 0) AS INTEGER) AS word_count,
       CAST(len({token_sql('text')}) AS INTEGER) AS text_length FROM some_text""",
    "keyword_flag": with_(ARTICLES, SOME_TEXT) + f"SELECT seq, {KEYWORD_TEST} AS mentioned FROM some_text",
    "article_type": with_(ARTICLES, SOME_TEXT) + f"SELECT seq, {TYPE_CASE} AS article_type FROM some_text",
    "date_features": with_(ARTICLES)
    + """SELECT seq, CAST(t AS DATE) AS date, dayname(t) AS day_of_week, CAST(month(t) AS INTEGER) AS month,
       coalesce(isodow(t) >= 6, false) AS is_weekend
FROM (SELECT seq, CASE WHEN seq % 13 <> 0 THEN datetime END AS t FROM articles)""",
    "days_until": with_(ARTICLES)
    + f"""SELECT seq, {_days(dx.US_ELECTION)} AS days_until_us_election, {_days(dx.FRENCH_ELECTION)} AS days_until_french_election
FROM articles""",
    "build_prompt": with_(ARTICLES, SOME_TEXT)
    + f"SELECT url, {quote(tx.prompt_head())} || text AS prompt FROM some_text WHERE regexp_matches(text, '[^{BLANK}]')",
    "lexicon_count": with_(ARTICLES, SOME_TEXT) + VERB_COUNTS,
    "tagged_counts": with_(ARTICLES, SOME_TEXT) + VERB_COUNTS,
    "article_features": with_(ARTICLES)
    + f"""SELECT seq, {PUBLISHER.format('url')} AS news_org, CAST(datetime AS DATE) AS date, dayname(datetime) AS day_of_week,
  CAST(month(datetime) AS INTEGER) AS month, coalesce(isodow(datetime) >= 6, false) AS is_weekend,
  {_days(dx.US_ELECTION)} AS days_until_us_election, {_days(dx.FRENCH_ELECTION)} AS days_until_french_election,
  CAST(coalesce(len({token_sql('text')}), 0) AS INTEGER) AS word_count,
  CAST(coalesce(len(list_filter({token_sql('lower(text)')}, lambda t: list_contains({VERBS}, t))), 0) AS INTEGER) AS verb_count,
  {KEYWORD_TEST} AS mentions_election_keywords, language, {TYPE_CASE} AS article_type
FROM articles""",
    "pending_articles": with_(ARTICLES)
    + "SELECT seq, url FROM articles WHERE url NOT IN (SELECT url FROM articles WHERE relevance_description IS NOT NULL)",
    "gazetteer_entities": with_(ARTICLES, SENTENCES)
    + f""", mentions AS (
  SELECT url, seq, unnest(words) AS entity FROM worded
  UNION ALL
  SELECT url, seq, words[i] || ' ' || words[i + 1] AS entity FROM (SELECT *, unnest(range(1, len(words))) AS i FROM worded)
)
SELECT url, seq, entity, {MENTION_TYPE} AS entity_type, count(*) AS mentions
FROM mentions WHERE list_contains({SURFACES}, entity) GROUP BY url, seq, entity""",
    "cooccurrence_edges": with_(ARTICLES, SENTENCES)
    + f"""{MENTIONED}, steps AS (
  SELECT url, seq, names[i] AS source, names[i + 1] AS target FROM (SELECT *, unnest(range(1, len(names))) AS i FROM named)
)
SELECT url, seq, source, target, count(*) AS n, 'partners with' AS relationship, 'NEUTRAL' AS sentiment
FROM steps WHERE source <> target GROUP BY url, seq, source, target""",
    "csv_roundtrip": with_(ARTICLES) + "SELECT seq, url, text, relevance_text FROM articles",
    "appended_results": with_(ARTICLES)
    + "SELECT seq, url, CASE is_us_election WHEN 1 THEN '20240601_0000' ELSE '20240601_0005' END AS batch_stamp FROM articles",
}
