"""Column expressions over text. Everything stays in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabularies and patterns that must match the published behaviour.
ELECTION_KEYWORDS = ["election", "vote", "poll", "ballot", "campaign", "runoff"]
HONORIFICS = ["Mr", "Ms", "Mrs", "Dr", "Prof", "President", "Chancellor", "Prime Minister"]
ENTITY_TYPES = ["people", "institutions", "political_events", "political_parties", "locations"]
RELATIONSHIPS = ["supports", "criticizes", "endorses", "opposes", "represents", "leads", "partners with", "accuses"]
SENTIMENTS = ["FRIENDLY", "HOSTILE", "NEUTRAL"]
RATE_LIMIT_SIGNS = ["rate limit", "quota", "429"]

# Unicode whitespace including the four ASCII separators; Java's plain \s is ASCII only.
UNICODE = "(?U)"
SPACE = r"\s\x1c-\x1f"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def publisher(url: Column) -> Column:
    """URL authority with user-info and port; empty without ``//``, null for null."""
    return F.regexp_extract(url, AUTHORITY, 1)


def strip(text: Column) -> Column:
    """Trim Unicode whitespace on both sides."""
    return F.regexp_replace(text, f"{UNICODE}^[{SPACE}]+|[{SPACE}]+$", "")


def is_blank(text: Column) -> Column:
    """True for null or whitespace-only text."""
    return F.coalesce(~text.rlike(f"{UNICODE}[^{SPACE}]"), F.lit(True))


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens; null for null."""
    return F.filter(F.split(text, f"{UNICODE}[{SPACE}]+"), lambda token: token != "")


def text_length(text: Column) -> Column:
    """Token count, null for null text (profiling rule)."""
    return F.when(text.isNotNull(), F.size(tokens(text)))


def word_count(text: Column) -> Column:
    """Token count, 0 for null text (feature rule)."""
    return F.coalesce(text_length(text), F.lit(0))


def mentions_any(text: Column, words: Sequence[str] = tuple(ELECTION_KEYWORDS)) -> Column:
    """Case-insensitive substring test for any of the words; null text gives false."""
    alternatives = "|".join(re.escape(word) for word in words)
    return F.coalesce(text.rlike(f"(?iu)(?:{alternatives})"), F.lit(False))


def article_type(text: Column, kinds: Sequence[tuple[str, str]] = (("analysis", "analysis"), ("interview", "interview"))) -> Column:
    """Label of the first word found in the lower-cased text, else ``other``."""
    lowered = F.lower(text)
    label = F.lit("other")
    for word, kind in reversed(list(kinds)):
        label = F.when(lowered.contains(word), F.lit(kind)).otherwise(label)
    return label


def normalize_title(name: Column) -> Column:
    """Remove honorifics standing as whole words anywhere in the name, then trim."""
    titles = "|".join(HONORIFICS)
    return strip(F.regexp_replace(name, rf"(?U)\b(?:{titles})\.?\s+", ""))


def json_block(response: Column) -> Column:
    """From the first ``{`` to the last ``}`` across lines; null when there is none."""
    block = F.regexp_extract(response, r"\{[\s\S]*\}", 0)
    return F.when(block != "", block)


def prompt_head() -> str:
    """Instructions put before the article text; the vocabularies and the reply format are fixed."""
    kinds = ", ".join(ENTITY_TYPES)
    relations = ", ".join(RELATIONSHIPS)
    tones = ", ".join(SENTIMENTS)
    empty = ", ".join(f'"{kind}": []' for kind in ENTITY_TYPES)
    return (
        "Read the article and reply with one JSON object only.\n"
        f"List the named entities under these keys: {kinds}.\n"
        f"List relations between entities; allowed kinds: {relations}.\n"
        f"Give each relation a sentiment out of: {tones}.\n"
        "Use empty lists when nothing is found. Reply format:\n"
        f'{{"entities": {{{empty}}}, "entity_relationships": '
        '[{"source": "", "target": "", "relationship": "", "sentiment": ""}]}\n'
        "Article:\n"
    )


def build_prompt(text: Column) -> Column:
    return F.concat(F.lit(prompt_head()), text)


def is_rate_limit(message: Column) -> Column:
    """Does the error message ask the caller to slow down?"""
    signs = "|".join(re.escape(sign) for sign in RATE_LIMIT_SIGNS)
    return F.coalesce(F.lower(message).rlike(signs), F.lit(False))


def lexicon_count(text: Column, words: Sequence[str]) -> Column:
    """Tokens found in a short word list, 0 for null; for long lexicons see operators.extraction."""
    hits = F.filter(tokens(F.lower(text)), lambda token: token.isin(list(words)))
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(hits))


def menu_label(*parts: Column) -> Column:
    """Title-cased ``a / b`` label of a selection menu."""
    return F.concat_ws(" / ", *[F.initcap(part) for part in parts])
