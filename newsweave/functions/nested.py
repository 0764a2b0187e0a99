"""Nested cells: entity maps and relationship lists held as JSON text or native columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsweave.functions.text import strip

# Keys a relationship must have.
RELATIONSHIP_KEYS = ["source", "target", "relationship", "sentiment"]
LENIENT_JSON = {"allowSingleQuotes": "true"}


#: Up to a Python constant that stands outside of quotes, from where the last match ended.
OUTSIDE = r"""\G((?:[^'"NTF]++|"(?:[^"\\]++|\\.)*+"|'(?:[^'\\]++|\\.)*+'|(?!\b(?:None|True|False)\b)[NTF])*+)"""


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value computed once, however often ``use`` mentions it: as the only element of a list it is a variable, not an expression."""
    return F.transform(F.array(value), use)[0]


def _replace_outside(value: Column, python: str, json: str) -> Column:
    # the other constants count as plain letters here
    pattern = rf"""{OUTSIDE.replace("(?:None|True|False)", python)}\b{python}\b"""
    return bound(value, lambda v: F.when(v.contains(python), F.regexp_replace(v, pattern, f"$1{json}")).otherwise(v))


def as_json(value: Column) -> Column:
    """A stored cell as JSON: white space around it goes, Python's constants outside of quotes become JSON's."""
    return _replace_outside(_replace_outside(_replace_outside(strip(value), "None", "null"), "True", "true"), "False", "false")


def _read(value: Column, opening: str, kind: str) -> Column:
    """A cell that begins with ``opening`` read as ``kind``; null if it cannot be."""
    return bound(as_json(value), lambda v: F.from_json(F.when(v.startswith(opening), v), kind, LENIENT_JSON))


def text_map(value: Column) -> Column:
    """``map<string,string>`` whose values keep their raw JSON; anything unreadable gives an empty map."""
    return F.coalesce(_read(value, "{", "map<string,string>"), F.expr("cast(map() as map<string,string>)"))


def text_list(value: Column) -> Column:
    """``array<string>`` whose elements keep their raw JSON; anything unreadable gives an empty array."""
    return F.coalesce(_read(value, "[", "array<string>"), F.expr("cast(array() as array<string>)"))


def entity_lists(value: Column) -> Column:
    """Entity map with each value read as a list; a value that is not a list becomes null."""
    return F.transform_values(
        text_map(value),
        lambda _, raw: F.from_json(F.when(F.ltrim(raw).startswith("["), raw), "array<string>", LENIENT_JSON),
    )


def relationship_maps(value: Column) -> Column:
    """One ``map<string,string>`` per list element; an element that is not an object becomes an empty map.

    Elements are read one by one so that a single bad element cannot void the whole list, and as maps so
    that a key holding null can be told from a missing key.
    """
    return F.transform(text_list(value), text_map)


def has_relationship_keys(element: Column) -> Column:
    test = F.lit(True)
    for key in RELATIONSHIP_KEYS:
        test = test & F.map_contains_key(element, key)
    return test


def entity_total(entities: Column) -> Column:
    """Names over all categories of a map<string,array<string>>."""
    return F.aggregate(F.map_values(entities), F.lit(0), lambda total, names: total + F.coalesce(F.array_size(names), F.lit(0)))


def mentions_organizations(entities: Column) -> Column:
    return F.coalesce(F.array_size(F.try_element_at(entities, F.lit("institutions"))) > 0, F.lit(False))
