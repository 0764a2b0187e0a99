"""Secrets in texts: fixed patterns, and strings of high entropy. DataFrame functions only.

Base kinds are regular expressions: ``assign`` (a credential word, a separator, a value), ``access`` (access key ids)
and ``hex`` (long hexadecimal runs). Spans are half-open ranges of code points, leftmost and not overlapping within a kind;
their places follow from the lengths of the stretches between the matches.

Added kind ``entropy``: candidate strings (long unbroken runs of key characters) are read through a sliding window. Each
character class (lower-case hexadecimal, letters of one case, these with digits, all key characters) has a
threshold of Shannon entropy; a candidate is judged by the narrowest class that holds all of it. The entropy is kept by
incremental counts: with each step one character enters and one leaves, and the sum of c * log2(c) changes by those two
terms alone. Overlapping windows above the threshold are one span. An allow-list suppresses added spans in candidates
that are harmless as a whole (UUIDs, dates and times, words with a number) and spans that hold a placeholder or an
alphabet; base spans always stay.

Edge cases: null and empty texts have no spans; texts of any length are read whole; equal places of different kinds are
listed in the order assign, access, hex, entropy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run of 18 characters or more from its first such start
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
#: A run of key characters; an equals sign ends it, but for the padding behind, so a name does not join its value.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Character classes, narrowest first: pattern of the whole candidate and bits a character from which a window counts.
#: Letters of one case without a digit need more, for words joined by marks come close.
CLASSES = ((r"^[0-9a-f]+$", 3.0), (r"^([a-z_-]+|[A-Z_-]+)$", 3.8), (r"^([0-9a-z_-]+|[0-9A-Z_-]+)$", 3.6), (r"^[A-Za-z0-9+/_=-]+$", 3.9))
#: Harmless as a whole candidate. No group repeats without bound: Java would go one call deeper with each repeat.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9/_=+-]+$",  # numbers, dates, telephone numbers
    r"^(?=[A-Za-z])(?!.*[/_=+-]{2})[A-Za-z/_=+-]*[/_=+-][A-Za-z]*[0-9]{1,4}$",  # words joined by marks with a number behind
)
#: Harmless anywhere in a span.
ALLOWED_INSIDE = (
    r"(?i)example|sample|placeholder|changeme|your[_-]|dummy|redacted",
    r"(?i)abcdefgh|0123456789|x{6,}|(.)\1{5,}",
)
_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of (start, kind number, end) of the pattern's matches; keep: which ones, from arrays of group values."""
    number = KINDS.index(kind)
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep is not None else whole
    sizes = F.arrays_zip(
        F.transform(between, lambda x: F.length(x)).alias("gap"), F.transform(whole, lambda x: F.length(x)).alias("size"), checked.alias("value")
    )
    found = _once(sizes, lambda s: _placed(s, number))
    if keep is not None:
        found = F.filter(found, lambda x: keep(x["value"]))
    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(text.rlike(pattern), found).otherwise(none)


_SPAN = "struct<start:int,kind:int,end:int,value:string>"
_CHUNK = 256  # matches placed by one fold, which copies its list with each


def _once(value: Column, use) -> Column:
    """``use`` of a value computed once: as the element of a list it is a variable, not an expression to repeat."""
    return F.transform(F.array(value), use)[0]


def _placed(sizes: Column, number: int) -> Column:
    """Spans from the (gap, size, value) of the matches: running sums, per chunk from what the chunks before add up to."""

    def length(x: Column) -> Column:
        return x["gap"] + F.coalesce(x["size"], F.lit(0))

    def place(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        one = F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + x["size"]).alias("end"), x["value"].alias("value"))
        found = F.when(x["size"].isNull(), done["found"]).otherwise(F.concat(done["found"], F.array(one)))
        return F.struct((done["at"] + length(x)).alias("at"), found.alias("found"))

    def spans(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda t, x: t + length(x)))
        starts = F.aggregate(totals, F.array(F.lit(0)), lambda done, t: F.concat(done, F.array(F.element_at(done, -1) + t)))
        empty = F.array().cast(f"array<{_SPAN}>")
        pairs = F.arrays_zip(chunks.alias("c"), F.slice(starts, F.lit(1), F.size(chunks)).alias("at"))
        return F.flatten(F.transform(pairs, lambda p: F.aggregate(p["c"], F.struct(p["at"].alias("at"), empty.alias("found")), place)["found"]))

    last = F.floor((F.size(sizes) - 1) / _CHUNK).cast("int")
    return _once(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(sizes, i * _CHUNK + 1, F.lit(_CHUNK))), spans)


def _xlogx(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(0.0)


def entropy_spans(value: Column, bits: Column, window: int = WINDOW) -> Column:
    """Array of (start, end) within ``value``: runs of overlapping windows whose entropy reaches ``bits`` a character."""
    letters = F.transform(F.split(value, ""), lambda x: F.instr(F.lit(_ALPHABET), x))
    read = F.struct(letters.alias("letters"), bits.cast("double").alias("bits"))
    return _once(read, lambda r: F.aggregate(F.sequence(F.lit(1), F.size(r["letters"])), _nothing(), lambda done, i: _step(done, i, r, window))["found"])


def _nothing() -> Column:
    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.struct(F.array_repeat(F.lit(0), len(_ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("total"), none.alias("found"))


def _step(done: Column, i: Column, read: Column, window: int) -> Column:
    """One character comes into the window and one goes; the counts of both, and with them the sum of c * log2(c), change."""
    come = F.element_at(read["letters"], i)
    gone = F.when(i > window, F.element_at(read["letters"], F.greatest(i - window, F.lit(1)))).otherwise(F.lit(0))
    more = F.element_at(done["counts"], come + 1)
    less = F.element_at(done["counts"], gone + 1) + F.when(gone == come, 1).otherwise(0)
    counts = F.transform(
        done["counts"], lambda c, j: c + F.when(j == come, 1).otherwise(0) - F.when((j == gone) & (gone > 0), 1).otherwise(0)
    )
    total = done["total"] + _xlogx(more + 1) - _xlogx(more) - F.when(gone > 0, _xlogx(less) - _xlogx(less - 1)).otherwise(0.0)
    high = (i >= window) & (F.log2(F.lit(float(window))) - total / window >= read["bits"] - 1e-9)
    start = i - window
    last = F.element_at(done["found"], -1)
    joined = (F.size(done["found"]) > 0) & (F.coalesce(last["end"], F.lit(-1)) >= start)
    front = F.when(joined, F.slice(done["found"], 1, F.greatest(F.size(done["found"]) - 1, F.lit(0)))).otherwise(done["found"])
    begin = F.when(joined, last["start"]).otherwise(start)
    found = F.when(high, F.concat(front, F.array(F.struct(begin.alias("start"), i.alias("end"))))).otherwise(done["found"])
    return F.struct(counts.alias("counts"), total.alias("total"), found.alias("found"))


def _threshold(value: Column) -> Column:
    bits = F.lit(99.0)
    for pattern, least in reversed(CLASSES):
        bits = F.when(value.rlike(pattern), least).otherwise(bits)
    return bits


def _entropy(text: Column) -> Column:
    """Spans of kind entropy, but for candidates that are allowed and spans that hold something allowed."""
    allowed, inside = ("|".join(f"(?:{p})" for p in patterns) for patterns in (ALLOWED, ALLOWED_INSIDE))
    candidates = F.filter(_spans(text, CANDIDATE, "entropy"), lambda x: ~x["value"].rlike(allowed))

    def within(x: Column) -> Column:
        spans = F.filter(
            entropy_spans(x["value"], _threshold(x["value"])),
            lambda s: ~F.substring(x["value"], s["start"] + 1, s["end"] - s["start"]).rlike(inside),
        )
        return F.transform(
            spans, lambda s: F.struct((x["start"] + s["start"]).alias("start"), x["kind"].alias("kind"), (x["start"] + s["end"]).alias("end"), F.lit("").alias("value"))
        )

    return F.flatten(F.transform(candidates, within))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def find_secrets(docs: DataFrame, into: str = "secrets") -> DataFrame:
    """``docs`` with a struct of span arrays: assign, access, hex, entropy."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.struct(
        _spans(text, ASSIGN, "assign", lambda v: F.length(v) >= ASSIGN_VALUE).alias("assign"),
        _spans(text, ACCESS, "access").alias("access"),
        _spans(text, HEX, "hex").alias("hex"),
        _entropy(text).alias("entropy"),
    )
    return docs.withColumn(into, found)


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans per document."""
    found = find_secrets(docs.select("doc_id", "text")).select("doc_id", "secrets.*")
    base = F.concat("assign", "access", "hex")
    return found.select(
        "doc_id",
        *(F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, F.col("entropy"))).alias("spans"),
    )
