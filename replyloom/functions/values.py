"""Content keys, row digests, strict scores and strict JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.functions.text import _bind, _col, strip

# Fixed values of the scoring rubric.
RUBRIC_FIELDS = ("relevance", "actionability", "grounding", "tone", "safety")
RUBRIC_VERSION = "support-draft-v2"

JSON_STRING = r'"(?:[^"\\]|\\.)*"'
JSON_FLOAT = r"-?\d+(?:\.\d+(?:[eE][+-]?\d+)?|[eE][+-]?\d+)"
DECIMAL = r"^[+]?(?=\.?\d)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?$"


def cache_key(model: Column | str, text: Column | str, draft: Column | str, evidence: Column | str,
              rubric_version: str = RUBRIC_VERSION) -> Column:
    """SHA-256 over everything a score depends on (keys in alphabetical order)."""
    content = F.struct(
        _col(draft).alias("draft"),
        F.sha2(_col(evidence), 256).alias("evidence_sha256"),
        _col(model).alias("model"),
        F.lit(rubric_version).alias("rubric_version"),
        _col(text).alias("text"),
    )
    return F.sha2(F.to_json(content), 256)


def parse_score(c: Column | str) -> Column:
    """Integer 1..5 from decimal text such as ``4``, ``4.0``, ``0_4`` or ``40e-1``; else null.

    Exact at any length: with the point removed and leading zeros gone, the
    digits must be one of 1..5 and zeros, and the exponent must move the point
    right behind the first of them.
    """

    def parse(text: Column) -> Column:
        part = lambda group: F.regexp_extract(text, DECIMAL, group)
        digits = F.concat(part(1), part(2))
        core = r"^0*([1-5])(0*)$"
        exponent = F.regexp_replace(part(3), r"^([+-]?)0+(?=\d)", "$1")
        shift = F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int"))
        needed = F.length(part(2)) - F.length(F.regexp_extract(digits, core, 2))
        whole = F.rlike(text, F.lit(DECIMAL)) & F.rlike(digits, F.lit(core)) & (shift == needed)
        return F.when(whole, F.regexp_extract(digits, core, 1).try_cast("int"))

    return _bind(F.replace(strip(c), F.lit("_"), F.lit("")), parse)


def parse_json_strict(c: Column | str) -> Column:
    """Parsed JSON, or null for malformed text, duplicate keys, NaN or overflow.

    The engine's own JSON parser rejects duplicate keys and non-finite literals;
    numbers written outside of strings are checked for overflow separately.  It
    stops after the first value, so the text must also parse inside of both an
    array and an object: nothing but a single value does.
    """

    def parse(text: Column) -> Column:
        bare = F.regexp_replace(text, JSON_STRING, '""')
        numbers = F.regexp_extract_all(bare, F.lit(JSON_FLOAT), 0)
        overflow = F.exists(numbers, lambda n: F.abs(n.try_cast("double")) == float("inf"))
        in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
        in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
        single = in_array.isNotNull() & in_object.isNotNull()
        return F.when(single & ~overflow, F.try_parse_json(text))

    return _bind(_col(c), parse)


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """MD5 of one row's values; nulls and column order are part of the digest."""
    parts = [
        F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))
        for c in (columns or df.columns)
    ]
    return F.md5(F.concat_ws("\u001f", *parts))


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row ``(row_count, digest)`` that ignores row order but counts copies.

    Row digests are added up, so the pass is a map-side partial sum and a single
    tiny exchange, however large the table is.
    """
    hexes = df.select(row_digest(df, columns).alias("h"))

    def total(start: int) -> Column:
        part = F.conv(F.substring("h", start, 8), 16, 10).cast("decimal(20,0)")
        return F.coalesce(F.sum(part), F.lit(0)).cast("string")

    return hexes.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.md5(F.concat_ws("-", F.count(F.lit(1)).cast("string"), *(total(s) for s in (1, 9, 17, 25))))
        .alias("digest"),
    )
