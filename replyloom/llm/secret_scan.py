"""Secrets in texts, by patterns and by sliding-window entropy; DataFrame functions only.

Positions come from one split per pattern: the pieces between matches and the
matches themselves add up to the text.  Long strings of key characters are
candidates; a window slides over each one, and every step updates the counts of
the character that enters and the one that leaves, so the entropy of a window
costs the same at every place.  Entropies are compared as whole numbers, which
makes thresholds exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(x) for x in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
WINDOW = 20
#: Bits per character that a window of the class must reach; see ``_suspicious``.
HEX_BITS, ALNUM_BITS, MIXED_BITS = 3.0, 3.6, 3.7
#: 99 of 100 random windows over A-Z2-7 and over A-Za-z have these.
UPPER_BITS, LETTER_BITS = 3.3, 3.5
#: A window that touches a match of one of these is no secret: UUIDs, placeholders, alphabets.
ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{8}",
    "0123456789|[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]",
)
#: Between the matches, overlapping ones included, of the patterns that may match inside a candidate.
_APART = "[Ee][Xx][Aa][Mm][Pp][Ll][Ee](?:[Xx][Aa][Mm][Pp][Ll][Ee])*|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{8,}|" + ALLOWED[2]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
UNIT = 1_000_000
_BLOCK = 512


def weight(count: int) -> int:
    """c log2 c in millionths; a window's entropy is log2 W less the mean of these over W."""
    return round(UNIT * count * math.log2(count)) if count > 1 else 0


def most_weight(bits: float) -> int:
    """The largest sum of weights at which a window still has ``bits`` per character."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * UNIT)


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _offsets(steps: Column) -> Column:
    """Turn (gap, size) steps into (begin, end) spans.

    Running sums copy the array they append to, so they run inside blocks and
    over the blocks, which keeps texts with very many matches cheap.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    total = lambda block: F.aggregate(block, _long(0), lambda a, s: a + s["gap"] + s["size"])
    begins = F.aggregate(
        blocks,
        F.array(_long(0)),
        lambda a, block: F.array_append(a, F.element_at(a, -1) + total(block)),
    )
    none = F.array().cast("array<struct<begin: long, end: long>>")
    spans = lambda block, at: F.aggregate(
        block,
        F.struct(at.alias("at"), none.alias("out")),
        lambda a, s: F.struct(
            (a["at"] + s["gap"] + s["size"]).alias("at"),
            F.array_append(
                a["out"],
                F.struct((a["at"] + s["gap"]).alias("begin"), (a["at"] + s["gap"] + s["size"]).alias("end")),
            ).alias("out"),
        ),
        lambda a: a["out"],
    )
    within = F.zip_with(blocks, F.slice(begins, 1, F.size(blocks)), spans)
    return F.when(F.size(steps) > 0, F.flatten(within)).otherwise(none)


def _with_matches(df: DataFrame, text: str, name: str, pattern: str, might: Column, group: int = 0) -> DataFrame:
    """Add ``name``: (begin, end, value) of the leftmost non-overlapping matches.

    Each step is a column of its own, so Spark evaluates each pattern once.
    """
    gaps, found, value = f"__{name}_gaps", f"__{name}_found", f"__{name}_value"
    only = lambda c: F.when(might, c).otherwise(F.array().cast("array<string>"))
    df = df.withColumns(
        {
            gaps: only(F.split(F.col(text), pattern, -1)),
            found: only(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))),
            value: only(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))) if group else F.lit(None),
        }
    )
    steps = F.zip_with(
        F.slice(F.col(gaps), 1, F.size(found)),
        F.col(found),
        lambda g, m: F.struct(F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("size")),
    )
    df = df.withColumn(f"__{name}_steps", steps)
    df = df.withColumn(f"__{name}_spans", _offsets(F.col(f"__{name}_steps")))
    joined = F.zip_with(
        F.col(f"__{name}_spans"),
        F.col(value if group else found),
        lambda s, v: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), v.alias("value")),
    )
    parts = [gaps, found, value, f"__{name}_steps", f"__{name}_spans"]
    return df.withColumn(name, joined).drop(*parts)


def _between(code: Column, first: str, last: str) -> Column:
    return code.between(ALPHABET.index(first) + 1, ALPHABET.index(last) + 1)


def _random_window(marks: Column) -> Column:
    """Whether a window over ``marks``, places in ``ALPHABET``, looks random for its class."""
    zero, one = F.lit(0), F.lit(1)
    weights = F.array(*[_long(weight(c)) for c in range(WINDOW + 2)])
    w = lambda count: F.element_at(weights, count + 1)
    members = {
        "hex": lambda c: _between(c, "A", "F") | _between(c, "a", "f") | _between(c, "0", "9"),
        "digit": lambda c: _between(c, "0", "9"),
        "lower": lambda c: _between(c, "a", "z"),
        "upper": lambda c: _between(c, "A", "Z"),
    }

    def looks_random(a: Column) -> Column:
        hexadecimal = (a["hex"] == WINDOW) & a["digit"].between(1, WINDOW - 1) & (a["t"] <= most_weight(HEX_BITS))
        alnum = (a["lower"] + a["digit"] == WINDOW) & a["digit"].between(4, WINDOW - 4) & (a["t"] <= most_weight(ALNUM_BITS))
        mixed = (a["lower"] > 0) & (a["upper"] > 0) & (a["digit"] > 0) & (a["t"] <= most_weight(MIXED_BITS))
        capital = (a["upper"] + a["digit"] == WINDOW) & a["digit"].between(1, WINDOW - 1) & (a["t"] <= most_weight(UPPER_BITS))
        letters = (a["lower"] + a["upper"] == WINDOW) & a["upper"].between(4, WINDOW - 4) & (a["t"] <= most_weight(LETTER_BITS))
        return hexadecimal | alnum | mixed | capital | letters

    def step(a: Column, at: Column) -> Column:
        enters = F.element_at(marks, at)
        leaves = F.when(at > WINDOW, F.element_at(marks, at - WINDOW)).otherwise(zero)
        flag = lambda condition: F.when(condition, one).otherwise(zero)
        before = F.element_at(a["counts"], enters)
        out = F.element_at(a["counts"], leaves) + flag(enters == leaves)
        return F.struct(
            F.transform(a["counts"], lambda n, i: n + flag(i + 1 == enters) - flag(i + 1 == leaves)).alias("counts"),
            (a["t"] + w(before + 1) - w(before) + F.when(leaves > 0, w(out - 1) - w(out)).otherwise(_long(0))).alias("t"),
            *[(a[k] + flag(of(enters)) - flag((leaves > 0) & of(leaves))).alias(k) for k, of in members.items()],
            (a["hit"] | ((at > WINDOW) & looks_random(a))).alias("hit"),
        )

    start = F.struct(
        F.array_repeat(zero, len(ALPHABET)).alias("counts"),
        _long(0).alias("t"),
        *[zero.alias(k) for k in members],
        F.lit(False).alias("hit"),
    )
    return F.aggregate(F.sequence(one, F.size(marks)), start, step, lambda a: a["hit"] | looks_random(a))


def suspicious(candidate: Column) -> Column:
    """Whether a candidate holds a window of high entropy that touches no allowed match.

    hex windows have hexadecimal digits only, numerals among them; alnum windows
    lower case and numerals, four of each; mixed ones upper and lower case and
    numerals; capital ones upper case and numerals only; letters ones upper and
    lower case only, four of each.
    """
    pieces = F.filter(F.split(candidate, _APART, -1), lambda p: F.length(p) >= WINDOW)
    marks = F.transform(pieces, lambda p: F.transform(F.split(p, ""), lambda c: F.instr(F.lit(ALPHABET), c)))
    worth = candidate.rlike("[0-9]") | (candidate.rlike("[A-Z]") & candidate.rlike("[a-z]"))
    return F.when(worth & ~candidate.rlike(ALLOWED[0]), F.exists(marks, _random_window)).otherwise(F.lit(False))


def _kind(spans: str, number: int, keep) -> Column:
    kept = F.filter(F.col(spans), lambda s: keep(s["value"]))
    return F.transform(kept, lambda s: F.struct(s["begin"].alias("begin"), F.lit(number).alias("kind"), s["end"].alias("end")))


def with_secrets(df: DataFrame, text: str = "text", spans: str = "secrets") -> DataFrame:
    """``df`` with an array of (begin, kind, end) by begin, then kind.

    Positions count code points, the end is exclusive, ``kind`` is a place in
    ``KINDS``.  A pattern's matches never overlap, those of different kinds may.
    A null or empty text has an empty array.  All rows and columns stay.
    """
    plain = "__secret_text"
    df = df.withColumn(plain, F.coalesce(F.col(text), F.lit("")))
    might = lambda pattern: F.col(plain).rlike(pattern)
    df = _with_matches(df, plain, "__secret_assign", ASSIGN, might(f"({_NAMES})[\"']?\\x20*[:=]"), group=2)
    df = _with_matches(df, plain, "__secret_access", ACCESS, F.contains(F.col(plain), F.lit("AKIA")))
    df = _with_matches(df, plain, "__secret_hex", HEX, might(f"[0-9a-f]{{{MIN_HEX}}}"))
    df = _with_matches(df, plain, "__secret_entropy", CANDIDATE, might("[A-Za-z0-9+/_-]{20}"))
    at_least = lambda n: lambda value: F.length(value) >= n
    found = F.concat(
        _kind("__secret_assign", 0, at_least(MIN_ASSIGNED)),
        _kind("__secret_access", 1, at_least(MIN_ACCESS)),
        _kind("__secret_hex", 2, at_least(MIN_HEX)),
        _kind("__secret_entropy", 3, suspicious),
    )
    return df.withColumn(spans, F.array_sort(found)).drop(plain, "__secret_assign", "__secret_access", "__secret_hex", "__secret_entropy")


def as_text(spans: Column, kinds: Sequence[int] = range(len(KINDS))) -> Column:
    """``kind:begin:end`` of the spans of some kinds, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    one = lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["begin"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(kept, one), ",")


def of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _merged(spans: Column) -> Column:
    """Disjoint (begin, end) ranges that cover the same places, in order."""
    none = F.array().cast("array<struct<begin: long, end: long>>")

    def step(a: Column, s: Column) -> Column:
        last = F.element_at(a, -1)
        joined = F.concat(
            F.slice(a, 1, F.size(a) - 1),
            F.array(F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))),
        )
        added = F.array_append(a, F.struct(s["begin"].alias("begin"), s["end"].alias("end")))
        return F.when(F.size(a) == 0, added).when(last["end"] >= s["begin"], joined).otherwise(added)

    return F.aggregate(spans, none, step)


def redact_secrets(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every secret replaced by ``mark``; other texts, rows and columns as they are."""
    own = df.columns
    df = with_secrets(df, text, "__secret_spans").withColumn("__secret_ranges", _merged(F.col("__secret_spans")))
    n, old = F.size("__secret_ranges"), F.col(text)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at("__secret_ranges", i)["end"]).cast("int")
    end = lambda i: F.when(i == n, F.length(old)).otherwise(F.element_at("__secret_ranges", i + 1)["begin"]).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n), lambda i: F.substr(old, begin(i) + 1, end(i) - begin(i)))
    return df.withColumn(text, F.when(n > 0, F.array_join(pieces, mark)).otherwise(old)).select(*own)


def secret_scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key and ``secrets``; see ``with_secrets``."""
    return with_secrets(documents.select(F.col(key), F.col(text).alias("__text")), "__text").drop("__text")
