"""Text cleaning as Column expressions.

Everything here stays inside Spark's JVM expressions.  Character classes are
spelled out (letters, numbers, underscore; the full whitespace set) because the
defaults of the regex engine are ASCII-only.
"""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: character classes and placeholder formats ---------------
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

# Each pattern tests something cheap and rare first, since it is tried at every character.
EMAIL_PATTERN = rf"{EDGE}[{WORD}.+-]++@[{WORD}.-]+\.[A-Za-z]{{2,}}{EDGE}"
URL_PATTERN = rf"[hH][tT][tT][pP][sS\u017f]?://[^{SPACE}]+|[wW]{{3}}\.[^{SPACE}]+"
HANDLE_PATTERN = rf"@(?<![{WORD}]@)[A-Za-z0-9_]+"
NUMBER_PATTERN = rf"\p{{Nd}}(?<![{WORD}]\p{{Nd}})\p{{Nd}}{{4,}}+(?![{WORD}])"
SPACE_RUN = rf" [{SPACE}]+|[{SPACE}&&[^ ]][{SPACE}]*"
PLAIN_WORD = rf"(?:^|[{SPACE}])\p{{L}}++(?:[{SPACE}]|$)"
PLACEHOLDER_PATTERN = r"(?iu)<(?:EMAIL|URL|HANDLE|NUMBER)>"

# Western letters that fold like lower case; tested first because most text is just these.
NEVER_RARE = r"\x00-\xb4\xb6-\u0148"

MESSAGE_MAX_CHARS = 4000
BLANK_MESSAGE = "Enter a customer message with usable text."
LONG_MESSAGE = "Customer message must be %d characters or fewer."

LEADING_HANDLE = rf"^<HANDLE>[,!.{SPACE}-]*"
LEADING_GREETING = rf"(?iu)^(hi|hey|hello)([{SPACE}]+there)?[,!.{SPACE}-]*"
AGENT_SIGNATURE = rf"[{SPACE}]*/[A-Z]{{2}}[{SPACE}]*(<URL>)?[{SPACE}]*$"

# A reply that matches any of these is never reused as guidance.
BLOCKED_REPLY_PATTERNS = (
    rf"{EDGE}(?:refund[{WORD}]*|charg[{WORD}]*|payment[{WORD}]*|billing|password[{WORD}]*|"
    rf"credential[{WORD}]*|hack[{WORD}]*|secur[{WORD}]*|private|dm|direct message|email|"
    rf"legal|privacy){EDGE}",
    rf"{EDGE}(?:we|i)(?:['’]ve| have| already| just|['’]ll| will| can){EDGE}",
    rf"{EDGE}(?:your|the)[{SPACE}]+(?:account|subscription|plan)[{SPACE}]+(?:is|has|was){EDGE}",
    rf"{EDGE}(?:resolved|refunded|cancelled|canceled|recorded|escalated|fixed|"
    rf"investigating|confirmed|guarantee[{WORD}]*){EDGE}",
    rf"{EDGE}(?:ignore|disregard){EDGE}.*{EDGE}(?:instructions|rules|previous){EDGE}",
    rf"{EDGE}system prompt{EDGE}|{EDGE}(?:assistant|system|developer)[{SPACE}]*:",
)
# Fixed value: how a reusable troubleshooting sentence starts.
SUGGESTION_START = (
    rf"(?iu)^(?:please[{SPACE}]+)?(?:try{EDGE}|restart{EDGE}|reinstall{EDGE}|update{EDGE}|"
    rf"check{EDGE}|could you[{SPACE}]+(?:try|restart|check|update){EDGE}|"
    rf"can you[{SPACE}]+(?:try|restart|check|update){EDGE})"
)
SENTENCE = r"[^.!?]+[.!?]|[^.!?]+$"
# ---- end of fixed values ---------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and reuse it inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _never_null(text: Column) -> Column:
    """Tell the optimiser that a text cannot be null.

    Otherwise a join on it adds an ``is not null`` filter, which is pushed to the
    scan and cleans every text there a second time.
    """
    return F.coalesce(text, F.lit(""))


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE_RUN, " "))


def strip(c: Column | str) -> Column:
    """Drop leading and trailing Unicode whitespace."""
    return F.regexp_replace(_col(c), rf"^[{SPACE}]+|[{SPACE}]+$", "")


def is_blank(c: Column | str) -> Column:
    """True for null and for whitespace-only text; the search ends at the first other character."""
    return ~F.coalesce(F.rlike(_col(c).cast("string"), F.lit(f"[^{SPACE}]")), F.lit(False))


@lru_cache(maxsize=1)
def _fold_table() -> dict[str, str]:
    """What full case folding changes beyond lower-casing, derived by rule."""
    lowered = (ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.lower() == ch)
    return {ch: ch.casefold() for ch in lowered if ch.casefold() != ch}


def _char_class(chars: list[str]) -> str:
    """A regex class with runs of neighbouring characters written as ranges."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in runs)


def casefold(c: Column | str) -> Column:
    """Full Unicode case folding.

    Sharp s has a fast path; the other characters that fold differently from
    lower case are rare, and only texts that hold one are rewritten by character.
    """
    table = _fold_table()
    rare = [ch for ch in table if ch != "ß"]

    def fold(text: Column) -> Column:
        entries = ";".join(f"{ch}={folded}" for ch, folded in table.items())
        mapping = F.str_to_map(F.lit(entries), F.lit(";"), F.lit("="))
        by_character = F.array_join(
            F.transform(
                F.split(text, ""), lambda ch: F.coalesce(F.try_element_at(mapping, ch), ch)
            ),
            "",
        )
        is_rare = F.rlike(text, F.lit(f"[[^{NEVER_RARE}]&&[{_char_class(rare)}]]"))
        return F.when(is_rare, by_character).otherwise(F.replace(text, F.lit("ß"), F.lit("ss")))

    return _bind(F.lower(_col(c)), fold)


def normalize_text(c: Column | str) -> Column:
    """Redact e-mails, URLs, handles and long numbers, then collapse spaces."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))

    def redact(t: Column) -> Column:
        at = F.contains(t, F.lit("@"))
        link = F.contains(t, F.lit("://"))
        for dot in ("ww.", "wW.", "Ww.", "WW."):
            link = link | F.contains(t, F.lit(dot))
        named = F.when(at, F.regexp_replace(t, EMAIL_PATTERN, "<EMAIL>")).otherwise(t)
        linked = F.regexp_replace(F.regexp_replace(named, URL_PATTERN, "<URL>"), HANDLE_PATTERN, "<HANDLE>")
        # Most texts hold none of the marks that the three patterns need.
        return F.when(at | link, linked).otherwise(t)

    text = _never_null(_bind(text, redact))
    text = F.regexp_replace(text, NUMBER_PATTERN, "<NUMBER>")
    return collapse_space(text)


def _head(text: Column, max_chars: int | None) -> Column:
    return text if max_chars is None else F.substring(text, 1, max_chars)


def sanitize_reply(c: Column | str, max_chars: int | None = None) -> Column:
    """Normalise a reply and drop its greeting, handles and agent sign-off.

    The whole reply is kept unless the caller sets ``max_chars``.
    """
    text = normalize_text(c)
    text = F.regexp_replace(text, LEADING_HANDLE, "")
    text = F.regexp_replace(text, LEADING_GREETING, "")
    text = F.regexp_replace(text, LEADING_HANDLE, "")
    text = F.regexp_replace(text, AGENT_SIGNATURE, "")
    return F.trim(_head(text, max_chars))


def normalize_for_matching(c: Column | str) -> Column:
    """Identifier-free, case-folded text for training, retrieval and dedupe."""

    def bare(t: Column) -> Column:
        # What is collapsed already stays as it is.
        without = collapse_space(F.regexp_replace(t, PLACEHOLDER_PATTERN, " "))
        return F.when(F.contains(t, F.lit("<")), without).otherwise(t)

    return _never_null(casefold(_bind(normalize_text(c), bare)))


def is_empty_for_matching(c: Column | str) -> Column:
    """True where ``normalize_for_matching`` leaves nothing; a text with a plain word is not normalised for that.

    Redaction works inside runs between spaces and needs a mark, a digit or a
    dot: a run of nothing but letters is always left.
    """
    plain = F.coalesce(F.rlike(_col(c).cast("string"), F.lit(PLAIN_WORD)), F.lit(False))
    return ~plain & (normalize_for_matching(c) == "")


def safe_guidance(
    c: Column | str,
    blocked: tuple[str, ...] = BLOCKED_REPLY_PATTERNS,
    suggestion_start: str = SUGGESTION_START,
    max_chars: int | None = None,
) -> Column:
    """The reusable troubleshooting sentences of a reply, or ``""``.

    Blocked words are looked for in the whole reply; ``max_chars`` only shortens
    what is returned.
    """
    unsafe = "(?iu)" + "|".join((PLACEHOLDER_PATTERN.removeprefix("(?iu)"), *blocked))

    def pick(text: Column) -> Column:
        sentences = F.regexp_extract_all(text, F.lit(f"({SENTENCE})"), 1)
        kept = F.filter(
            F.transform(sentences, lambda s: F.trim(s)), lambda s: F.rlike(s, F.lit(suggestion_start))
        )
        joined = _head(F.array_join(kept, " "), max_chars)
        return F.when(F.rlike(text, F.lit(unsafe)), F.lit("")).otherwise(joined)

    return _bind(sanitize_reply(c), pick)


def with_matching_text(df, column: str, name: str):
    """Add the matching text of ``column`` and drop the rows where it is empty.

    Generating from a filtered one-element array evaluates the text once; a
    filter on the new column would be pushed down and evaluate it again.
    """
    found = F.filter(F.array(normalize_for_matching(column)), lambda t: t != "")
    return df.select("*", F.explode(found).alias(name))


def is_reviewed(c: Column | str) -> Column:
    return casefold(strip(c)) == "yes"


def rejection_reason(c: Column | str, max_chars: int | None = MESSAGE_MAX_CHARS) -> Column:
    """Why a message cannot be triaged; null when it can.  ``None`` accepts any length."""
    reason = F.when(is_empty_for_matching(c), F.lit(BLANK_MESSAGE))
    if max_chars is None:
        return reason
    return reason.when(F.length(_col(c)) > max_chars, F.lit(LONG_MESSAGE % max_chars))


def validate_message(df, text: str = "text", max_chars: int | None = MESSAGE_MAX_CHARS):
    """Split a batch into ``(accepted, rejected)``; rejected rows carry ``reason``."""
    tagged = df.withColumn("reason", rejection_reason(text, max_chars))
    accepted = tagged.filter(F.col("reason").isNull()).drop("reason")
    return accepted, tagged.filter(F.col("reason").isNotNull())


def humanize(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit("_"), F.lit(" "))
