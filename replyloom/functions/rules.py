"""Ordered keyword rules and whole-word term matching."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyloom.functions.text import EDGE, WORD, _bind, _col, casefold

FALLBACK_LABEL = "other_unclear"

# Label and word stems, in priority order.
DEFAULT_RULES: tuple[tuple[str, str], ...] = (
    ("account_security", "hack|hacked|stolen|fraud|unauthori[sz]ed|compromis|security"),
    ("plan_change_cancel", "cancel|downgrade|upgrade|change plan|switch plan|premium plan"),
    (
        "billing_subscription",
        "charge|charged|billing|payment|refund|invoice|subscription|money|price",
    ),
    ("account_access", "log ?in|sign ?in|password|reset|locked out|access account"),
    ("service_outage", "down|outage|offline|everyone|service unavailable"),
    (
        "playback_app_issue",
        "play|playing|pause|skip|crash|app|stream|download|sound|offline mode",
    ),
    (
        "feature_availability",
        "feature|available|support|playlist|lyrics|podcast|device|country",
    ),
    ("complaint_feedback", "awful|terrible|hate|annoy|frustrat|disappoint|feedback|please add"),
)


def rule_label(
    c: Column | str,
    rules: Sequence[tuple[str, str]] = DEFAULT_RULES,
    fallback: str = FALLBACK_LABEL,
) -> Column:
    """First matching rule as ``struct(intent, rule_match)``."""

    def label(text: Column) -> Column:
        chain = None
        for name, stems in rules:
            pattern = rf"(?iu){EDGE}(?:{stems})[{WORD}]*{EDGE}"
            value = F.struct(
                F.lit(name).alias("intent"),
                F.regexp_extract(text, pattern, 0).alias("rule_match"),
            )
            hit = F.rlike(text, F.lit(pattern))
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
        default = F.struct(F.lit(fallback).alias("intent"), F.lit("").alias("rule_match"))
        return default if chain is None else chain.otherwise(default)

    return _bind(_col(c), label)


def matched_terms(c: Column | str, terms: Sequence[str]) -> Column:
    """The configured terms that occur as whole words, in configured order."""
    if not terms:
        return F.array().cast("array<string>")

    def find(text: Column) -> Column:
        hits = [
            F.when(F.rlike(text, F.lit(EDGE + re.escape(term.casefold()) + EDGE)), F.lit(term))
            for term in terms
        ]
        return F.array_compact(F.array(*hits))

    return _bind(casefold(c), find)
