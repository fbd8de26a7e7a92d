"""Label counts, weak labels, the annotation queue and the two simple systems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.config import GENERIC_REPLY, WEAK_LABEL_SOURCE
from replyloom.functions.rules import DEFAULT_RULES, FALLBACK_LABEL, rule_label
from replyloom.functions.text import humanize, with_matching_text
from replyloom.operators.sampling import dedupe_first, number_examples, sample_n, text_digest
from replyloom.session import scratch, stored

BLANK_ANNOTATIONS = (
    "intent",
    "secondary_intent",
    "decision",
    "escalation_reason",
    "required_reply_points",
    "forbidden_claims",
    "annotator_confidence",
    "annotator",
)
# Labels the keyword system never handles on its own; the first two get the generic reply.
SENSITIVE_LABELS = ("account_security", "billing_subscription")


def label_counts(labels: DataFrame, label: str = "intent") -> DataFrame:
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def rare_labels(labels: DataFrame, minimum: int = 2, label: str = "intent") -> DataFrame:
    return label_counts(labels, label).filter(F.col("n") < minimum)


def majority_label(labels: DataFrame, order: str, label: str = "intent") -> DataFrame:
    """One row: the most common label; the one seen first wins a tie."""
    return (
        labels.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first"))
        .orderBy(F.desc("n"), "_first")
        .limit(1)
        .select(label, "n")
    )


def create_weak_labels(
    pairs: DataFrame,
    max_examples: int | None,
    seed: int,
    rules: Sequence[tuple[str, str]] = DEFAULT_RULES,
    id_col: str = "customer_tweet_id",
) -> DataFrame:
    """Rule labels for distinct, non-empty messages, at most ``max_examples`` of them.

    The bound is the size of the sample that a classifier is fitted on; ``None``
    labels every message.
    """
    def keyed(df: DataFrame) -> DataFrame:
        texts = with_matching_text(df, "customer_text", "_normalized")
        return texts.withColumn("_key", text_digest("_normalized")).drop("_normalized")

    # Texts are normalised once, for narrow rows of key and id; only what is chosen is read whole.
    spark = pairs.sparkSession
    with scratch(spark):
        keys = keyed(pairs.select(F.col(id_col).alias("_id"), "customer_text")).select("_key", "_id")
        first = stored(dedupe_first(keys, ["_key"], ["_id"]), "first-of-texts")
        chosen = stored(sample_n(first, max_examples, seed, "_id"), "sampled-texts", result=True)
    ids = chosen.select("_id").distinct()
    rows = keyed(pairs.join(ids, F.col(id_col).eqNullSafe(ids["_id"]), "left_semi"))
    same = rows["_key"].eqNullSafe(chosen["_key"]) & rows[id_col].eqNullSafe(chosen["_id"])
    sampled = dedupe_first(rows.join(chosen, same, "left_semi"), ["_key"], [id_col]).drop("_key")
    found = rule_label("customer_text", rules)
    return (
        sampled.withColumn("_rule", found)
        .withColumn("intent", F.col("_rule.intent"))
        .withColumn("rule_match", F.col("_rule.rule_match"))
        .withColumn("label_source", F.lit(WEAK_LABEL_SOURCE))
        .drop("_rule")
    )


def make_label_queue(
    pairs: DataFrame, size: int | None, seed: int, id_col: str = "customer_tweet_id"
) -> DataFrame:
    """A numbered sample, or with ``None`` all pairs, with empty annotation fields."""
    numbered = number_examples(sample_n(pairs, size, seed, id_col), seed, id_col)
    blanks = [F.lit("").alias(c) for c in BLANK_ANNOTATIONS]
    return numbered.select(
        "example_id",
        F.col(id_col).cast("string").alias("tweet_id"),
        F.col("thread_id").cast("string").alias("thread_id"),
        F.col("customer_text").alias("text"),
        F.col("brand_reply").alias("historical_reply"),
        *blanks,
        F.lit("no").alias("reviewed"),
    )


def trivial_baseline(messages: DataFrame, majority: DataFrame) -> DataFrame:
    """Majority label, always escalate, generic reply."""
    return messages.select(
        "*",
        majority.select("intent").scalar().alias("predicted_intent"),
        F.lit("escalate").alias("predicted_decision"),
        F.lit(GENERIC_REPLY).alias("draft_reply"),
    )


def keyword_baseline(
    messages: DataFrame,
    rules: Sequence[tuple[str, str]] = DEFAULT_RULES,
    text: str = "text",
    sensitive: Sequence[str] = SENSITIVE_LABELS,
    fallback: str = FALLBACK_LABEL,
) -> DataFrame:
    """First matching rule; escalate sensitive and unmatched messages."""
    label = F.col("_rule.intent")
    canned = F.concat(
        F.lit("Thanks for contacting us about "),
        humanize(label),
        F.lit(". Please try the relevant help-center steps."),
    )
    return (
        messages.withColumn("_rule", rule_label(text, rules, fallback))
        .withColumn("predicted_intent", label)
        .withColumn(
            "predicted_decision",
            F.when(label.isin(*sensitive, fallback), "escalate").otherwise("auto_handle"),
        )
        .withColumn(
            "draft_reply", F.when(label.isin(*sensitive), F.lit(GENERIC_REPLY)).otherwise(canned)
        )
        .withColumn("rule_match", F.col("_rule.rule_match"))
        .drop("_rule")
    )
