"""Data-quality checks: each is one aggregate pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.config import DECISIONS
from replyloom.functions.text import is_blank, is_empty_for_matching, is_reviewed, normalize_for_matching, strip
from replyloom.functions.values import RUBRIC_FIELDS, parse_json_strict, parse_score


def require_columns(df: DataFrame, columns: Sequence[str], name: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{name} is missing columns: {missing}")


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(check, violations)`` for row-level rules, all counted in one scan."""
    counted = df.agg(
        *[F.count_if(F.coalesce(rule, F.lit(False))).alias(f"c{i}") for i, rule in enumerate(rules.values())]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("violations"))
            for i, name in enumerate(rules)
        ]
    )
    return counted.select(F.inline(pairs))


def require(df: DataFrame, rules: Mapping[str, Column], name: str) -> None:
    """Raise with the counts when any rule is violated."""
    enforce(violations(df, rules), name)


def enforce(report: DataFrame, name: str) -> None:
    # A report has one row per check.
    bad = report.filter(F.col("violations") > 0).orderBy("check").collect()
    if bad:
        detail = "; ".join(f"{row['check']}: {row['violations']}" for row in bad)
        raise ValueError(f"{name} failed checks: {detail}")


def required_fields(columns: Sequence[str]) -> dict[str, Column]:
    return {f"blank {c}": is_blank(c) for c in sorted(columns)}


def duplicate_keys(df: DataFrame, keys: Sequence[str | Column], check: str) -> DataFrame:
    """Rows beyond the first of each key, as a ``(check, violations)`` row.

    Counting is a partial aggregate per task, so one heavily repeated key costs
    one counter.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.lit(check).alias("check"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations"),
    )


def matching_key(c: str) -> Column:
    """The normalised text of a column as a key of fixed size, never null.

    A key that could be null would bring a filter to the scan when it is joined
    on, and the text would be normalised there a second time.
    """
    return F.coalesce(F.sha2(normalize_for_matching(c), 256), F.lit(""))


def missing_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """``(only in left, only in right)``: distinct keys without a counterpart."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, list(keys), "left_anti"), b.join(a, list(keys), "left_anti")


def join_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], name: str, both: bool = False
) -> DataFrame:
    """Inner join that must find exactly one ``right`` row per ``left`` row.

    Repeated keys on the right, keys without a match and, with ``both``, repeated
    keys on the left or unused keys on the right raise before any row is joined.
    """
    require_columns(left, keys, name)
    require_columns(right, keys, name)
    lost, unused = missing_keys(left, right, keys)
    count = lambda df, check: df.agg(F.lit(check).alias("check"), F.count(F.lit(1)).alias("violations"))
    reports = [duplicate_keys(right, keys, "repeated key on the right"), count(lost, "key without a match")]
    if both:
        reports += [duplicate_keys(left, keys, "repeated key on the left"), count(unused, "unused key")]
    enforce(stack(reports), name)
    return left.join(right, list(keys))


def overlap(left: DataFrame, right: DataFrame, left_field: Column, right_field: Column, check: str) -> DataFrame:
    """Distinct values two tables share, as a ``(check, violations)`` row."""
    a = left.select(left_field.alias("_v")).distinct()
    b = right.select(right_field.alias("_v")).distinct()
    return a.join(b, "_v", "left_semi").agg(
        F.lit(check).alias("check"), F.count(F.lit(1)).alias("violations")
    )


def size_between(df: DataFrame, low: int, high: int | None, check: str) -> DataFrame:
    n = F.count(F.lit(1))
    bad = n < low if high is None else (n < low) | (n > high)
    return df.agg(F.lit(check).alias("check"), bad.cast("long").alias("violations"))


def stack(reports: Sequence[DataFrame]) -> DataFrame:
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def golden_checks(golden: DataFrame, intents: Sequence[str], low: int = 150, high: int = 250) -> DataFrame:
    """Everything that must hold before a golden set is used."""
    fields = ["example_id", "text", "intent", "decision", "thread_id", "reviewed"]
    require_columns(golden, fields, "Golden set")
    if "tweet_id" in golden.columns:
        fields.append("tweet_id")
    rules = {
        **required_fields(fields),
        "not reviewed": ~is_reviewed("reviewed"),
        "invalid decision": ~F.col("decision").isin(*DECISIONS),
        "unknown intent": ~F.col("intent").isin(*intents),
        "empty normalized text": is_empty_for_matching("text"),
    }
    return stack(
        [
            violations(golden, rules),
            size_between(golden, low, high, "size"),
            duplicate_keys(golden, [strip("example_id")], "duplicate example_id"),
            duplicate_keys(golden, [matching_key("text")], "duplicate normalized text"),
        ]
    )


def training_checks(training: DataFrame, intents: Sequence[str], minimum: int = 1) -> DataFrame:
    fields = ["text", "intent", "thread_id", "reviewed"]
    require_columns(training, fields, "Training set")
    fields += [c for c in ("example_id", "tweet_id", "customer_tweet_id") if c in training.columns]
    rules = {
        **required_fields(fields),
        "not reviewed": ~is_reviewed("reviewed"),
        "unknown intent": ~F.col("intent").isin(*intents),
        "empty normalized text": is_empty_for_matching("text"),
    }
    if "label_source" in training.columns:
        rules["label source not human"] = F.col("label_source") != "human"
    if "decision" in training.columns:
        rules["invalid decision"] = ~F.col("decision").isin(*DECISIONS)
    return stack(
        [
            violations(training, rules),
            size_between(training, minimum, None, "size"),
            duplicate_keys(training, [matching_key("text")], "duplicate normalized text"),
        ]
    )


def leakage_checks(training: DataFrame, golden: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """Shared texts, threads and identifiers between training/corpus and golden rows."""
    golden_text = matching_key("text")
    reports = [
        overlap(training, golden, matching_key("text"), golden_text, "training text"),
        overlap(training, golden, strip("thread_id"), strip("thread_id"), "training thread_id"),
    ]
    if "example_id" in training.columns:
        reports.append(
            overlap(training, golden, strip("example_id"), strip("example_id"), "training example_id")
        )
    if "tweet_id" in golden.columns:
        for field in ("tweet_id", "customer_tweet_id"):
            if field in training.columns:
                reports.append(
                    overlap(training, golden, strip(field), strip("tweet_id"), f"training {field}")
                )
    if corpus is not None:
        text = lambda c: strip(F.col(c).cast("string"))
        reports += [
            overlap(corpus, golden, text("thread_id"), text("thread_id"), "corpus thread_id"),
            overlap(corpus, golden, matching_key("customer_text"), golden_text, "corpus text"),
        ]
        if "tweet_id" in golden.columns:
            reports.append(
                overlap(corpus, golden, text("customer_tweet_id"), text("tweet_id"), "corpus message id")
            )
    return stack(reports)


def pairing_checks(predictions: DataFrame, known: DataFrame) -> DataFrame:
    """Every example has every system once, and no example is unknown."""
    per_example = predictions.groupBy("example_id").agg(
        F.count_distinct("system").alias("systems")
    )
    all_systems = predictions.agg(F.count_distinct("system")).scalar()
    short = per_example.filter(F.col("systems") < all_systems).agg(
        F.lit("example without every system").alias("check"),
        F.count(F.lit(1)).alias("violations"),
    )
    unknown = (
        predictions.select("example_id").distinct()
        .join(known.select("example_id").distinct(), "example_id", "left_anti")
        .agg(F.lit("unknown example_id").alias("check"), F.count(F.lit(1)).alias("violations"))
    )
    return stack(
        [short, unknown, duplicate_keys(predictions, ["example_id", "system"], "duplicate pair")]
    )


def column_checks(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``(check, violations)``: columns that a table lacks, and columns it should not have."""
    lost, extra = sorted(set(expected) - set(df.columns)), sorted(set(df.columns) - set(expected))
    rows = [("missing columns: " + ", ".join(lost), len(lost)), ("unexpected columns: " + ", ".join(extra), len(extra))]
    return df.sparkSession.createDataFrame(rows, "check string, violations long")


def worksheet_rules() -> dict[str, Column]:
    """Row rules of a human scoring worksheet."""
    reviewed = is_reviewed("reviewed")
    rules = {
        **required_fields(["example_id", "system", "text", "cache_key"]),
        "invalid cache_key": ~F.rlike("cache_key", F.lit("^[0-9a-f]{64}$")),
        "malformed evidence_json": parse_json_strict("evidence_json").isNull(),
        "reviewed not yes/no": ~F.lower(strip("reviewed")).isin("yes", "no"),
        "reviewed without annotator": reviewed & is_blank("annotator"),
    }
    for field in RUBRIC_FIELDS:
        rules[f"invalid {field}"] = ~is_blank(field) & parse_score(field).isNull()
        rules[f"reviewed without {field}"] = reviewed & is_blank(field)
    return rules


def provenance_checks(expected: DataFrame, current: DataFrame, check: str) -> DataFrame:
    """Compare two one-row fingerprints."""
    joined = expected.join(current, ["row_count", "digest"], "inner")
    return joined.agg(F.lit(check).alias("check"), (F.count(F.lit(1)) != 1).cast("long").alias("violations"))
