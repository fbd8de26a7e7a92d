"""Human review: worksheets, annotations, progress, failures and readiness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.config import DECISIONS, HUMAN_LABEL_SOURCE, INTENTS
from replyloom.functions.text import is_blank, is_reviewed, normalize_for_matching, strip
from replyloom.functions.values import RUBRIC_FIELDS, RUBRIC_VERSION
from replyloom.operators.checks import (
    column_checks,
    duplicate_keys,
    enforce,
    pairing_checks,
    provenance_checks,
    require,
    require_columns,
    required_fields,
    size_between,
    stack,
    violations,
    worksheet_rules,
)
from replyloom.operators.joins import salted_join
from replyloom.operators.judging import PAIR, evidence_json, keyed_content
from replyloom.operators.sampling import dedupe_first
from replyloom.session import stored

CONTENT = ("text", "draft_reply", "evidence_json")
ANNOTATIONS = (*RUBRIC_FIELDS, "annotator", "reviewed")
WORKSHEET_COLUMNS = (*PAIR, *CONTENT, "cache_key", *ANNOTATIONS)
FAILURE_FIELDS = ("failure_mode", "likely_cause", "risk", "proposed_fix", "reviewer")
PROGRESS_NOTE = "These are counts; whether the labels are right, only a reader can say."
READINESS_NOTE = "No blocker means that the files are there; a person still has to vouch for what they hold."
BLOCK_TRAINING = "The split leaves fewer than 100 reviewed rows to train on."
BLOCK_GOLDEN = "The golden set must have 150 to 250 rows."
BLOCK_EVIDENCE = "The evaluation has not produced: "
BLOCK_SCORES = "Nobody has scored a reply yet."


# -- scoring worksheets ------------------------------------------------------


def blank_worksheet(sample: DataFrame, predictions: DataFrame, golden: DataFrame) -> DataFrame:
    """Blind rows for exactly the judged sample, with content keys computed afresh."""
    judged = sample.select(*PAIR, F.col("model").alias("_model"), F.col("cache_key").alias("_judged_key"))
    drafts = predictions.select(*PAIR, "draft_reply", "prediction_json")
    content = keyed_content(judged.join(drafts, list(PAIR), "left"), golden, F.col("_model"))
    return content.select(
        *PAIR,
        F.col("customer_text").alias("text"),
        "draft_reply",
        "evidence_json",
        "cache_key",
        *[F.lit("").alias(c) for c in (*RUBRIC_FIELDS, "annotator")],
        F.lit("no").alias("reviewed"),
        "_judged_key",
    )


def sample_checks(sample: DataFrame, predictions: DataFrame, golden: DataFrame) -> DataFrame:
    """The judged sample must hold whole examples with every predicted system."""
    pairs = predictions.select(*PAIR).distinct()
    wrong_rubric = {"rubric_version": F.col("rubric_version") != RUBRIC_VERSION}
    expected = (
        sample.select("example_id").distinct().join(pairs, "example_id").agg(F.count(F.lit(1))).scalar()
    )
    unknown = sample.join(pairs, list(PAIR), "left_anti").agg(
        F.lit("pair without prediction").alias("check"), F.count(F.lit(1)).alias("violations")
    )
    incomplete = sample.agg(
        F.lit("incomplete sample").alias("check"),
        (F.count(F.lit(1)) != expected).cast("long").alias("violations"),
    )
    return stack(
        [
            size_between(sample, 1, None, "empty sample"),
            size_between(predictions, 1, None, "no predictions"),
            size_between(golden, 1, None, "empty golden set"),
            violations(sample, {**required_fields([*PAIR, "model", "rubric_version", "cache_key"]), **wrong_rubric}),
            violations(golden, required_fields(["example_id", "text"])),
            duplicate_keys(sample, list(PAIR), "duplicate judged pair"),
            duplicate_keys(golden, ["example_id"], "duplicate golden example_id"),
            pairing_checks(predictions, golden),
            unknown,
            incomplete,
        ]
    )


def prepare_worksheet(
    sample: DataFrame,
    predictions: DataFrame,
    golden: DataFrame,
    existing: DataFrame | None = None,
) -> DataFrame:
    """A blind worksheet; annotations of identical existing rows are carried over."""
    require_columns(sample, [*PAIR, "model", "rubric_version", "cache_key"], "Judge sample")
    # Read many times below: neither the systems nor the content keys are worked out anew each time.
    sample, predictions = stored(sample, "judged-sample"), stored(predictions, "judged-predictions")
    enforce(sample_checks(sample, predictions, golden), "Judge sample")
    # Every stored prediction must be readable, not only the judged ones.
    require(predictions, {"malformed prediction": evidence_json("prediction_json").isNull()}, "Predictions")
    fresh = blank_worksheet(sample, predictions, golden)
    require(
        fresh,
        {
            "stale cache_key": F.coalesce("cache_key", F.lit("")) != F.col("_judged_key"),
            "malformed prediction": F.col("evidence_json").isNull(),
        },
        "Judge sample",
    )
    fresh = fresh.select(*WORKSHEET_COLUMNS)
    return fresh if existing is None else merge_worksheet(fresh, existing)


def compare_worksheets(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """Full outer match of both worksheets with a ``status`` per pair."""
    before = existing.select(*PAIR, *[F.col(c).alias(f"old_{c}") for c in WORKSHEET_COLUMNS[2:]])
    now = fresh.withColumn("_fresh", F.lit(True))
    joined = now.join(before.withColumn("_old", F.lit(True)), list(PAIR), "full_outer")
    has_work = is_reviewed("old_reviewed")
    for c in (*RUBRIC_FIELDS, "annotator"):
        has_work = has_work | ~is_blank(f"old_{c}")
    changed = F.lit(False)
    for c in (*CONTENT, "cache_key"):
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"old_{c}"))
    status = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_fresh").isNull() & has_work, "removed with work")
        .when(F.col("_fresh").isNull(), "removed")
        .when(changed, "changed")
        .otherwise("kept")
    )
    return joined.withColumn("status", status)


def merge_worksheet(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """New rows plus the annotations of unchanged rows; conflicts raise before any result."""
    enforce(column_checks(existing, WORKSHEET_COLUMNS), "Human worksheet")
    enforce(
        stack(
            [
                violations(existing, worksheet_rules()),
                duplicate_keys(existing, list(PAIR), "duplicate worksheet pair"),
            ]
        ),
        "Human worksheet",
    )
    compared = compare_worksheets(fresh, existing)
    require(
        compared,
        {
            "removed row with annotations": F.col("status") == "removed with work",
            "changed content": F.col("status") == "changed",
        },
        "Worksheet merge",
    )
    kept = F.col("status") == "kept"
    return compared.filter(F.col("_fresh").isNotNull()).select(
        *PAIR,
        *CONTENT,
        "cache_key",
        *[F.when(kept, F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) for c in ANNOTATIONS],
    )


def _judged(records: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records with the row they address and whether their key is repeated in the batch.

    Identical records become one with a count and are multiplied again after the
    join, so that copies, which no salt can tell apart, cannot make a key hot;
    ``known`` and the count have one row per key, and different records of a hot
    key are salted.
    """
    repeated = records.groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    distinct = records.groupBy(*records.columns).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    targets = known.join(repeated, list(keys), "full_outer")
    spread = [c for c in records.columns if c not in keys]
    joined = salted_join(distinct, targets, keys, "left", spread)
    again = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return joined.withColumn("_copy", again).drop("_copy", "_copies")


def apply_scores(worksheet: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply a batch of human scores; ``(worksheet, rejected records with reason)``.

    A record needs five integer scores from 1 to 5, an annotator and the exact
    pair and content key of one worksheet row.
    """
    keys = [*PAIR, "cache_key"]
    known = worksheet.select(*keys).withColumn("_known", F.lit(True))
    bad_score = F.lit(False)
    for f in RUBRIC_FIELDS:
        bad_score = bad_score | ~F.coalesce(F.col(f).between(1, 5), F.lit(False))
    reason = (
        F.when(bad_score, "scores must be integers from 1 to 5")
        .when(is_blank("annotator"), "annotator is required")
        .when(F.col("_known").isNull(), "unknown row or stale cache_key")
        .when(F.col("_repeated"), "more than one record for the row")
    )
    judged = _judged(records, known, keys).withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).select(
        *keys,
        *[F.col(f).cast("string").alias(f"_new_{f}") for f in RUBRIC_FIELDS],
        F.col("annotator").alias("_new_annotator"),
        F.lit("yes").alias("_new_reviewed"),
    )
    updated = worksheet.join(good, keys, "left").select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in ANNOTATIONS else F.col(c) for c in worksheet.columns]
    )
    return updated, judged.filter(F.col("reason").isNotNull()).select(*records.columns, "reason")


# -- annotation queue --------------------------------------------------------

ANNOTATION_FIELDS = (
    "intent",
    "decision",
    "escalation_reason",
    "required_reply_points",
    "forbidden_claims",
    "annotator",
)


def annotation_rejection(intents: Sequence[str]) -> Column:
    """Why one annotation record cannot be applied; null when it can."""
    valid = F.coalesce(F.col("intent").isin(*intents) & F.col("decision").isin(*DECISIONS), F.lit(False))
    return (
        F.when(~valid, "select a valid intent and decision")
        .when(is_blank("annotator"), "annotator name is required")
        .when(
            (F.col("decision") == "escalate") & is_blank("escalation_reason"),
            "explain why this case needs human review",
        )
        .when(
            is_blank("required_reply_points") | is_blank("forbidden_claims"),
            "provide required reply points and forbidden claims",
        )
        .when(
            F.col("_queued_text").isNull() | ~F.col("_queued_text").eqNullSafe(F.col("expected_text")),
            "unknown or changed example",
        )
        .when(
            (normalize_for_matching("expected_text") == "") | is_blank("_queued_thread"),
            "unusable text or thread id",
        )
        .when(F.col("_repeated"), "more than one record for the example")
    )


def apply_annotations(
    queue: DataFrame, records: DataFrame, intents: Sequence[str] = INTENTS
) -> tuple[DataFrame, DataFrame]:
    """Apply ``records(example_id, expected_text, ...)``; ``(queue, rejected with reason)``."""
    enforce(duplicate_keys(queue, ["example_id"], "duplicate example_id"), "Annotation queue")
    queued = queue.select(
        "example_id", F.col("text").alias("_queued_text"), F.col("thread_id").alias("_queued_thread")
    )
    judged = _judged(records, queued, ["example_id"]).withColumn(
        "reason", annotation_rejection(intents)
    )
    new = {c: F.col(c) for c in ANNOTATION_FIELDS[:-1]}
    new["annotator"] = strip("annotator")
    new["reviewed"] = F.lit("yes")
    if "label_source" in queue.columns:
        new["label_source"] = F.lit(HUMAN_LABEL_SOURCE)
    good = judged.filter(F.col("reason").isNull()).select(
        "example_id", *[value.alias(f"_new_{c}") for c, value in new.items()]
    )
    updated = queue.join(good, "example_id", "left").select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in new else F.col(c) for c in queue.columns]
    )
    return updated, judged.filter(F.col("reason").isNotNull()).select(*records.columns, "reason")


def pending_work(queue: DataFrame) -> DataFrame:
    return queue.filter(~F.coalesce(is_reviewed("reviewed"), F.lit(False)))


def annotation_progress(
    queue: DataFrame,
    intents: Sequence[str] = INTENTS,
    golden_size: int = 200,
    order: str = "example_id",
) -> DataFrame:
    """One row of counts that tell whether a split can be made."""
    if not 150 <= golden_size <= 250:
        raise ValueError("A golden set has 150 to 250 rows.")
    require_columns(
        queue, ["example_id", "text", "thread_id", "intent", "decision", "reviewed"], "Annotation queue"
    )
    normalized = normalize_for_matching("text")
    valid = F.col("intent").isin(*intents) & F.col("decision").isin(*DECISIONS) & (normalized != "")
    for field in ("example_id", "thread_id", "text"):
        valid = valid & ~is_blank(field)
    valid = F.coalesce(valid, F.lit(False))
    reviewed = F.coalesce(is_reviewed("reviewed"), F.lit(False))
    totals = queue.agg(
        F.count(F.lit(1)).alias("queue_rows"),
        F.count_if(reviewed).alias("reviewed_rows"),
        F.count_if(reviewed & ~valid).alias("invalid_reviewed_rows"),
    )
    usable = queue.filter(reviewed & valid).withColumn("_normalized", normalized)
    usable = dedupe_first(usable, ["_normalized"], [order])
    usable = dedupe_first(usable, ["thread_id"], [order])
    counts = usable.groupBy("intent").agg(F.count(F.lit(1)).alias("n"))
    # At most one entry per configured intent.
    per_intent = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("usable_unique_thread_rows"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("intent", "n")))).alias("intent_counts"),
    )
    both = totals.withColumn("_k", F.lit(1)).join(per_intent.withColumn("_k", F.lit(1)), "_k").drop("_k")
    needed = golden_size + 100
    rare = F.map_filter("intent_counts", lambda _, n: n < 2)
    absent = F.array_except(
        F.array_sort(F.array(*[F.lit(i) for i in intents])), F.map_keys("intent_counts")
    )
    return both.select(
        "queue_rows",
        "reviewed_rows",
        "invalid_reviewed_rows",
        "usable_unique_thread_rows",
        "intent_counts",
        F.lit(golden_size).alias("golden_size"),
        F.lit(needed).alias("minimum_reviewed_rows"),
        F.greatest(F.lit(0), F.lit(needed) - F.col("usable_unique_thread_rows")).alias(
            "additional_usable_rows_needed"
        ),
        rare.alias("intents_with_fewer_than_two_rows"),
        absent.alias("unrepresented_intents"),
        (
            (F.col("usable_unique_thread_rows") >= needed)
            & (F.size(F.map_keys(rare)) == 0)
            & (F.col("invalid_reviewed_rows") == 0)
        ).alias("split_precheck_passed"),
        F.lit(PROGRESS_NOTE).alias("note"),
    )


# -- failures and readiness --------------------------------------------------


def error_rows(predictions: DataFrame) -> DataFrame:
    """Wrong predictions with their error flags."""
    wrong_intent = ~F.col("actual_intent").eqNullSafe(F.col("predicted_intent"))
    wrong_decision = ~F.col("actual_decision").eqNullSafe(F.col("predicted_decision"))
    unsafe = (F.col("actual_decision") == "escalate") & (F.col("predicted_decision") == "auto_handle")
    return (
        predictions.withColumn("intent_error", wrong_intent)
        .withColumn("decision_error", wrong_decision)
        .withColumn("false_auto", unsafe)
        .filter(F.col("intent_error") | F.col("decision_error"))
    )


def failure_checks(
    main: DataFrame, golden: DataFrame, manifest: Mapping[str, DataFrame] | None = None,
    current: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One main prediction per golden example, and unchanged inputs."""
    ids = main.select("example_id").distinct()
    truth = golden.select("example_id").distinct()

    def absent(a: DataFrame, b: DataFrame, check: str) -> DataFrame:
        return a.join(b, "example_id", "left_anti").agg(
            F.lit(check).alias("check"), F.count(F.lit(1)).alias("violations")
        )

    reports = [
        duplicate_keys(main, ["example_id"], "duplicate main prediction"),
        duplicate_keys(golden, ["example_id"], "duplicate golden example_id"),
        absent(ids, truth, "prediction without golden example"),
        absent(truth, ids, "golden example without prediction"),
        main.agg(
            F.lit("no main prediction").alias("check"),
            (F.count(F.lit(1)) == 0).cast("long").alias("violations"),
        ),
    ]
    for name, expected in (manifest or {}).items():
        reports.append(provenance_checks(expected, current[name], f"stale {name}"))
    return stack(reports)


def failure_queue(
    predictions: DataFrame,
    golden: DataFrame,
    system: str = "main",
    manifest: Mapping[str, DataFrame] | None = None,
    current: Mapping[str, DataFrame] | None = None,
    check: bool = True,
) -> DataFrame:
    """All errors of one system, unsafe automatic handling first, ready for review."""
    main = predictions.filter(F.col("system") == system)
    if check:
        enforce(failure_checks(main, golden, manifest, current), "Failure queue")
    rows = error_rows(main).join(golden.select("example_id", "text"), "example_id")
    for field in FAILURE_FIELDS:
        rows = rows.withColumn(field, F.lit(""))
    return rows.withColumn("reviewed", F.lit("no")).orderBy(
        F.desc("false_auto"), F.desc("decision_error"), "example_id"
    )


def readiness_status(
    queue: DataFrame,
    training: DataFrame | None,
    golden: DataFrame | None,
    human_scores: DataFrame | None,
    evidence_present: Mapping[str, bool],
    intents: Sequence[str] = INTENTS,
    golden_size: int = 200,
    order: str = "example_id",
) -> DataFrame:
    """One row: sizes, open blockers and the standing need for a human sign-off."""

    def rows(df: DataFrame | None, name: str, where: Column | None = None) -> DataFrame:
        if df is None:
            return queue.limit(0).agg(F.count(F.lit(1)).alias(name)).withColumn("_k", F.lit(1))
        kept = df if where is None else df.filter(where)
        return kept.agg(F.count(F.lit(1)).alias(name)).withColumn("_k", F.lit(1))

    done = human_scores if human_scores is not None and "reviewed" in human_scores.columns else None
    status = annotation_progress(queue, intents, golden_size, order).withColumn("_k", F.lit(1))
    for part in (
        rows(training, "training_rows"),
        rows(golden, "golden_rows"),
        rows(done, "reviewed_human_score_rows", F.col("reviewed") == "yes" if done is not None else None),
    ):
        status = status.join(part, "_k")
    blockers = [
        F.when(
            F.col("training_rows") < 100,
            BLOCK_TRAINING,
        ),
        F.when(
            ~F.col("golden_rows").between(150, 250), BLOCK_GOLDEN
        ),
        *[
            F.lit(f"{BLOCK_EVIDENCE}{name}")
            for name, present in evidence_present.items()
            if not present
        ],
        F.when(
            F.col("reviewed_human_score_rows") == 0,
            BLOCK_SCORES,
        ),
    ]
    return status.drop("_k", "note").select(
        "*",
        F.array_compact(F.array(*blockers)).alias("blockers"),
        F.lit(False).alias("final_submission_ready"),
        F.lit(READINESS_NOTE).alias("note"),
    )
