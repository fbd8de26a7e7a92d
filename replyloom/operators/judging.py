"""Scoring drafts with a pluggable judge, and agreement with human scores."""

from __future__ import annotations

import numbers
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.functions.text import is_blank, is_reviewed
from replyloom.functions.values import (
    RUBRIC_FIELDS,
    RUBRIC_VERSION,
    cache_key,
    parse_json_strict,
    parse_score,
)
from replyloom.operators.checks import (
    duplicate_keys,
    enforce,
    pairing_checks,
    require,
    require_columns,
    required_fields,
    size_between,
    stack,
    violations,
)
from replyloom.operators.joins import salted_join
from replyloom.operators.metrics import spearman_from_counts
from replyloom.operators.sampling import sample_n, sample_rank
from replyloom.session import scratch, scratch_folder, stored

PAIR = ("example_id", "system")
SCORE_COLUMNS = (*PAIR, "model", "rubric_version", "cache_key", *RUBRIC_FIELDS, "rationale")
ANSWER_SCHEMA = f"cache_key string, {', '.join(f'{f} int' for f in RUBRIC_FIELDS)}, rationale string"
# Keys that a task asks about, and so what a failure can cost.
ASK_TOGETHER = 64
# Tasks that a run makes at most: beyond, a task asks about more keys, so that starting tasks costs no more than asking.
ASK_TASKS = 2_000
# A scorer gets frames with cache_key, customer_text, draft_reply and evidence_json
# and returns cache_key, the five scores and a rationale.
Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def evidence_json(prediction: Column | str) -> Column:
    """The ``evidence`` of a prediction as canonical JSON; ``[]`` when absent, null when malformed."""
    parsed = parse_json_strict(prediction)
    is_object = F.rlike(F.trim(F.col(prediction) if isinstance(prediction, str) else prediction), F.lit(r"^\{"))
    evidence = F.try_variant_get(parsed, "$.evidence", "variant")
    return F.when(
        parsed.isNotNull() & is_object, F.coalesce(F.to_json(evidence), F.lit("[]"))
    )


def paired_sample(predictions: DataFrame, n: int | None, seed: int) -> DataFrame:
    """All systems of ``n`` sampled examples, or of all, with a reproducible order per example."""
    if n is not None and n < 1:
        raise ValueError("The number of sampled examples must be positive.")
    chosen = sample_n(predictions.select("example_id").distinct(), n, seed, "example_id")
    # Few rows per example (one per system), so the order column is local to a row.
    return predictions.join(chosen, "example_id", "left_semi").withColumn(
        "judge_order", sample_rank(seed, "example_id", "system")
    )


def usable_cache(cache: DataFrame, model: str) -> DataFrame:
    """Cached scores that are valid for this model and rubric, one per content key."""
    valid = (F.col("model") == model) & (F.col("rubric_version") == RUBRIC_VERSION)
    valid = valid & (F.coalesce("cache_key", F.lit("")) != "")
    for field in RUBRIC_FIELDS:
        valid = valid & F.col(field).cast("string").isin("1", "2", "3", "4", "5")
    row = F.struct(*[F.col(f).cast("int").alias(f) for f in RUBRIC_FIELDS], F.col("rationale"))
    last = F.max_by(row, F.struct(F.col("example_id"), F.col("system")))
    return cache.filter(valid).groupBy("cache_key").agg(last.alias("s")).select("cache_key", "s.*")


def cache_misses(content: DataFrame, cached: DataFrame) -> DataFrame:
    """Distinct content that has no score yet.

    The key is reduced per task before the shuffle, so content that many rows
    share is sent once per task.
    """
    distinct = content.groupBy("cache_key").agg(
        *[F.any_value(c).alias(c) for c in ("customer_text", "draft_reply", "evidence_json")]
    )
    return distinct.join(cached.select("cache_key"), "cache_key", "left_anti")


def check_answers(asked: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The answers of one batch, or an error: one per asked key, whole scores, a text rationale.

    Types are looked at before anything is converted, so ``True``, ``3.0`` and
    ``"4"`` are no scores.
    """
    columns = ["cache_key", *RUBRIC_FIELDS, "rationale"]
    if absent := sorted(set(columns) - set(answers.columns)):
        raise ValueError(f"The scorer's answer lacks {absent}")
    if sorted(asked["cache_key"]) != sorted(answers["cache_key"]):
        raise ValueError("The scorer must answer every asked key once and no other")
    for field in RUBRIC_FIELDS:
        for score in answers[field]:
            whole = isinstance(score, numbers.Integral) and not isinstance(score, (bool, np.bool_))
            if not whole or not 1 <= score <= 5:
                raise ValueError(f"The scorer gave {score!r} for {field}, not an integer from 1 to 5")
    if not all(isinstance(text, str) for text in answers["rationale"]):
        raise ValueError("The scorer gave a rationale that is not text")
    return answers[columns]


def _apply(scorer: Scorer) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield check_answers(batch, scorer(batch))

    return run


def score_content(content: DataFrame, scorer: Scorer) -> DataFrame:
    """Call the scorer on batches of content; what breaks ``check_answers`` raises."""
    return content.mapInPandas(_apply(scorer), ANSWER_SCHEMA)


def logged_answers(spark: SparkSession, log: str) -> DataFrame:
    """The answers in a log, one per key; none where there is no log yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(log)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(place, "*.parquet")
    )
    if not found:
        return spark.createDataFrame([], ANSWER_SCHEMA)
    row = F.struct(*RUBRIC_FIELDS, "rationale")
    answers = spark.read.schema(ANSWER_SCHEMA).parquet(log)
    return answers.groupBy("cache_key").agg(F.min(row).alias("s")).select("cache_key", "s.*")


def ask_and_log(content: DataFrame, scorer: Scorer, log: str, together: int = ASK_TOGETHER) -> DataFrame:
    """Answers for ``content`` from the log; keys that it lacks are asked first.

    About ``together`` keys make a task, or one in ``ASK_TASKS`` of them if that is
    more, and a task's answers are in the log for good when it ends, whatever
    becomes of the others: should the run fail, the next asks only what is left.  A key is part of the log's name space already:
    it covers model, rubric and content.
    """
    spark = content.sparkSession
    with scratch(spark):
        asked = stored(content.join(logged_answers(spark, log), "cache_key", "left_anti"), "asked-content")
        n = asked.count()
        if n:
            slices = asked.repartition(min(-(-n // together), ASK_TASKS), "cache_key")
            # Committed files of single tasks stay when the job fails.
            score_content(slices, scorer).write.mode("append").option(
                "mapreduce.fileoutputcommitter.algorithm.version", "2"
            ).parquet(log)
    return logged_answers(spark, log).join(content.select("cache_key"), "cache_key", "left_semi")


def upsert_scores(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """Replace rows with the same example, system and content; keep everything else."""
    keys = [*PAIR, "cache_key"]
    kept = cache.join(fresh.select(*keys), keys, "left_anti")
    return kept.select(*SCORE_COLUMNS).unionByName(fresh.select(*SCORE_COLUMNS))


def judging_checks(predictions: DataFrame, golden: DataFrame) -> DataFrame:
    require_columns(predictions, [*PAIR, "draft_reply", "prediction_json"], "Predictions")
    require_columns(golden, ["example_id", "text"], "Golden set")
    rules = required_fields([*PAIR, "prediction_json"])
    rules["malformed prediction_json"] = evidence_json("prediction_json").isNull()
    return stack(
        [
            size_between(predictions, 1, None, "no predictions"),
            violations(predictions, rules),
            violations(golden, required_fields(["example_id", "text"])),
            duplicate_keys(golden, ["example_id"], "duplicate golden example_id"),
            pairing_checks(predictions, golden),
        ]
    )


def keyed_content(predictions: DataFrame, golden: DataFrame, model: str | Column) -> DataFrame:
    """Predictions with their customer text, canonical evidence and content key."""
    name = F.lit(model) if isinstance(model, str) else model
    texts = golden.select("example_id", F.col("text").alias("customer_text"))
    return (
        predictions.join(texts, "example_id", "left")
        .withColumn("evidence_json", evidence_json("prediction_json"))
        .withColumn("cache_key", cache_key(name, "customer_text", "draft_reply", "evidence_json"))
    )


def judge_table(
    predictions: DataFrame,
    golden: DataFrame,
    scorer: Scorer,
    model: str,
    sample_size: int | None = 50,
    seed: int = 42,
    cache: DataFrame | None = None,
    check: bool = True,
    log: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(scores of this run, new cache)``; the scorer sees uncached content only, and once.

    ``sample_size=None`` judges every example.  Answers go to ``log``, a folder
    that outlives the run, task by task; a later run reads it before it asks (see
    ``ask_and_log``).  Without one, the log goes with the session's scratch.
    Either way answers are written before a result is built from them: an
    external judge is asked once per content, however often the results are
    read.  A missing, repeated or unasked answer raises.
    """
    # Read many times below; what a system says must not be worked out anew each time.
    predictions = stored(predictions, "judged-predictions")
    if check:
        enforce(judging_checks(predictions, golden), "Judging input")
    if cache is None:
        text = [f"{c} int" if c in RUBRIC_FIELDS else f"{c} string" for c in SCORE_COLUMNS]
        cache = predictions.sparkSession.createDataFrame([], ", ".join(text))
    spark = predictions.sparkSession
    content = stored(keyed_content(paired_sample(predictions, sample_size, seed), golden, model), "judged-content")
    known = usable_cache(cache, model)
    with scratch(spark):
        misses = stored(cache_misses(content, known), "cache-misses")
        fresh = stored(ask_and_log(misses, scorer, log or scratch_folder(spark, "answers")), "fresh-scores", result=True)
    scores = known.unionByName(fresh)
    # Every key has a score: it was cached, or the scorer answered it.
    run = salted_join(content, scores, ["cache_key"], "inner", list(PAIR)).select(
        *PAIR,
        F.lit(model).alias("model"),
        F.lit(RUBRIC_VERSION).alias("rubric_version"),
        "cache_key",
        *RUBRIC_FIELDS,
        "rationale",
    )
    return run, upsert_scores(cache, run)


def matched_scores(judge: DataFrame, human: DataFrame, check: bool = True) -> DataFrame:
    """Judge and human scores side by side for reviewed rows with the same content."""
    for df, name in ((judge, "Judge scores"), (human, "Human scores")):
        require_columns(df, [*PAIR, *RUBRIC_FIELDS], name)
    keyed = "cache_key" in human.columns
    workflow = keyed or "reviewed" in human.columns
    if workflow:
        require_columns(human, ["reviewed", "annotator"], "Human scores")
    if keyed:
        require_columns(judge, ["cache_key"], "Judge scores")
    if check:
        for df, name in ((judge, "Judge scores"), (human, "Human scores")):
            enforce(
                stack(
                    [
                        violations(df, required_fields(PAIR)),
                        duplicate_keys(df, list(PAIR), "duplicate example/system"),
                    ]
                ),
                name,
            )
    reviewed = human.filter(is_reviewed("reviewed")) if workflow else human
    extra = ["cache_key"] if keyed else []

    def side(df: DataFrame, name: str, more: list[str]) -> DataFrame:
        return df.select(*PAIR, *[F.col(c).alias(f"{name}_{c}") for c in (*RUBRIC_FIELDS, *more)])

    merged = side(judge, "judge", extra).join(
        side(reviewed, "human", extra + (["annotator"] if workflow else [])), list(PAIR)
    )
    if check:
        if merged.isEmpty():
            raise ValueError("Human and judge scores have no pair in common.")
        rules = {
            f"invalid {who} {f}": parse_score(f"{who}_{f}").isNull()
            for who in ("judge", "human")
            for f in RUBRIC_FIELDS
        }
        if workflow:
            rules["reviewed without annotator"] = is_blank("human_annotator")
        if keyed:
            rules["stale or blank cache_key"] = is_blank("human_cache_key") | (
                F.coalesce("human_cache_key", F.lit("")) != F.coalesce("judge_cache_key", F.lit(""))
            )
        require(merged, rules, "Matched scores")
    return merged


def judge_human_agreement(judge: DataFrame, human: DataFrame, check: bool = True) -> DataFrame:
    """Spearman, exact and within-one agreement per criterion.

    Scores are counted as (criterion, judge, human) cells first: at most 25
    cells per criterion, whatever the number of scored drafts.
    """
    merged = matched_scores(judge, human, check)
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("criterion"),
                parse_score(f"judge_{f}").alias("x"),
                parse_score(f"human_{f}").alias("y"),
            )
            for f in RUBRIC_FIELDS
        ]
    )
    counts = (
        merged.select(F.inline(cells))
        .groupBy("criterion", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    def share(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)) / F.sum("n")

    agreement = counts.groupBy("criterion").agg(
        share(F.col("x") == F.col("y")).alias("exact_agreement"),
        share(F.abs(F.col("x") - F.col("y")) <= 1).alias("within_one_agreement"),
        F.sum("n").alias("examples"),
    )
    return spearman_from_counts(counts, "criterion").join(agreement, "criterion")
