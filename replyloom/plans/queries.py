"""One query per operator, each over whole given tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.config import Policy, TriageConfig
from replyloom.functions import rules, text, values
from replyloom.operators import (
    checks,
    digests,
    evaluation,
    heldout,
    judging,
    labels,
    metrics,
    model,
    pairs,
    policy,
    responses,
    retrieval,
    review,
    sampling,
    tfidf,
    threads,
    upkeep,
)
from replyloom.plans import inputs
from replyloom.plans.inputs import LANGUAGE_RULES, LANGUAGES, table
from replyloom.session import scratch, shared_folder, stored
from replyloom.sources import artifacts, tables
from replyloom.streaming.triage_stream import triage_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DESK_POLICY = Policy(
    confidence_threshold=0.4,
    margin_threshold=0.1,
    similarity_threshold=0.05,
    always_escalate=("es",),
    auto_handle=("en", "fr", "de"),
    risk_terms=("thnd", "erheb"),
)
DESK_CONFIG = TriageConfig(
    intents=(*LANGUAGES, "other_unclear"),
    policy=DESK_POLICY,
    reply_templates=inputs.TEMPLATES,
    blocked_patterns=inputs.GUIDANCE_BLOCKED,
    suggestion_start=inputs.GUIDANCE_START,
)


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.documents(spark, sf)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.reply_pairs(inputs.messages(spark, sf), inputs.DESK)


def _direct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs whose thread is known from the conversation, for queries about later steps."""
    known = inputs.messages(spark, sf).select(
        "tweet_id", (F.floor(F.col("tweet_id") / 1000) * 1000).alias("thread_id")
    )
    return pairs.reply_pairs(inputs.messages(spark, sf), inputs.DESK, roots=known)


# -- sources and sinks -------------------------------------------------------


@query("read_messages")
def read_messages(spark, sf):
    path = _new_folder(spark, "messages") + ".csv"
    tables.write_table(inputs.messages(spark, sf), path, form="csv")
    return tables.read_messages(
        spark, path, ["tweet_id", "author_id", "inbound", "created_at", "text", "in_response_to_tweet_id"]
    )


@query("read_table")
def read_table(spark, sf):
    path = _new_folder(spark, "table")
    tables.write_table(_documents(spark, sf).select("doc_id", "text", "lang", "source"), path, form="csv")
    return tables.read_table(spark, path, ["doc_id", "text", "lang", "source"])


@query("write_table")
def write_table(spark, sf):
    path = _new_folder(spark, "parquet")
    tables.write_table(_documents(spark, sf), path)
    return spark.read.parquet(path)


@query("write_if_empty")
def write_if_empty(spark, sf):
    path = _new_folder(spark, "queue")
    queue = labels.make_label_queue(inputs.document_pairs(spark, sf), None, 42)
    tables.write_if_empty(queue, path)
    try:
        tables.write_if_empty(queue, path)
        refused = False
    except ValueError:
        refused = True
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("queue_rows"), F.lit(refused).alias("refused_second_write")
    )


@query("fingerprint")
def fingerprint(spark, sf):
    return values.fingerprint(_documents(spark, sf), ["doc_id", "text", "lang", "source", "n_chars"])


@query("changed_ranges")
def changed_ranges(spark, sf):
    """Three documents are edited; the trees name the ranges of ids they lie in."""
    docs = _documents(spark, sf).select("doc_id", "text", "lang", "source", "n_chars")
    three = docs.select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(3)
    edited = docs.join(F.broadcast(three.withColumn("_edit", F.lit(True))), "doc_id", "left")
    after = edited.withColumn("text", F.when(F.col("_edit"), F.concat(F.coalesce("text", F.lit("")), F.lit(" edited"))).otherwise(F.col("text")))
    trees = [stored(digests.digest_tree(d, "doc_id", docs.columns, 16, 8), "digest-tree") for d in (docs, after.drop("_edit"))]
    return digests.changed_ranges(*trees, 16, 8)


# -- text --------------------------------------------------------------------


@query("normalize_text")
def normalize_text(spark, sf):
    return _documents(spark, sf).select("doc_id", text.normalize_text("text").alias("cleaned"))


@query("sanitize_reply")
def sanitize_reply(spark, sf):
    return _documents(spark, sf).select("doc_id", text.sanitize_reply("text").alias("reply"))


@query("normalize_for_matching")
def normalize_for_matching(spark, sf):
    return _documents(spark, sf).select("doc_id", text.normalize_for_matching("text").alias("matching"))


@query("safe_guidance")
def safe_guidance(spark, sf):
    guidance = text.safe_guidance("text", inputs.GUIDANCE_BLOCKED, inputs.GUIDANCE_START)
    return _documents(spark, sf).select("doc_id", guidance.alias("guidance"))


@query("rule_label")
def rule_label(spark, sf):
    return (
        _documents(spark, sf)
        .withColumn("r", rules.rule_label("text", LANGUAGE_RULES))
        .select("doc_id", "r.intent", "r.rule_match")
    )


@query("matched_terms")
def matched_terms(spark, sf):
    return inputs.risk_hits(_documents(spark, sf))


@query("cache_key")
def cache_key(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", values.cache_key(F.lit("judge-a"), "text", "source", "lang").alias("cache_key")
    )


@query("humanize")
def humanize(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", text.humanize(F.concat_ws("_", "lang", "source")).alias("label")
    )


@query("draft_reply")
def draft_reply(spark, sf):
    golden = inputs.labelled(spark, sf)
    drafted = responses.draft_reply(
        F.col("intent"),
        F.when(F.col("quality") == 1, F.col("source")).otherwise(""),
        F.col("decision"),
        inputs.TEMPLATES,
    )
    return golden.select("example_id", drafted.alias("draft_reply"))


@query("validate_message")
def validate_message(spark, sf):
    accepted, rejected = text.validate_message(_documents(spark, sf))
    return (
        accepted.select("doc_id", F.lit("").alias("reason"))
        .unionByName(rejected.select("doc_id", "reason"))
    )


@query("parse_json_strict")
def parse_json_strict(spark, sf):
    props = table(spark, sf, "events").select("event_id", "props")
    both = F.array(F.col("props"), F.concat("props", F.lit(",")), F.replace("props", F.lit("}"), F.lit(', "k": 1}')))
    return props.select("event_id", F.posexplode(both).alias("variant", "raw")).select(
        "event_id", "variant", F.to_json(values.parse_json_strict("raw")).alias("parsed")
    )


@query("parse_score")
def parse_score(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", values.parse_score(F.col("value").cast("string")).alias("score")
    )


@query("is_reviewed")
def is_reviewed(spark, sf):
    return inputs.labelled(spark, sf).select("example_id", text.is_reviewed("reviewed").alias("done"))


# -- filters -----------------------------------------------------------------


@query("brand_direct_replies")
def brand_direct_replies(spark, sf):
    return pairs.brand_direct_replies(inputs.messages(spark, sf), inputs.DESK).select(
        "tweet_id", "in_response_to_tweet_id", "created_at"
    )


@query("usable_pairs")
def usable_pairs(spark, sf):
    cleaned = inputs.document_pairs(spark, sf).withColumns(
        {"customer_text": text.normalize_text("customer_text"), "brand_reply": text.sanitize_reply("brand_reply")}
    )
    return cleaned.filter(pairs.is_usable_pair()).select("customer_tweet_id", "brand_reply")


@query("nonempty_normalized")
def nonempty_normalized(spark, sf):
    turns = text.with_matching_text(inputs.messages(spark, sf), "text", "matching")
    return turns.groupBy("author_id").agg(F.count(F.lit(1)).alias("n"))


@query("reviewed_rows")
def reviewed_rows(spark, sf):
    return inputs.labelled(spark, sf).filter(text.is_reviewed("reviewed")).select("example_id", "intent")


@query("pending_work")
def pending_work(spark, sf):
    return review.pending_work(inputs.labelled(spark, sf)).select("example_id", "decision")


@query("safe_evidence")
def safe_evidence(spark, sf):
    """Each document as the one case found for a message of its own."""
    similarity = F.pmod(F.col("customer_tweet_id"), F.lit(50)) / 50.0
    fields = {f: F.col("customer_text") for f in responses.EVIDENCE_FIELDS}
    fields |= {"customer_tweet_id": F.col("customer_tweet_id"), "similarity": similarity}
    found = F.array(F.struct(*[c.alias(f) for f, c in fields.items()]))
    safe = responses.safe_candidates(found, 0.35, inputs.GUIDANCE_BLOCKED, inputs.GUIDANCE_START)
    docs = inputs.document_pairs(spark, sf).select(F.explode(safe).alias("e"))
    return docs.select("e.customer_tweet_id", "e.similarity", F.col("e.safe_guidance").alias("guidance"))


@query("usable_cache")
def usable_cache(spark, sf):
    return judging.usable_cache(inputs.judge_scores(spark, sf), "judge-a").drop("rationale")


@query("error_rows")
def error_rows(spark, sf):
    return review.error_rows(inputs.predictions(spark, sf)).select(
        "example_id", "system", "intent_error", "decision_error", "false_auto"
    )


# -- joins -------------------------------------------------------------------


@query("reply_pairs")
def reply_pairs(spark, sf):
    return pairs.reply_pairs(inputs.flooded_messages(spark, sf), inputs.DESK)


@query("reply_pairs_lexical")
def reply_pairs_lexical(spark, sf):
    turns = inputs.flooded_messages(spark, sf)
    known = turns.select(
        "tweet_id", (F.floor(F.col("tweet_id") / 1000) * 1000).alias("thread_id")
    ).distinct()
    return pairs.reply_pairs(turns, inputs.DESK, order="lexical", roots=known).select(
        "customer_tweet_id", "reply_tweet_id", "thread_id"
    )


@query("wanted_messages")
def wanted_messages(spark, sf):
    turns = inputs.messages(spark, sf)
    wanted = pairs.wanted_messages(turns, pairs.brand_direct_replies(turns, inputs.DESK))
    return wanted.select("tweet_id", "author_id", "text")


@query("thread_root")
def thread_root(spark, sf):
    return threads.thread_root(inputs.messages(spark, sf))


@query("thread_root_forest")
def thread_root_forest(spark, sf):
    return threads.thread_root(inputs.forest(spark, sf))


@query("exclude_held_out")
def exclude_held_out(spark, sf):
    kept = heldout.exclude_held_out(inputs.document_pairs(spark, sf), inputs.held_out(spark, sf))
    return kept.select("customer_tweet_id", "thread_id")


@query("predictions_with_text")
def predictions_with_text(spark, sf):
    golden = inputs.labelled(spark, sf).select("example_id", "text")
    joined = checks.join_one(inputs.predictions(spark, sf), golden, ["example_id"], "Golden set")
    return joined.select("example_id", "system", "draft_reply", F.length("text").alias("text_chars"))


@query("cache_misses")
def cache_misses(spark, sf):
    golden = inputs.labelled(spark, sf)
    content = judging.keyed_content(inputs.predictions(spark, sf), golden, "judge-a")
    reviewed = golden.filter(text.is_reviewed("reviewed"))
    cached = content.join(reviewed.select("example_id"), "example_id", "left_semi")
    return judging.cache_misses(content, cached.select("cache_key").distinct()).select(
        "cache_key", "draft_reply", "evidence_json"
    )


@query("compare_worksheets")
def compare_worksheets(spark, sf):
    scored = inputs.human_scores(spark, sf)
    blank = scored.withColumns({f: F.lit("") for f in (*values.RUBRIC_FIELDS, "annotator")}).withColumn(
        "reviewed", F.lit("no")
    )
    short = F.length("text") < 500
    fresh = blank.filter(~short).withColumn(
        "draft_reply", F.when(F.length("text") > 5000, F.lit("new")).otherwise(F.col("draft_reply"))
    )
    kept = scored.filter(F.col("draft_reply") != "src3")
    return review.compare_worksheets(fresh, kept).select("example_id", "system", "status")


@query("merge_worksheet")
def merge_worksheet(spark, sf):
    scored = inputs.human_scores(spark, sf)
    blank = scored.withColumns({f: F.lit("") for f in (*values.RUBRIC_FIELDS, "annotator")}).withColumn(
        "reviewed", F.lit("no")
    )
    kept = scored.filter(F.col("draft_reply") != "src3")
    return review.merge_worksheet(blank, kept).drop("text")


@query("apply_annotations")
def apply_annotations(spark, sf):
    queue = labels.make_label_queue(inputs.document_pairs(spark, sf), None, 42)
    golden = inputs.labelled(spark, sf)
    records = queue.join(golden.select("tweet_id", "quality", "intent", "decision"), "tweet_id").select(
        "example_id",
        F.when(F.col("quality") == 1, queue["text"]).otherwise("changed").alias("expected_text"),
        golden["intent"].alias("intent"),
        golden["decision"].alias("decision"),
        F.when(golden["decision"] == "escalate", "unsafe").otherwise("").alias("escalation_reason"),
        F.lit("none").alias("required_reply_points"),
        F.lit("none").alias("forbidden_claims"),
        F.lit(" reader ").alias("annotator"),
    )
    updated, _ = review.apply_annotations(queue, records, LANGUAGES)
    return updated.select(
        "example_id", "tweet_id", "intent", "decision", "escalation_reason", "annotator", "reviewed"
    )


@query("rejected_annotations")
def rejected_annotations(spark, sf):
    queue = inputs.labelled(spark, sf)
    records = queue.select(
        "example_id",
        F.when(F.col("n_chars") > 400, F.col("text")).otherwise("changed").alias("expected_text"),
        "intent",
        "decision",
        F.lit("").alias("escalation_reason"),
        F.lit("none").alias("required_reply_points"),
        F.when(F.col("source") == "src3", "").otherwise("none").alias("forbidden_claims"),
        F.lit("reader").alias("annotator"),
    )
    blank = queue.withColumns({c: F.lit("") for c in review.ANNOTATION_FIELDS})
    _, rejected = review.apply_annotations(blank, records, ("en", "fr", "es"))
    return rejected.select("example_id", "reason")


@query("apply_scores")
def apply_scores(spark, sf):
    sheet = inputs.human_scores(spark, sf).withColumns(
        {f: F.lit("") for f in (*values.RUBRIC_FIELDS, "annotator")}
    ).withColumn("reviewed", F.lit("no"))
    records = inputs.judge_scores(spark, sf).select(
        "example_id",
        "system",
        "cache_key",
        *[(F.col(f).cast("int") + F.when(F.col(f) == "5", 1).otherwise(0)).alias(f) for f in values.RUBRIC_FIELDS],
        F.lit("reader").alias("annotator"),
    )
    updated, _ = review.apply_scores(sheet, records)
    return updated.drop("text", "evidence_json")


# -- aggregations and metrics ------------------------------------------------


@query("brand_profile")
def brand_profile(spark, sf):
    return pairs.brand_profile(inputs.messages(spark, sf), ["assistant", "system", "nobody"])


@query("label_counts")
def label_counts(spark, sf):
    return labels.label_counts(inputs.labelled(spark, sf))


@query("rare_labels")
def rare_labels(spark, sf):
    rows = inputs.labelled(spark, sf)
    return labels.rare_labels(rows, minimum=60)


@query("majority_label")
def majority_label(spark, sf):
    return labels.majority_label(inputs.labelled(spark, sf), "example_id")


@query("annotation_progress")
def annotation_progress(spark, sf):
    progress = review.annotation_progress(inputs.labelled(spark, sf), (*LANGUAGES, "it"), 150)
    return progress.withColumns(
        {
            "intent_counts": F.to_json("intent_counts"),
            "intents_with_fewer_than_two_rows": F.to_json("intents_with_fewer_than_two_rows"),
            "unrepresented_intents": F.array_join("unrepresented_intents", ","),
        }
    ).drop("note")


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("system_metrics")
def system_metrics(spark, sf):
    ratios = [
        "accuracy",
        "macro_f1",
        "escalation_precision",
        "must_escalate_recall",
        "escalation_f1",
        "false_auto_handle_rate",
        "false_auto_handle_fraction_among_auto_handled",
        "auto_handle_coverage",
    ]
    return _rounded(metrics.system_metrics(inputs.predictions(spark, sf)), ratios)


@query("per_label_report")
def per_label_report(spark, sf):
    return _rounded(
        metrics.per_label_report(inputs.predictions(spark, sf)), ["precision", "recall", "f1"]
    )


@query("report_averages")
def report_averages(spark, sf):
    report = metrics.averages(metrics.per_label_report(inputs.predictions(spark, sf)))
    return _rounded(report, [c for c in report.columns if c.startswith(("macro", "weighted"))])


@query("confusion")
def confusion(spark, sf):
    return metrics.confusion(inputs.predictions(spark, sf))


@query("confusion_wide")
def confusion_wide(spark, sf):
    return metrics.confusion_wide(inputs.predictions(spark, sf), list(LANGUAGES))


@query("cohen_kappa")
def cohen_kappa(spark, sf):
    return _rounded(metrics.cohen_kappa(inputs.double_annotations(spark, sf)), ["kappa"])


@query("judge_human_agreement")
def judge_human_agreement(spark, sf):
    agreement = judging.judge_human_agreement(
        inputs.judge_scores(spark, sf), inputs.human_scores(spark, sf)
    )
    return _rounded(agreement, ["spearman", "exact_agreement", "within_one_agreement"])


@query("score_summary")
def score_summary(spark, sf):
    scores = inputs.judge_scores(spark, sf).select(
        "system", *[F.col(f).cast("int").alias(f) for f in values.RUBRIC_FIELDS]
    )
    return _rounded(metrics.score_summary(scores, list(values.RUBRIC_FIELDS)), list(values.RUBRIC_FIELDS))


@query("class_weights")
def class_weights(spark, sf):
    return _rounded(model.class_weights(inputs.labelled(spark, sf)), ["weight"])


@query("readiness_status")
def readiness_status(spark, sf):
    rows = inputs.labelled(spark, sf)
    status = review.readiness_status(
        rows,
        rows.filter(F.col("decision") == "auto_handle"),
        rows.filter(F.col("decision") == "escalate"),
        inputs.human_scores(spark, sf),
        {"headline_metrics": True, "predictions": False},
        LANGUAGES,
    )
    return status.select(
        "queue_rows",
        "training_rows",
        "golden_rows",
        "reviewed_human_score_rows",
        F.array_join("blockers", "|").alias("blockers"),
        "final_submission_ready",
    )


# -- windows, samples, splits ------------------------------------------------


@query("dedupe_first")
def dedupe_first(spark, sf):
    docs = _documents(spark, sf).select("doc_id", text.normalize_for_matching("text").alias("k"))
    return sampling.dedupe_first(docs, ["k"], ["doc_id"]).select("doc_id")


@query("diverse_topk")
def diverse_topk(spark, sf):
    scored = table(spark, sf, "events").select(
        F.col("user_id").alias("message_id"),
        F.col("event_type").alias("thread_id"),
        F.col("event_id").alias("customer_tweet_id"),
        F.col("value").alias("similarity"),
    )
    return retrieval.diverse_topk(scored, 3)


@query("top2_probs")
def top2_probs(spark, sf):
    rows = table(spark, sf, "events")
    best = model.top2_probs(
        F.array(F.col("value"), F.col("user_id").cast("double"), F.lit(20.0)), ("a", "b", "c")
    )
    return rows.withColumn("b", best).select("event_id", "b.intent", "b.confidence", "b.second_confidence")


@query("sample_n")
def sample_n(spark, sf):
    docs = _documents(spark, sf).select("doc_id", "lang", "n_chars")
    return sampling.sample_n(docs, 800, 42, "doc_id")


@query("number_examples")
def number_examples(spark, sf):
    docs = _documents(spark, sf).select("doc_id", "lang")
    return sampling.number_examples(sampling.sample_n(docs, 800, 7, "doc_id"), 7, "doc_id")


@query("split_quotas")
def split_quotas(spark, sf):
    counts = labels.label_counts(inputs.labelled(spark, sf))
    return sampling.split_quotas(counts, 150)


@query("stratified_split")
def stratified_split(spark, sf):
    ready = inputs.labelled(spark, sf).withColumn("reviewed", F.lit("yes"))
    train, golden = sampling.stratified_split(ready, 150, 42, min_train=20)
    return train.select("example_id", F.lit("train").alias("part")).unionByName(
        golden.select("example_id", F.lit("golden").alias("part"))
    )


@query("paired_sample")
def paired_sample(spark, sf):
    return judging.paired_sample(inputs.predictions(spark, sf), 50, 42).select(
        "example_id", "system", "judge_order"
    )


@query("failure_queue")
def failure_queue(spark, sf):
    queue = review.failure_queue(inputs.predictions(spark, sf), inputs.labelled(spark, sf))
    return queue.select(
        "example_id", "intent_error", "decision_error", "false_auto", "failure_mode", "reviewed"
    )


# -- set operations ----------------------------------------------------------


@query("stack_systems")
def stack_systems(spark, sf):
    return inputs.predictions(spark, sf).select(
        "example_id", "system", "predicted_intent", "predicted_decision", "draft_reply"
    )


@query("overlap")
def overlap(spark, sf):
    rows = inputs.labelled(spark, sf)
    good, poor = rows.filter("quality = 1"), rows.filter("quality = 0")
    return checks.stack(
        [
            checks.overlap(good, poor, F.col("thread_id"), F.col("thread_id"), "thread"),
            checks.overlap(good, poor, F.col("source"), F.col("source"), "source"),
        ]
    )


@query("missing_pairs")
def missing_pairs(spark, sf):
    rows = inputs.predictions(spark, sf)
    sent = rows.filter("predicted_decision = 'escalate'").unionByName(
        rows.filter("system = 'trivial'").withColumn("system", F.lit("unknown"))
    )
    lost, unknown = checks.missing_keys(rows, sent, ["example_id", "system"])
    return lost.withColumn("side", F.lit("lost")).unionByName(unknown.withColumn("side", F.lit("unknown")))


@query("upsert_scores")
def upsert_scores(spark, sf):
    old = inputs.judge_scores(spark, sf)
    fresh = old.filter(F.col("relevance") == "1").withColumn("rationale", F.lit("again"))
    return judging.upsert_scores(old.filter(F.col("tone") != "2"), fresh)


# -- features and retrieval --------------------------------------------------


def _term_summary(docs: DataFrame, terms) -> DataFrame:
    return docs.withColumn("t", terms).select(
        "doc_id",
        F.size("t").alias("n_terms"),
        F.md5(F.array_join(F.sort_array("t"), "|")).alias("digest"),
    )


@query("word_terms")
def word_terms(spark, sf):
    docs = _documents(spark, sf).select("doc_id", text.normalize_for_matching("text").alias("x"))
    return _term_summary(docs, tfidf.word_terms(F.col("x")))


@query("char_terms")
def char_terms(spark, sf):
    docs = _documents(spark, sf).select("doc_id", text.normalize_for_matching("text").alias("x"))
    return _term_summary(docs, tfidf.char_terms(F.col("x")))


def _turns(spark, sf):
    turns = inputs.messages(spark, sf).filter("inbound")
    return turns.select("tweet_id", text.normalize_for_matching("text").alias("normalized"))


def _vocabulary(docs: DataFrame, id_col: str) -> tfidf.Vocabulary:
    counts = tfidf.term_counts(docs, id_col, "normalized", summed=True)
    return tfidf.fit_vocabulary(counts, docs.count(), model.FEATURE_SPECS)


@query("tfidf_fit")
def tfidf_fit(spark, sf):
    terms = _vocabulary(_turns(spark, sf), "tweet_id").terms
    return terms.select("space", "term", "df", F.round("idf", 9).alias("idf"))


@query("tfidf_fit_top")
def tfidf_fit_top(spark, sf):
    """The most frequent terms of all whole documents; the cuts fall among terms of equal counts."""
    docs = _documents(spark, sf).select("doc_id", text.normalize_for_matching("text").alias("normalized"))
    counts = tfidf.term_counts(docs, "doc_id", "normalized", summed=True)
    spec = tfidf.SpaceSpec(max_features=1_000)
    terms = tfidf.fit_vocabulary(counts, docs.count(), {"word": spec, "char": spec}).terms
    return terms.select("space", "term", "df", F.round("idf", 9).alias("idf"))


@query("tfidf_fit_documents")
def tfidf_fit_documents(spark, sf):
    """The vocabulary of all whole documents, summed up per space and first character."""
    docs = _documents(spark, sf).select("doc_id", text.normalize_for_matching("text").alias("normalized"))
    terms = _vocabulary(docs, "doc_id").terms
    return terms.groupBy("space", F.substring("term", 1, 1).alias("first")).agg(
        F.count(F.lit(1)).alias("terms"), F.sum("df").alias("df"), F.round(F.sum("idf"), 4).alias("idf")
    )


@query("tfidf_transform")
def tfidf_transform(spark, sf):
    """The weights of all customer turns; terms of one turn alone are unknown to the vocabulary."""
    vocabulary = _vocabulary(_turns(spark, sf), "tweet_id")
    asked = inputs.customer_turns(spark, sf).select(
        "message_id", text.normalize_for_matching("text").alias("normalized")
    )
    weights = tfidf.weigh(tfidf.term_counts(asked, "message_id", "normalized"), vocabulary, "message_id")
    return weights.select("message_id", "space", "term", F.round("weight", 7).alias("weight"))


@query("build_retrieval_corpus")
def build_retrieval_corpus(spark, sf):
    """All documents as cases; a document that may be quoted quotes itself."""
    cases = inputs.document_pairs(spark, sf).withColumn("brand_reply", F.col("customer_text"))
    corpus = retrieval.select_corpus(cases, inputs.held_out(spark, sf), DESK_CONFIG)
    return corpus.select("customer_tweet_id", "thread_id", "safe_guidance")


def _found(cases: DataFrame) -> DataFrame:
    return cases.select(
        "message_id",
        "rank",
        "customer_tweet_id",
        "thread_id",
        F.round("similarity", 6).alias("similarity"),
        F.round("word_similarity", 6).alias("word_similarity"),
        F.round("char_similarity", 6).alias("char_similarity"),
    )


@query("hybrid_retrieve")
def hybrid_retrieve(spark, sf):
    index = retrieval.build_retrieval_corpus(_direct_pairs(spark, sf))
    return _found(retrieval.hybrid_retrieve(inputs.benchmark_messages(spark, sf), index, 3))


@query("hybrid_retrieve_documents")
def hybrid_retrieve_documents(spark, sf):
    """Every document is a case; those whose id is divisible by 50 ask."""
    index = retrieval.build_retrieval_corpus(inputs.document_pairs(spark, sf))
    return _found(retrieval.hybrid_retrieve(inputs.asking_documents(spark, sf), index, 3))


@query("respond")
def respond(spark, sf):
    """Gates, evidence and drafts of all customer turns, with rule labels in place of the classifier."""
    index = retrieval.build_retrieval_corpus(_direct_pairs(spark, sf), DESK_CONFIG)
    accepted, _ = text.validate_message(inputs.customer_turns(spark, sf))
    cleaned = accepted.withColumn("text", text.normalize_text("text"))
    scored = cleaned.select(
        "message_id",
        "text",
        rules.rule_label("text", LANGUAGE_RULES)["intent"].alias("intent"),
        (F.pmod(F.length("text"), F.lit(100)) / 100.0).alias("confidence"),
        (F.pmod(F.length("text"), F.lit(37)) / 100.0).alias("second_confidence"),
    )
    cases = responses.collect_evidence(retrieval.hybrid_retrieve(cleaned, index, DESK_CONFIG.top_k))
    return responses.respond(scored, cases, DESK_CONFIG).select(
        "message_id",
        "intent",
        "confidence",
        "decision",
        "reason",
        F.array_join("triggered_risks", ",").alias("risks"),
        "draft_reply",
        "rag_mode",
        F.size("evidence").alias("cases_found"),
    )


@query("save_load_index")
def save_load_index(spark, sf):
    path = _new_folder(spark, "index")
    artifacts.save_index(retrieval.build_retrieval_corpus(_direct_pairs(spark, sf)), path)
    loaded = artifacts.load_index(spark, path)
    return loaded.postings.groupBy("space").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("customer_tweet_id").alias("cases"),
        F.count_distinct("term").alias("terms"),
        F.round(F.sum("weight"), 4).alias("weight"),
    )


@query("index_upkeep")
def index_upkeep(spark, sf):
    """All documents as cases, in two batches, with held-out documents barred in between."""
    cases = inputs.document_pairs(spark, sf)
    first = F.pmod(F.xxhash64("customer_tweet_id"), F.lit(2)) == 0
    ledger = upkeep.open_ledger(cases.filter(first))
    ledger = upkeep.bar_cases(ledger, inputs.held_out(spark, sf))
    ledger = upkeep.add_cases(ledger, cases.filter(~first))
    return upkeep.index_of(ledger).postings.groupBy("space").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("customer_tweet_id").alias("cases"),
        F.count_distinct("term").alias("terms"),
        F.round(F.sum("weight"), 4).alias("weight"),
    )


# -- model, policy, triage ---------------------------------------------------


def _weak_model(spark: SparkSession, cases: DataFrame) -> model.IntentModel:
    """A classifier fitted on a sample of at most 12,000 weakly labelled messages."""
    weak = labels.create_weak_labels(cases, 12_000, 42, LANGUAGE_RULES)
    return model.train_intent_model(
        weak.select("customer_tweet_id", "customer_text", "intent"),
        "customer_tweet_id",
        allow_weak_labels=True,
        max_iter=100,
    )


def _formula_model(
    spark: SparkSession, sf: str, source: str = "weak_provisional", digest: str | None = None
) -> model.IntentModel:
    """A classifier over the turns' vocabulary whose coefficients follow from term and class.

    What comes after training can then be compared with SQL to the last digit.
    """
    classes = (*LANGUAGES, "other_unclear")
    turns = _turns(spark, sf)
    terms = _vocabulary(turns, "tweet_id").terms

    def coefficient(name: str):
        word = F.md5(F.concat("term", F.lit(f"|{name}")))
        return (F.pmod(F.conv(F.substring(word, 1, 4), 16, 10).cast("int"), F.lit(2001)) - 1000) / 100.0

    table_ = stored(terms.withColumn("by_class", F.array(*[coefficient(c) for c in classes])), "coefficients")
    intercepts = tuple(i / 10 for i in range(len(classes)))
    n = turns.count()
    return model.IntentModel(table_, intercepts, classes, n, source, n, digest)


@query("train_intent_model")
def train_intent_model(spark, sf):
    """A stored and loaded model: at its optimum, and equal to the one that was stored.

    With balanced weights, the optimum makes each class's weighted probabilities
    sum up to the number of rows over the number of classes.
    """
    with scratch(spark):
        # Weak labels read the pairs twice: for their keys, and for what is chosen.
        cases = stored(_direct_pairs(spark, sf), "pairs")
        weak = stored(labels.create_weak_labels(cases, 12_000, 42, LANGUAGE_RULES), "weak-labels", result=True)
    rows = weak.select("customer_tweet_id", "customer_text", "intent")
    fitted = model.train_intent_model(rows, "customer_tweet_id", allow_weak_labels=True, max_iter=300, tol=1e-7)
    path = _new_folder(spark, "model")
    artifacts.save_model(fitted, path)
    loaded = artifacts.load_model(spark, path)
    asked = rows.select(F.col("customer_tweet_id").alias("message_id"), F.col("customer_text").alias("text"), "intent")
    before = model.class_probabilities(fitted, asked).withColumnRenamed("probabilities", "before")
    after = model.class_probabilities(loaded, asked).join(before, "message_id").join(asked, "message_id")
    weighted = after.join(F.broadcast(model.class_weights(rows)), "intent")
    names = F.array(*[F.lit(c) for c in loaded.classes])
    share = len(loaded.classes) / loaded.training_examples
    return (
        weighted.select(F.posexplode("probabilities").alias("i", "p"), "before", "weight")
        .groupBy(F.element_at(names, F.col("i") + 1).alias("intent"))
        .agg(
            F.count(F.lit(1)).alias("training_examples"),
            (F.abs(F.sum(F.col("p") * F.col("weight")) * share - 1) < 0.01).alias("at_optimum"),
            F.bool_and(F.abs(F.col("p") - F.get("before", F.col("i"))) < 1e-9).alias("loads_alike"),
            F.lit(loaded.label_source).alias("label_source"),
        )
    )


@query("predict_intent")
def predict_intent(spark, sf):
    """Classes of all documents."""
    found = model.predict_intent(_formula_model(spark, sf), inputs.document_messages(spark, sf))
    return _rounded(found.drop("text"), ["confidence", "second_confidence"])


@query("decide")
def decide(spark, sf):
    rule = Policy(always_escalate=("es",), auto_handle=("en", "fr"), risk_terms=("thnd", "quement", "privacy"))
    decided = policy.decide(inputs.policy_inputs(spark, sf), rule)
    return decided.select(
        "doc_id", "action", "reason", F.array_join("triggered_risks", ",").alias("risks")
    )


@query("select_evidence")
def select_evidence(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("message_id"),
        "event_type",
        F.when(F.col("value") > 20, F.array()).otherwise(F.split(F.lit("a,b,c"), ",")).alias("candidates"),
        F.when(F.col("event_type") == "error", "x")
        .otherwise((F.pmod(F.col("user_id"), F.lit(6)) - 2).cast("string"))
        .alias("choice"),
    )
    chosen = responses.select_evidence(
        events.select("message_id", "candidates"), events.select("message_id", "choice")
    )
    return chosen.select("message_id", "selected", "rag_mode")


@query("trivial_baseline")
def trivial_baseline(spark, sf):
    golden = inputs.labelled(spark, sf)
    return labels.trivial_baseline(golden, labels.majority_label(golden, "example_id")).select(
        "example_id", "predicted_intent", "predicted_decision", "draft_reply"
    )


@query("keyword_baseline")
def keyword_baseline(spark, sf):
    return labels.keyword_baseline(
        inputs.labelled(spark, sf), LANGUAGE_RULES, sensitive=("de", "es")
    ).select("example_id", "predicted_intent", "predicted_decision", "draft_reply", "rule_match")


@query("create_weak_labels")
def create_weak_labels(spark, sf):
    return labels.create_weak_labels(
        inputs.document_pairs(spark, sf), 12_000, 42, LANGUAGE_RULES
    ).select("customer_tweet_id", "intent", "rule_match", "label_source")


@query("make_label_queue")
def make_label_queue(spark, sf):
    return labels.make_label_queue(inputs.document_pairs(spark, sf), 800, 42)


def _answers(responses_: DataFrame, rejected: DataFrame) -> DataFrame:
    """Responses and rejected messages in one table."""
    answers = responses_.select(
        "message_id",
        "intent",
        "confidence",
        "decision",
        "reason",
        "draft_reply",
        F.array_join("evidence_tweet_ids", ",").alias("evidence_tweet_ids"),
        "rag_mode",
        F.size("evidence").alias("cases_found"),
    )
    return answers.unionByName(
        rejected.select("message_id", F.lit("rejected").alias("decision"), "reason"), allowMissingColumns=True
    )


def _incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Unanswered turns and benchmark passages; some are blank or too long."""
    odd = (
        F.when(F.pmod("message_id", F.lit(17)) == 0, "@someone 1234567")
        .when(F.pmod("message_id", F.lit(13)) == 0, F.repeat("text", F.lit(60)))
        .otherwise(F.col("text"))
    )
    asked = inputs.benchmark_messages(spark, sf).withColumn("message_id", -1 - F.col("message_id"))
    return inputs.unanswered(spark, sf).unionByName(asked).withColumn("text", odd)


def run_triage(spark: SparkSession, sf: str, training: DataFrame) -> DataFrame:
    """Triage the unanswered messages against the answered ones, with a classifier fitted on ``training``."""
    cases = stored(_pairs(spark, sf), "pairs")
    answers, rejected = responses.triage(
        _incoming(spark, sf),
        _weak_model(spark, training),
        retrieval.build_retrieval_corpus(cases, DESK_CONFIG),
        DESK_CONFIG,
    )
    return _answers(answers, rejected)


@query("triage")
def triage(spark, sf):
    index = retrieval.build_retrieval_corpus(_direct_pairs(spark, sf), DESK_CONFIG)
    return _answers(*responses.triage(_incoming(spark, sf), _formula_model(spark, sf), index, DESK_CONFIG))


@query("evaluate_all")
def evaluate_all(spark, sf):
    """All checks, three systems and their metrics on a split of the labelled documents."""
    ready = inputs.labelled(spark, sf).withColumns({"reviewed": F.lit("yes"), "label_source": F.lit("human")})
    train, golden = sampling.stratified_split(ready, 150, 42, min_train=20)
    train, golden = stored(train, "training"), stored(golden, "golden")
    config = dataclasses.replace(DESK_CONFIG, max_message_chars=None)
    digest = values.fingerprint(train).first()["digest"]
    # Read twice: for the keys that held-out rows share, and for the corpus.
    cases = stored(_direct_pairs(spark, sf), "pairs")
    result = evaluation.evaluate_all(
        golden,
        train,
        _formula_model(spark, sf, "human_reviewed", digest),
        retrieval.build_retrieval_corpus(cases, config, held_out=golden),
        config,
        LANGUAGE_RULES,
    )
    path = _new_folder(spark, "report")
    artifacts.write_report(result, path)
    averages = spark.read.parquet(f"{path}/averages").select("system", "weighted_f1")
    written = spark.read.parquet(f"{path}/metrics").join(averages, "system")
    return _rounded(written, [c for c, kind in written.dtypes if kind == "double"])


@query("triage_stream")
def triage_stream_query(spark, sf):
    index = retrieval.build_retrieval_corpus(_direct_pairs(spark, sf), DESK_CONFIG)
    folder = _new_folder(spark, "stream")
    _incoming(spark, sf).repartition(2, "message_id").write.parquet(f"{folder}/in")
    incoming = (
        spark.readStream.schema("message_id long, text string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    )
    writer = triage_stream(
        incoming, _formula_model(spark, sf), index, f"{folder}/out", f"{folder}/checkpoint", DESK_CONFIG
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    out = lambda part: spark.read.parquet(f"{folder}/out/{part}")
    return _answers(out("responses"), out("rejected")).select("message_id", "intent", "decision", "reason", "rag_mode")


# -- judging -----------------------------------------------------------------


def length_scorer() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A stand-in judge: scores from the lengths of the draft and the message.

    A local function, so that it reaches the workers by value and they need not
    have this package installed.
    """
    fields = values.RUBRIC_FIELDS

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        out = batch[["cache_key"]].copy()
        size = batch["customer_text"].str.len() + batch["draft_reply"].str.len()
        for i, field in enumerate(fields):
            out[field] = (size + i) % 5 + 1
        return out.assign(rationale="by length")

    return score


@query("judge_table")
def judge_table(spark, sf):
    run, _ = judging.judge_table(
        inputs.predictions(spark, sf), inputs.labelled(spark, sf), length_scorer(), "judge-a", None, 42
    )
    return run


@query("prepare_worksheet")
def prepare_worksheet(spark, sf):
    predictions, golden = inputs.predictions(spark, sf), inputs.labelled(spark, sf)
    sample = judging.keyed_content(
        judging.paired_sample(predictions, None, 42), golden, "judge-a"
    ).select(
        "example_id",
        "system",
        F.lit("judge-a").alias("model"),
        F.lit(values.RUBRIC_VERSION).alias("rubric_version"),
        "cache_key",
    )
    return review.prepare_worksheet(sample, predictions, golden)


# -- data-quality checks -----------------------------------------------------


@query("golden_checks")
def golden_checks(spark, sf):
    return checks.golden_checks(inputs.labelled(spark, sf), ("en", "fr", "es"))


@query("training_checks")
def training_checks(spark, sf):
    rows = inputs.labelled(spark, sf).withColumn("label_source", F.col("source"))
    return checks.training_checks(rows, LANGUAGES)


@query("model_input_checks")
def model_input_checks(spark, sf):
    rows = inputs.labelled(spark, sf)
    return model.training_report(rows, "text", allow_weak_labels=False)


@query("leakage_checks")
def leakage_checks(spark, sf):
    rows = inputs.labelled(spark, sf)
    corpus = inputs.document_pairs(spark, sf).withColumn(
        "thread_id", F.concat(F.lit("t"), F.floor(F.col("customer_tweet_id") / 2))
    )
    return checks.leakage_checks(rows.filter("quality = 1"), rows.filter("quality = 0"), corpus)


@query("pairing_checks")
def pairing_checks(spark, sf):
    predictions = inputs.predictions(spark, sf)
    partial = predictions.filter("system <> 'main' OR predicted_decision = 'escalate'")
    known = inputs.labelled(spark, sf).filter("decision = 'auto_handle'")
    return checks.pairing_checks(partial, known)


@query("worksheet_checks")
def worksheet_checks(spark, sf):
    sheet = inputs.human_scores(spark, sf).withColumns(
        {
            "annotator": F.when(F.col("tone") == "3", " ").otherwise(F.col("annotator")),
            "safety": F.when(F.col("tone") == "2", "7").otherwise(F.col("safety")),
            "cache_key": F.when(F.col("tone") == "1", "stale").otherwise(F.col("cache_key")),
            "evidence_json": F.when(F.col("tone") == "4", '{"id": 1, "id": 2}').otherwise(F.col("evidence_json")),
        }
    )
    return checks.violations(sheet, checks.worksheet_rules())


@query("worksheet_columns")
def worksheet_columns(spark, sf):
    renamed = inputs.human_scores(spark, sf).withColumnRenamed("annotator", "scored_by")
    return checks.column_checks(renamed, review.WORKSHEET_COLUMNS)


@query("prediction_checks")
def prediction_checks(spark, sf):
    rows = inputs.predictions(spark, sf).withColumn(
        "predicted_decision",
        F.when(F.col("predicted_intent") == "fr", "maybe").otherwise(F.col("predicted_decision")),
    )
    return metrics.prediction_checks(rows.unionByName(rows.filter("system = 'main'")))


@query("provenance_checks")
def provenance_checks(spark, sf):
    docs = _documents(spark, sf).select("doc_id", "text")
    again = values.fingerprint(docs.repartition(7))
    return checks.stack(
        [
            checks.provenance_checks(values.fingerprint(docs), again, "same rows"),
            checks.provenance_checks(values.fingerprint(docs), values.fingerprint(docs.distinct().union(docs)), "more rows"),
        ]
    )
