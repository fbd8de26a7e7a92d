"""How the operators' inputs are derived from the given tables.

The texts of the given tables are invented, so the default keyword packs match
nothing in them; the queries pass words that do occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.functions.rules import matched_terms
from replyloom.functions.text import EDGE, WORD
from replyloom.functions.values import RUBRIC_FIELDS, cache_key
from replyloom.session import spread

DESK = "assistant"
FIRST_SECOND = 1_509_487_847
LANGUAGE_RULES = (
    ("en", "the|and|this"),
    ("fr", "les|des|une"),
    ("de", "der|die|und"),
    ("es", "los|las|por"),
)
LANGUAGES = ("de", "en", "es", "fr")
TERMS = ("thing", "the", "und", "la", "privacy")
GUIDANCE_BLOCKED = (rf"{EDGE}(?:thnd|erre|quement|schen)[{WORD}]*{EDGE}",)
GUIDANCE_START = rf"(?iu)^(?:the|and|of|la|der|de|in){EDGE}"
TEMPLATES = {
    "en": "Thanks for writing.",
    "fr": "Merci pour votre message.",
    "other_unclear": "Could you share more?",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as reply-linked messages."""
    tweet = F.col("conv_id") * 1000 + F.col("turn")
    at = F.timestamp_seconds(F.lit(FIRST_SECOND) + F.col("conv_id") * 3600 + F.col("turn") * 60)
    return table(spark, sf, "conversations").select(
        tweet.alias("tweet_id"),
        F.when(F.col("role") == "user", F.concat(F.lit("user-"), F.col("conv_id")))
        .otherwise(F.col("role"))
        .alias("author_id"),
        (F.col("role") == "user").alias("inbound"),
        F.date_format(at, "EEE MMM dd HH:mm:ss Z yyyy").alias("created_at"),
        "text",
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.when(F.col("turn") > 0, tweet - 1).alias("in_response_to_tweet_id"),
    )


def flooded_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with several replies each, out of time order, and with repeated ids.

    Every second assistant turn answers the user turn before the last one; some
    of these replies are dated back, others three days ahead, so that time and
    text order differ.  Some user turns appear again, edited, under the same id.
    """
    late = (F.col("author_id") == DESK) & (F.pmod(F.floor(F.col("turn") / 2), F.lit(2)) == 1) & (F.col("turn") >= 3)
    shift = F.when(late & (F.pmod("conv_id", F.lit(3)) == 0), 3 * 86_400).when(
        late & (F.pmod("conv_id", F.lit(3)) == 1), -400
    )
    tweet = F.col("conv_id") * 1000 + F.col("turn")
    at = F.timestamp_seconds(
        F.lit(FIRST_SECOND) + F.col("conv_id") * 3600 + F.col("turn") * 60 + F.coalesce(shift, F.lit(0))
    )
    turns = table(spark, sf, "conversations").withColumn(
        "author_id",
        F.when(F.col("role") == "user", F.concat(F.lit("user-"), F.col("conv_id"))).otherwise(F.col("role")),
    )
    rows = turns.select(
        tweet.alias("tweet_id"),
        "author_id",
        (F.col("role") == "user").alias("inbound"),
        F.date_format(at, "EEE MMM dd HH:mm:ss Z yyyy").alias("created_at"),
        "text",
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.when(F.col("turn") > 0, F.when(late, tweet - 3).otherwise(tweet - 1)).alias("in_response_to_tweet_id"),
    )
    edited = rows.filter(F.col("inbound") & (F.pmod(F.floor(F.col("tweet_id") / 1000), F.lit(5)) == 0))
    return rows.unionByName(edited.withColumn("text", F.concat(F.lit("edited "), "text")))


def forest(spark: SparkSession, sf: str) -> DataFrame:
    """Events as replies: branches, chains of 300, loops of 50 and parents that are not there."""
    e = F.col("event_id")
    block = F.floor(e / 300)
    kind = F.pmod(block, F.lit(4))
    parent = (
        F.when((kind == 0) & (F.pmod(e, F.lit(300)) > 0), F.floor((F.pmod(e, F.lit(300)) - 1) / 3) + 300 * block)
        .when((kind == 1) & (F.pmod(e, F.lit(300)) > 0), e - 1)
        .when(kind == 2, F.when(F.pmod(e, F.lit(50)) > 0, e - 1).otherwise(e + 49 - F.pmod(block, F.lit(2))))
        .when((kind == 3) & (F.pmod(e, F.lit(7)) == 0), -e - 1)
        .when((kind == 3) & (F.pmod(e, F.lit(300)) > 0), e - 1)
    )
    return table(spark, sf, "events").select(
        e.alias("tweet_id"), parent.cast("long").alias("in_response_to_tweet_id")
    )


def unanswered(spark: SparkSession, sf: str) -> DataFrame:
    """Customer messages that nobody has replied to: the work of a triage run."""
    everything = messages(spark, sf)
    answered = everything.filter(F.col("author_id") == DESK).select(
        F.col("in_response_to_tweet_id").alias("tweet_id")
    ).distinct()
    return (
        everything.filter("inbound")
        .join(answered, "tweet_id", "left_anti")
        .select(F.col("tweet_id").alias("message_id"), "text")
    )


def benchmark_messages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("message_id"), "text")


def customer_turns(spark: SparkSession, sf: str) -> DataFrame:
    return messages(spark, sf).filter("inbound").select(F.col("tweet_id").alias("message_id"), "text")


def document_messages(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(F.col("doc_id").alias("message_id"), "text")


def asking_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The stated query set: every document whose id is divisible by 50."""
    return document_messages(spark, sf).filter(F.pmod("message_id", F.lit(50)) == 0)


def document_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the layout of message/reply pairs, ten neighbours to a thread."""
    return documents(spark, sf).select(
        F.col("doc_id").alias("customer_tweet_id"),
        F.floor(F.col("doc_id") / 10).alias("thread_id"),
        F.col("text").alias("customer_text"),
        F.concat_ws(" ", "source", "lang").alias("brand_reply"),
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Reviewed labels: language as intent, toxic documents must be escalated."""
    docs = documents(spark, sf).select("doc_id", "text", "lang", "source", "n_chars")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        F.format_string("doc-%07d", "doc_id").alias("example_id"),
        F.col("doc_id").cast("string").alias("tweet_id"),
        F.concat(F.lit("t"), F.floor(F.col("doc_id") / 2)).alias("thread_id"),
        "text",
        F.col("lang").alias("intent"),
        F.when(F.col("toxic") == 1, "escalate").otherwise("auto_handle").alias("decision"),
        F.when(F.col("quality") == 1, " Yes ").otherwise("no").alias("reviewed"),
        "source",
        "quality",
        "n_chars",
    )


def held_out(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that must be escalated, kept away from the corpus."""
    return (
        labelled(spark, sf)
        .filter(F.col("decision") == "escalate")
        .select("tweet_id", F.floor(F.col("tweet_id").cast("long") / 10).alias("thread_id"), "text")
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Three systems on the labelled documents."""
    from replyloom.operators.labels import keyword_baseline, majority_label, trivial_baseline

    golden = labelled(spark, sf)
    frames = {
        "trivial": trivial_baseline(golden, majority_label(golden, "example_id")),
        "keyword": keyword_baseline(golden, LANGUAGE_RULES, sensitive=("de", "es")),
        "main": golden.select(
            "*",
            F.when(F.col("quality") == 1, F.col("intent")).otherwise("en").alias("predicted_intent"),
            F.when(F.col("quality") == 1, "auto_handle").otherwise("escalate").alias("predicted_decision"),
            F.concat_ws(" ", F.lit("See"), "source").alias("draft_reply"),
        ),
    }
    out = None
    for name, frame in frames.items():
        rows = frame.select(
            "example_id",
            F.lit(name).alias("system"),
            F.col("intent").alias("actual_intent"),
            F.col("decision").alias("actual_decision"),
            "predicted_intent",
            "predicted_decision",
            "draft_reply",
            F.to_json(
                F.struct(
                    F.col("predicted_intent").alias("intent"),
                    F.array(F.struct(F.col("source").alias("id"))).alias("evidence"),
                )
            ).alias("prediction_json"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _score(offset: int, width: int) -> F.Column:
    return (F.pmod(F.floor(F.col("n_chars") / width) + offset, F.lit(5)) + 1).cast("string")


def judge_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Judge scores per labelled document, spread by text length."""
    key = cache_key(F.lit("judge-a"), "text", "source", "intent")
    return labelled(spark, sf).select(
        "example_id",
        F.lit("main").alias("system"),
        F.lit("judge-a").alias("model"),
        F.lit("support-draft-v2").alias("rubric_version"),
        key.alias("cache_key"),
        *[_score(i, 7 + i).alias(f) for i, f in enumerate(RUBRIC_FIELDS)],
        F.lit("by length").alias("rationale"),
    )


def human_scores(spark: SparkSession, sf: str) -> DataFrame:
    key = cache_key(F.lit("judge-a"), "text", "source", "intent")
    return labelled(spark, sf).select(
        "example_id",
        F.lit("main").alias("system"),
        "text",
        F.col("source").alias("draft_reply"),
        F.lit("[]").alias("evidence_json"),
        key.alias("cache_key"),
        *[_score(i, 9 + i).alias(f) for i, f in enumerate(RUBRIC_FIELDS)],
        F.lit("reader").alias("annotator"),
        F.when(F.col("quality") == 1, "yes").otherwise("no").alias("reviewed"),
    )


def double_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """Two annotators per labelled document: its labels, and the keyword rules."""
    from replyloom.operators.labels import keyword_baseline

    golden = labelled(spark, sf)
    second = keyword_baseline(golden, LANGUAGE_RULES, sensitive=("de", "es"))
    return golden.select(
        "example_id", F.lit("ann").alias("annotator"), "intent", "decision"
    ).unionByName(
        second.select(
            "example_id",
            F.lit("bob").alias("annotator"),
            F.col("predicted_intent").alias("intent"),
            F.col("predicted_decision").alias("decision"),
        )
    )


def policy_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id",
        "text",
        F.col("lang").alias("intent"),
        (F.pmod(F.col("n_chars"), F.lit(100)) / 100.0).alias("confidence"),
        (F.pmod(F.col("n_chars"), F.lit(37)) / 100.0).alias("second_confidence"),
        (F.pmod(F.col("doc_id"), F.lit(50)) / 50.0).alias("similarity"),
    )


def risk_hits(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.array_join(matched_terms("text", TERMS), ",").alias("terms"))
