"""Message/reply pairs and brand profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.functions.text import normalize_text, sanitize_reply
from replyloom.operators.joins import ROWS_PER_TASK
from replyloom.operators.sampling import dedupe_first, text_digest
from replyloom.operators.threads import thread_root

MIN_CHARS = 8
RETWEET_PREFIX = "RT "


def parse_created_at(c: Column | str) -> Column:
    """Timestamp of ISO text or of ``Tue Oct 31 22:10:47 +0000 2017``; null otherwise."""
    text = F.col(c) if isinstance(c, str) else c
    without_day = F.regexp_replace(text, r"^[A-Za-z]{3} ", "")
    return F.coalesce(
        F.try_to_timestamp(without_day, F.lit("MMM dd HH:mm:ss Z yyyy")), text.try_cast("timestamp")
    )


def brand_direct_replies(messages: DataFrame, brand: str) -> DataFrame:
    return messages.filter(
        (F.col("author_id") == brand) & ~F.col("inbound") & F.col("in_response_to_tweet_id").isNotNull()
    )


def wanted_messages(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """The messages that some reply answers; ``replies`` has ``in_response_to_tweet_id``."""
    ids = replies.select(F.col("in_response_to_tweet_id").alias("tweet_id")).distinct()
    return messages.join(ids, "tweet_id", "left_semi")


def is_usable_pair(
    customer_text: Column | str = "customer_text", brand_reply: Column | str = "brand_reply"
) -> Column:
    """Both texts are long enough and the message is not a copied one."""
    return (
        (F.length(customer_text) >= MIN_CHARS)
        & (F.length(brand_reply) >= MIN_CHARS)
        & ~F.startswith(customer_text, F.lit(RETWEET_PREFIX))
    )


def reply_pairs(
    messages: DataFrame,
    brand: str,
    order: str = "time",
    rows_per_task: int = ROWS_PER_TASK,
    roots: DataFrame | None = None,
) -> DataFrame:
    """Cleaned (customer message, first brand reply) pairs with their thread.

    Messages that nobody answered leave before any text is sorted or cleaned.
    Replies are reduced to the first per message and messages to one per id
    before they meet, so the join is one-to-one and a message with a flood of
    replies does not skew it.  ``order="lexical"`` sorts replies by the raw
    ``created_at`` text, ``"time"`` by the parsed timestamp.  A brand without a
    direct reply is an error.
    """
    if order not in ("time", "lexical"):
        raise ValueError("order must be 'time' or 'lexical'")
    sort_key = parse_created_at("reply_created_at") if order == "time" else F.col("reply_created_at")
    direct = brand_direct_replies(messages, brand)
    if direct.isEmpty():
        raise ValueError(f"{brand!r} has sent no direct reply.")
    replies = direct.select(
        F.col("in_response_to_tweet_id").alias("customer_tweet_id"),
        F.col("tweet_id").alias("reply_tweet_id"),
        F.col("created_at").alias("reply_created_at"),
        F.col("text").alias("brand_reply"),
    )
    replies = dedupe_first(
        replies, ["customer_tweet_id"], [sort_key.asc_nulls_last(), F.col("reply_tweet_id")]
    )
    customers = wanted_messages(messages, direct).select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("author_id").alias("customer_author_id"),
        F.col("created_at").alias("customer_created_at"),
        F.col("text").alias("customer_text"),
    )
    customers = dedupe_first(
        customers, ["customer_tweet_id"], ["customer_created_at", "customer_author_id", "customer_text"]
    )
    # Generated from a filtered array, both texts are cleaned once; a filter on
    # cleaned columns would be pushed down and clean them again.
    texts = F.struct(
        normalize_text("customer_text").alias("customer_text"),
        sanitize_reply("brand_reply").alias("brand_reply"),
    )
    usable = F.filter(
        F.array(texts), lambda p: is_usable_pair(p["customer_text"], p["brand_reply"])
    )
    cleaned = customers.join(replies, "customer_tweet_id").select(
        "customer_tweet_id",
        "customer_author_id",
        "customer_created_at",
        "reply_tweet_id",
        "reply_created_at",
        F.inline(usable),
    )
    pairs = dedupe_first(cleaned, [text_digest("customer_text")], ["customer_tweet_id"])
    if roots is None:
        roots = thread_root(messages, rows_per_task=rows_per_task)
    roots = roots.withColumnRenamed("tweet_id", "customer_tweet_id")
    return (
        pairs.join(roots, "customer_tweet_id", "left")
        .withColumn("thread_id", F.coalesce("thread_id", "customer_tweet_id"))
        .withColumn("brand", F.lit(brand))
    )


def brand_profile(messages: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Messages, direct replies and distinct replied-to messages per brand.

    Brands without messages are listed with zeros.
    """
    replied_to = F.when(~F.col("inbound"), F.col("in_response_to_tweet_id"))
    counts = (
        messages.filter(F.col("author_id").isin(*brands))
        .groupBy(F.col("author_id").alias("brand"))
        .agg(
            F.count_if(~F.col("inbound")).alias("brand_messages"),
            F.count(replied_to).alias("direct_replies"),
            F.count_distinct(replied_to).alias("unique_customers_replied_to"),
        )
    )
    # The list of brands is an argument, so this side has as many rows as the caller typed.
    wanted = messages.sparkSession.createDataFrame([(b,) for b in brands], "brand string")
    measures = ["brand_messages", "direct_replies", "unique_customers_replied_to"]
    return wanted.join(counts, "brand", "left").fillna(0, measures).orderBy(F.desc("direct_replies"), "brand")
