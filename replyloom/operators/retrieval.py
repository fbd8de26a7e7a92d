"""Similar past cases: an inverted index in blocks and an exact top-k over it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyloom.config import TriageConfig
from replyloom.functions.text import (
    is_blank,
    normalize_for_matching,
    safe_guidance,
    with_matching_text,
)
from replyloom.functions.values import fingerprint
from replyloom.operators.blocks import (
    BLOCK_SCHEMA,
    CASE_COUNTS,
    CHUNK_FIELDS,
    FOUND_SCHEMA,
    TERM_FIELDS,
    Wave,
    best_cases,
    count_case_texts,
    count_message_texts,
    cut_keys,
    idfs_of_keys,
    named_postings,
    reaching_cases,
    unpack_keys,
    upper_bounds,
    weigh_cases,
    weigh_messages,
)
from replyloom.operators.checks import require_columns
from replyloom.operators.heldout import exclude_held_out, held_out_ids, without_ids
from replyloom.operators.sampling import dedupe_first, sample_n, text_digest
from replyloom.operators.tfidf import SpaceSpec, Vocabulary, cut_texts, fit_stats
from replyloom.session import append, scratch, scratch_folder, stored, together

INDEX_VERSION = 6
WORD_WEIGHT = 0.65
SCORE_DIGITS = 9
# Rounding moves a score by less than this.
SLACK = 1e-8
# Characters of text in a block of cases, and messages in a chunk.
BLOCK_CHARS = 1 << 17
CHUNK_MESSAGES = 128
# Packed bytes of the messages that meet the blocks together, and their number.
WAVE_BYTES = 1 << 25
WAVE_MESSAGES = 1 << 11
# Groups of cases that share their least word; neighbours come to lie in one block.
CLUSTERS = 1 << 16
# Keys of packs, or fewer, that meet the vocabulary in one task.
RANGE_KEYS = 1 << 20
# Seeds tried for keys that no two terms share.
SEEDS = 8


@dataclass(frozen=True)
class RetrievalIndex:
    """Corpus, vocabulary and blocks of weights.

    ``corpus`` says where each case lies, ``(block, slot)``; ``vocabulary.terms``
    has a 64-bit ``key`` per term, no two alike.
    """

    corpus: DataFrame
    vocabulary: Vocabulary
    blocks: DataFrame
    excluded_rows: int = 0
    excluded_digest: str | None = None
    word_weight: float = WORD_WEIGHT
    version: int = INDEX_VERSION

    @property
    def postings(self) -> DataFrame:
        """``(space, term, customer_tweet_id, weight)``, unpacked.

        The terms of a block meet the vocabulary once each, and the ids of its
        cases come as one list: postings are made in full and never joined.
        """
        slots = F.array_sort(F.collect_list(F.struct("slot", "customer_tweet_id")))
        ids = self.corpus.groupBy("block").agg(F.transform(slots, lambda s: s["customer_tweet_id"]).alias("ids"))
        keys = self.blocks.select("block", "keys").mapInArrow(unpack_keys, "block long, key long")
        known = keys.join(self.vocabulary.terms.select("key", "space", "term"), "key")
        kind = self.corpus.schema["customer_tweet_id"].dataType.simpleString()
        return (
            self.blocks.drop("threads", "tops")
            .join(ids, "block")
            .groupBy("block")
            .cogroup(known.groupBy("block"))
            .applyInArrow(named_postings, f"space string, term string, customer_tweet_id {kind}, weight double")
        )


def _require_pairs(pairs: DataFrame, config: TriageConfig) -> None:
    require_columns(pairs, ["customer_tweet_id", "customer_text", "brand_reply", "thread_id"], "Pairs")
    if config.max_corpus_size is not None and config.max_corpus_size < 1:
        raise ValueError("Retrieval corpus size must be positive.")


def select_corpus(
    pairs: DataFrame, held_out: DataFrame | None = None, config: TriageConfig = TriageConfig()
) -> DataFrame:
    """Pairs fit for the index: not held out, non-empty, one per normalised text.

    All of them, unless ``config.max_corpus_size`` asks for a sample.
    """
    _require_pairs(pairs, config)
    allowed = pairs if held_out is None else exclude_held_out(pairs, held_out)
    usable = with_matching_text(allowed.filter(~is_blank("brand_reply")), "customer_text", "normalized")
    return as_cases(one_per_text(usable, config), config)


def one_per_text(usable: DataFrame, config: TriageConfig) -> DataFrame:
    distinct = dedupe_first(usable, [text_digest("normalized")], ["customer_tweet_id"])
    return sample_n(distinct, config.max_corpus_size, config.seed, "customer_tweet_id")


def as_cases(chosen: DataFrame, config: TriageConfig, *keep: str) -> DataFrame:
    """The columns of a case, ``keep`` besides."""
    guidance = safe_guidance("brand_reply", config.blocked_patterns, config.suggestion_start)
    return chosen.select(
        "customer_tweet_id",
        F.col("thread_id").cast("string").alias("thread_id"),
        "customer_text",
        "brand_reply",
        guidance.alias("safe_guidance"),
        "normalized",
        *keep,
    )


def placed(corpus: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``corpus`` with ``block`` and ``slot``.

    Cases are laid out by the least digest among their words, so that cases with
    words in common tend to share a block and its bounds are tight.  A group of
    such cases takes as many characters of the layout as it has, and a case a
    random place inside its group: no task ever numbers the whole corpus, and a
    large group is many blocks.
    """
    words = F.filter(F.split("normalized", " "), lambda w: w != "")
    least = F.array_min(F.transform(words, lambda w: F.xxhash64(w)))
    marked = corpus.withColumn("_cluster", F.pmod(least, F.lit(CLUSTERS)))
    before = Window.orderBy("_cluster").rowsBetween(Window.unboundedPreceding, -1)
    # CLUSTERS rows at most, whatever the corpus.
    layout = (
        marked.groupBy("_cluster")
        .agg(F.sum(F.length("normalized")).alias("_chars"))
        .select("_cluster", "_chars", F.coalesce(F.sum("_chars").over(before), F.lit(0)).alias("_begin"))
    )
    grain = 1 << 20
    share = F.pmod(F.xxhash64("customer_tweet_id"), F.lit(grain)) / F.lit(float(grain))
    block = F.floor((F.col("_begin") + F.col("_chars") * share) / block_chars)
    slot = F.row_number().over(Window.partitionBy("block").orderBy("customer_tweet_id")) - 1
    return (
        marked.join(F.broadcast(layout), "_cluster")
        .withColumn("block", block)
        .withColumn("slot", slot)
        .drop("_cluster", "_chars", "_begin")
    )


def _keyed(packed: DataFrame, seed: int) -> DataFrame:
    """Packed counts with ``keys``, 64 bits for each of their terms."""

    def key(t):
        return F.xxhash64(F.lit(seed), F.when(t["words"] == 1, "word").otherwise("char"), t["terms"])

    return packed.withColumn("keys", F.transform(F.arrays_zip("words", "terms"), key))


def _seed(vocabulary: Vocabulary) -> int:
    """The seed that gave the terms their keys."""
    keys = F.array(*[F.xxhash64(F.lit(seed), "space", "term") for seed in range(SEEDS)])
    # A vocabulary may be empty of terms: then no key is ever looked up.
    one = vocabulary.terms.select((F.array_position(keys, F.col("key")) - 1).alias("seed")).limit(1).collect()
    return int(one[0]["seed"]) if one else 0


def _with_idf(counts: DataFrame, vocabulary: Vocabulary, by: str, weigh, schema: str) -> DataFrame:
    """Packed ``counts`` with weights: the keys of a pack meet the vocabulary, its postings never do.

    Keys and terms meet by ranges of keys, as arrays: there is no row per key of a pack.
    """
    keys = counts.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    bits = max(1, math.ceil(math.log2(max(1, keys) / RANGE_KEYS)))
    cuts = counts.select(by, "keys").mapInArrow(cut_keys(bits, by), f"{by} long, part long, keys binary")
    terms = vocabulary.terms.select(F.shiftrightunsigned("key", 64 - bits).alias("part"), "key", "idf")
    told = f"{by} long, part long, idfs binary"
    known = cuts.groupBy("part").cogroup(terms.groupBy("part")).applyInArrow(idfs_of_keys(by), told)
    packs = counts.drop("terms", "dfs", "tfs")
    return packs.groupBy(by).cogroup(known.groupBy(by)).applyInArrow(weigh, schema)


def build_retrieval_corpus(
    pairs: DataFrame,
    config: TriageConfig = TriageConfig(),
    held_out: DataFrame | None = None,
    block_chars: int = BLOCK_CHARS,
) -> RetrievalIndex:
    """Build the index in the shared folder; held-out rows leave before anything is fitted.

    Texts go to their block, where their terms are counted and packed.  Only the
    terms of a block meet the vocabulary, once each; a block is bounded by its
    text, so no task and no key grows with a common term.  The ids of held-out
    pairs are found once, to drop the pairs and to count them.
    """
    _require_pairs(pairs, config)
    with scratch(pairs.sparkSession):
        with scratch(pairs.sparkSession):
            allowed, excluded, digest = pairs, 0, None
            if held_out is not None:
                drop = stored(held_out_ids(pairs, held_out), "held-out-ids")
                allowed, excluded = without_ids(pairs, drop), drop.count()
                digest = fingerprint(held_out).first()["digest"]
            chosen = stored(select_corpus(allowed, None, config), "chosen-cases")
            corpus = stored(placed(chosen, block_chars), "corpus", result=2)
        texts = together(corpus.select("block", "slot", "thread_id", "normalized"), "block")
        cases = cut_texts(texts, "normalized", "block", "slot", "thread_id").drop("chars")
        counts = cases.groupBy("block").applyInArrow(count_case_texts, CASE_COUNTS)
        vocabulary, blocks = weigh_index(corpus, stored(counts, "case-counts", packed=True), config)
    return RetrievalIndex(corpus, vocabulary, blocks, excluded, digest)


def weigh_index(corpus: DataFrame, packed: DataFrame, config: TriageConfig) -> tuple[Vocabulary, DataFrame]:
    """Vocabulary and blocks from the stored counts of each block.

    A seed under which two terms share a key is passed over.
    """
    if config.max_features is not None and config.max_features < 1:
        raise ValueError("Retrieval feature limit must be positive.")
    n_docs = corpus.count()
    if n_docs == 0:
        raise ValueError("Cleaning and held-out exclusion left no case to retrieve.")
    spec = SpaceSpec(max_features=config.max_features)
    for seed in range(SEEDS):
        keyed = _keyed(packed, seed)
        listed = keyed.select(F.inline(F.arrays_zip("keys", "words", "terms", "dfs", "tfs")))
        space = F.when(F.col("words") == 1, "word").otherwise("char").alias("space")
        stats = listed.groupBy(space, F.col("terms").alias("term"), F.col("keys").alias("key")).agg(
            F.sum("dfs").alias("df"), F.sum("tfs").alias("tf")
        )
        fitted = fit_stats(stats, n_docs, {"word": spec, "char": spec}).terms
        terms = stored(fitted.select("space", "term", "df", "idf", "key"), "vocabulary", result=True)
        n, distinct = terms.agg(F.count(F.lit(1)), F.count_distinct("key")).first()
        # A term that was left out could still share a key with one that was not.
        if n == distinct and (config.max_features is None or keyed.filter(F.size(F.array_distinct("keys")) < F.size("keys")).isEmpty()):
            break
    else:
        raise RuntimeError("No seed gives every term a key of its own.")
    vocabulary = Vocabulary(terms, n_docs)
    return vocabulary, stored(
        _with_idf(keyed, vocabulary, "block", weigh_cases, BLOCK_SCHEMA), "blocks", result=True, packed=True
    )


def diverse_topk(scored: DataFrame, k: int, query: str = "message_id") -> DataFrame:
    """Best case per thread, then the ``k`` best per message; ties by case id."""
    best = [F.desc("similarity"), F.col("customer_tweet_id")]
    per_thread = Window.partitionBy(query, "thread_id").orderBy(*best)
    per_query = Window.partitionBy(query).orderBy(*best)
    return (
        scored.withColumn("_rn", F.row_number().over(per_thread))
        .filter("_rn = 1")
        .drop("_rn")
        .withColumn("rank", F.row_number().over(per_query))
        .filter(F.col("rank") <= k)
    )


def _chunks(messages: DataFrame, index: RetrievalIndex, text: str) -> DataFrame:
    """Packed weights of the messages, ``CHUNK_MESSAGES`` or so to a row."""
    n_chunks = max(1, -(-messages.count() // CHUNK_MESSAGES))
    chunk = F.pmod(F.xxhash64("message_id"), F.lit(n_chunks)).alias("chunk")
    prepared = messages.select(chunk, "message_id", normalize_for_matching(text).alias("normalized"))
    texts = cut_texts(together(prepared, "chunk"), "normalized", "chunk", "message_id").drop("chars")
    kind = messages.schema["message_id"].dataType.simpleString()
    ids = f"chunk long, message_ids array<{kind}>"
    counted = texts.groupBy("chunk").applyInArrow(count_message_texts, f"{ids}, {TERM_FIELDS}")
    keyed = _keyed(stored(counted, "asked-counts", packed=True), _seed(index.vocabulary))
    packed = _with_idf(keyed, index.vocabulary, "chunk", weigh_messages, f"{ids}, {CHUNK_FIELDS}")
    return stored(packed.withColumn("n_messages", F.size("message_ids")), "asked", packed=True)


def _waves(asked: DataFrame, most: int = WAVE_MESSAGES) -> list[tuple[int, int]]:
    """Ranges of chunks, each with so few messages and bytes that a task can hold them beside a block."""
    fields = [f.split()[0] for f in CHUNK_FIELDS.split(", ")]
    size = sum((F.octet_length(f) for f in fields[1:]), F.octet_length(fields[0]))
    rows = sorted(asked.select("chunk", size, "n_messages").collect())
    waves, room, left = [], 0, 0
    for chunk, size, n in rows:
        room, left = room - size, left - n
        if not waves or room < 0 or left < 0:
            waves.append((chunk, chunk))
            room, left = WAVE_BYTES - size, most - n
        waves[-1] = (waves[-1][0], chunk)
    return waves


def _sent(asked: DataFrame) -> Broadcast:
    """The stated chunks for all tasks, which keep them from block to block; ``hybrid_retrieve`` gives a wave of bounded size."""
    return asked.sparkSession.sparkContext.broadcast(Wave(asked.drop("n_messages").toArrow().to_pylist()))


def bounds(asked: DataFrame, index: RetrievalIndex, wave: Broadcast | None = None, rising: bool = False) -> DataFrame:
    """``(chunk, asked, block, bound)``: what a message and any case of a block can reach at most.

    The stated messages meet all blocks by keys and greatest weights alone;
    weights of cases are not read.  ``wave`` is ``asked`` as the tasks have it.
    """
    run = upper_bounds(index.word_weight, wave or _sent(asked), rising)
    return index.blocks.select("block", "keys", "tops").mapInArrow(run, "chunk long, asked int, block long, bound double")


def scored(
    wanted: DataFrame, asked: DataFrame, index: RetrievalIndex, k: int, wave: Broadcast | None = None
) -> DataFrame:
    """Cases that may be a message's best, with similarities; ``wanted`` has (chunk, asked, block, floor).

    Blocks stay where they are read: what the messages want goes to them.
    """
    wave = wave or _sent(asked)
    tasks = wanted.groupBy("block").agg(F.collect_list(F.struct("chunk", "asked", "floor")).alias("wanted"))
    run = best_cases(index.word_weight, k, SLACK, wave)
    return _named(index.blocks.join(F.broadcast(tasks), "block").mapInArrow(run, FOUND_SCHEMA), asked, index)


def _named(sums: DataFrame, asked: DataFrame, index: RetrievalIndex) -> DataFrame:
    """Found cases with their ids and rounded similarities."""
    share = index.word_weight
    blended = F.round(share * F.col("word_similarity") + (1 - share) * F.col("char_similarity"), SCORE_DIGITS)
    where = index.corpus.select("block", "slot", "customer_tweet_id", "thread_id")
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk of the wave.
    first = asked.select("chunk", "message_ids", F.coalesce(F.sum(F.size("message_ids")).over(before), F.lit(0)).alias("first"))
    ids = first.select("first", F.posexplode("message_ids").alias("at", "message_id")).select(
        (F.col("first") + F.col("at")).cast("int").alias("number"), "message_id"
    )
    return (
        sums.join(where, ["block", "slot"])
        .join(F.broadcast(ids), "number")
        .withColumn("word_similarity", F.round("word_sum", SCORE_DIGITS))
        .withColumn("char_similarity", F.round("char_sum", SCORE_DIGITS))
        .withColumn("similarity", blended)
        .filter("similarity > 0")
        .drop("word_sum", "char_sum", "slot", "number")
    )


def _best_of(asked: DataFrame, index: RetrievalIndex, k: int) -> Iterator[DataFrame]:
    """The ``k`` best cases of each message of a wave, to be read while the wave is with the tasks."""
    wave = _sent(asked)
    try:
        reach = bounds(asked, index, wave, True)
        top = F.max_by("block", F.struct("bound", "block")).alias("block")
        likely = reach.groupBy("chunk", "asked").agg(top).withColumn("floor", F.lit(0.0))
        least = max(k, 1)
        first = diverse_topk(scored(likely, asked, index, least, wave), k)
        reached = first.groupBy("message_id").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("floor"))
        # As many rows as the wave has messages.
        found = {r["message_id"]: r["floor"] for r in reached.filter(F.col("n") >= k).collect()}
        ids = [i for _, some in sorted(asked.select("chunk", "message_ids").collect()) for i in some]
        floors = np.array([found.get(i, 0.0) for i in ids])
        run = reaching_cases(index.word_weight, least, SLACK, wave, floors)
        yield diverse_topk(_named(index.blocks.mapInArrow(run, FOUND_SCHEMA), asked, index), k)
    finally:
        wave.destroy()


def hybrid_retrieve(
    messages: DataFrame, index: RetrievalIndex, k: int = 3, text: str = "text"
) -> DataFrame:
    """The ``k`` most similar cases of each message, at most one per thread.

    ``messages`` needs a unique ``message_id``.  The result is that of scoring
    every pair, but whole blocks of cases are left out.  Every message has a
    bound for every block.  The block with the greatest bound is scored first;
    with one case per thread, the least of the ``k`` best there is a floor.
    Then only blocks whose bound reaches the floor are scored, in the pass that
    finds their bounds: no table of messages and blocks is made.  Terms of many
    messages are multiplied as matrices; no term is a join key.  Messages go
    through in waves of bounded size, which the tasks keep from block to block.
    """
    if index.version != INDEX_VERSION:
        raise ValueError("Old retrieval index: rebuild it.")
    with scratch(messages.sparkSession):
        # A message without usable text has no terms and so finds nothing.
        asked = _chunks(messages if k >= 1 else messages.limit(0), index, text)
        waves = scratch_folder(messages.sparkSession, "waves")
        for low, high in _waves(asked) or [(0, -1)]:
            for best in _best_of(asked.filter(F.col("chunk").between(low, high)), index, k):
                append(best, waves)
        best = messages.sparkSession.read.schema(best.schema).parquet(waves)
        details = index.corpus.select("customer_tweet_id", "customer_text", "brand_reply", "safe_guidance")
        found = best.join(details, "customer_tweet_id").select(
            "message_id",
            "rank",
            "customer_tweet_id",
            "thread_id",
            "customer_text",
            "brand_reply",
            "safe_guidance",
            "similarity",
            "word_similarity",
            "char_similarity",
        )
        return stored(found, "similar-cases", result=True)
