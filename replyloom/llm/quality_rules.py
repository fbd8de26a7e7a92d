"""Quality rules as a ledger of bits.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one bit per rule, set where the rule fails.  A policy is a version and a
mask of the rules it applies: judging a document, comparing versions and
leaving rules out are bit operations on the ledger, which never read a text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from replyloom.llm.common import NOT_SPACE, byte_table, chunks, mix, per_text, split_words, window_digests, word_digests

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_SPACE_BYTES = b" \t\n\v\f\r"
_SYMBOL = byte_table(*b"#*$%&|<>")
_WINDOW = 3


class Rule(NamedTuple):
    """``fails`` is a SQL condition on the measurements."""

    name: str
    fails: str


class QualityPolicy(NamedTuple):
    version: str
    rules: tuple[str, ...]


#: A rule's place is its bit: append new rules, never reorder.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("many_symbols", "100 * n_symbols > 25 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
)
BASE = QualityPolicy("base", ("too_few_words", "repeated_windows"))
POLICIES = (
    BASE,
    QualityPolicy("v1", (*BASE.rules, "many_symbols")),
    QualityPolicy("v2", tuple(rule.name for rule in RULES)),
)


def repeated_window_words(digests: np.ndarray, of_text: np.ndarray) -> np.ndarray:
    """Words inside a window of three that occurs twice or more in the same text."""
    n_words = len(digests)
    flags = np.zeros(n_words, dtype=bool)
    text = np.repeat(np.arange(len(of_text) - 1), np.diff(of_text))
    whole = np.flatnonzero(text[: n_words - _WINDOW + 1] == text[_WINDOW - 1 :]) if n_words >= _WINDOW else []
    if not len(whole):
        return flags
    keys = window_digests(digests, _WINDOW)[whole] ^ mix(text[whole].astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for k in range(_WINDOW):
        flags[whole[twice] + k] = True
    return flags


def _measure_chunk(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    words = split_words(data, bounds, NOT_SPACE)
    letters = NOT_SPACE[data] & ((data & 0xC0) != 0x80)
    lines, repeated = [], []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        kept = [x for x in data[begin:end].tobytes().split(b"\n") if x.strip(_SPACE_BYTES)]
        lines.append(len(kept))
        repeated.append(len(kept) - len(set(kept)))
    return [
        np.diff(words.of_text),
        per_text(letters, bounds),
        per_text(_SYMBOL[data], bounds),
        np.array(lines),
        np.array(repeated),
        per_text(repeated_window_words(word_digests(data, words), words.of_text), words.of_text),
    ]


_MEASURED = pa.struct([(name, pa.int64()) for name in MEASURES])


@arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = [_measure_chunk(chunk.data, chunk.bounds) for chunk in chunks(texts)]
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*parts)] or [[]] * len(MEASURES)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_MEASURED))


def _bit(name: str, rules: Sequence[Rule]) -> int:
    return 1 << [rule.name for rule in rules].index(name)


def mask_of(policy: QualityPolicy, rules: Sequence[Rule] = RULES) -> int:
    return sum(_bit(name, rules) for name in set(policy.rules))


def rule_ledger(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per document: the key, the measurements, and ``failures`` with one bit per rule.

    A null or empty text has no words and all measurements zero.  Repeated rows
    and null keys stay as they are; other columns are not carried, so their
    names cannot clash.  An empty table gives an empty ledger.  Windows are
    compared by 64-bit digests within one text.
    """
    if len(rules) > 62:
        raise ValueError("A ledger holds 62 rules at most; keep a second one for more.")
    measured = documents.select(F.col(key), measures(F.col(text)).alias("m")).select(key, "m.*")
    failures = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        failures = failures.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failures", failures)


def passes(policy: QualityPolicy, rules: Sequence[Rule] = RULES, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(mask_of(policy, rules)).cast("long")) == 0


def apply_policies(
    ledger: DataFrame, policies: Sequence[QualityPolicy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ledger with one ``kept_<version>`` column per policy."""
    return ledger.withColumns({f"kept_{p.version}": passes(p, rules) for p in policies})


def ablations(
    ledger: DataFrame, policies: Sequence[QualityPolicy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Per policy and rule: documents kept, kept without the rule, and failing the rule.

    Documents are first counted by their failure bits (at most 2 to the number
    of rules rows, usually a few); every policy and rule is a mask on those.
    """
    profile = ledger.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    trials = [
        F.struct(
            F.lit(p.version).alias("version"),
            F.lit(name).alias("rule"),
            F.lit(mask_of(p, rules)).cast("long").alias("mask"),
            F.lit(_bit(name, rules)).cast("long").alias("bit"),
        )
        for p in policies
        for name in dict.fromkeys(p.rules)
    ]
    cases = profile.withColumn("trial", F.explode(F.array(*trials))).select("failures", "n", "trial.*")
    count = lambda condition: F.sum(F.when(F.expr(condition), F.col("n")).otherwise(0))
    return cases.groupBy("version", "rule").agg(
        F.sum("n").alias("documents"),
        count("(failures & mask) = 0").alias("kept"),
        count("(failures & (mask & ~bit)) = 0").alias("kept_without"),
        count("(failures & bit) <> 0").alias("failing"),
        count("(failures & mask) = bit").alias("only_this"),
    )
