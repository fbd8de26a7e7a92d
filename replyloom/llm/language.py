"""Language of texts, span by span.

Every word gets a score per language from its letter trigrams.  The script of a
word, known from code-point ranges, first narrows the languages it may belong
to.  Viterbi decoding over the words, with a penalty for each change of
language, labels spans of mixed-language text; the language with most letters
is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from replyloom.llm.common import (
    LETTER,
    LOWER,
    Texts,
    Words,
    byte_table,
    chunks,
    held_out,
    per_text,
    split_words,
)

#: Documents per language that the fit may see, chosen by a hash of key and text.
SAMPLE = 4_000
MAX_LANGUAGES = 500
BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
UNKNOWN = "und"
#: A script belongs to a language if it has this share of the language's words.
SCRIPT_SHARE = 0.01
_CHUNK = 4 << 20
ASCII_LETTER = byte_table(*range(0x61, 0x7B))
#: First code points of blocks, and the script that begins there.
SCRIPTS = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0700, "other"),
    (0x0900, "Devanagari"),
    (0x0980, "Indic"),
    (0x0E00, "Thai"),
    (0x0E80, "other"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "other"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xAC00, "Hangul"),
    (0xD7B0, "other"),
    (0xF900, "Han"),
    (0xFB00, "other"),
)
_FIRSTS = np.array([first for first, _ in SCRIPTS])
_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(name) for _, name in SCRIPTS])


class Languages(NamedTuple):
    """``gain[bucket, language]`` is a trigram's log probability; ``spoken[script, language]`` who uses a script."""

    names: list[str]
    gain: np.ndarray
    spoken: np.ndarray
    prior: np.ndarray


def _words(chunk: Texts) -> tuple[np.ndarray, Words]:
    data = LOWER[chunk.data]
    return data, split_words(data, chunk.bounds, LETTER)


def _trigrams(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams of the words, each word between two blanks, and where words begin."""
    lengths = words.ends - words.starts
    begins = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(words.starts - begins[:-1], lengths) + np.arange(begins[-1])
    first, last = np.zeros(len(at), bool), np.zeros(len(at), bool)
    first[begins[:-1]] = True
    last[begins[1:] - 1] = True
    padded = np.concatenate([[0], data, [0]]).astype(np.uint32)
    left = np.where(first, 0x20, padded[at])
    right = np.where(last, 0x20, padded[at + 2])
    gram = (left << np.uint32(16)) | (padded[at + 1] << np.uint32(8)) | right
    return ((gram * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64), begins


def word_scripts(data: np.ndarray, words: Words) -> np.ndarray:
    """Script of each word's first character beyond ASCII's letters, else of its first letter."""
    high = np.flatnonzero((data >= 0xC3))
    nearest = np.searchsorted(high, words.starts)
    at = np.where(
        (nearest < len(high)) & (np.append(high, len(data))[nearest] < words.ends), np.append(high, 0)[nearest], words.starts
    )
    b = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    lead, b1, b2, b3 = b[at], b[at + 1] & 0x3F, b[at + 2] & 0x3F, b[at + 3] & 0x3F
    point = np.select(
        [lead < 0x80, lead < 0xE0, lead < 0xF0],
        [lead, ((lead & 0x1F) << 6) | b1, ((lead & 0x0F) << 12) | (b1 << 6) | b2],
        ((lead & 0x07) << 18) | (b1 << 12) | (b2 << 6) | b3,
    )
    return _SCRIPT[np.searchsorted(_FIRSTS, point, "right") - 1]


_COUNT_SCHEMA = pa.schema([("lang", pa.string()), ("item", pa.int32()), ("n", pa.int64())])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, trigram bucket or BUCKETS + script, n), one set per task and language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, texts in _by_language(batch):
            total = counts.setdefault(lang, np.zeros(BUCKETS + len(_NAMES), np.int64))
            for chunk in chunks(texts):
                data, words = _words(chunk)
                if len(words.starts):
                    grams, _ = _trigrams(data, words)
                    total[:BUCKETS] += np.bincount(grams, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(word_scripts(data, words), minlength=len(_NAMES))
    for lang, total in counts.items():
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen)), pa.array(seen, pa.int32()), pa.array(total[seen])], schema=_COUNT_SCHEMA
        )


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    for lang in batch["lang"].unique().to_pylist():
        yield lang, batch["text"].filter(pc.equal(batch["lang"], lang))


def learn_languages(
    documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE
) -> Languages | None:
    """Trigram and script counts of about ``sample`` documents per language outside the held-out fold.

    Null texts and languages teach nothing.  Counts have at most as many rows as
    languages times buckets; more than ``MAX_LANGUAGES`` languages are refused.
    None if there is nothing to learn from.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("key"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"More than {MAX_LANGUAGES} languages; is this the language column?")
    if not sizes:
        return None
    # One scan for all languages: each row is held against its own language's share.
    grains = 1 << 30
    shares = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(grains, grains * sample // n))])
    chosen = rows.filter(F.pmod(F.xxhash64("key", "text"), F.lit(grains)) < F.element_at(shares, F.col("lang")))
    counted = chosen.select("lang", "text").mapInArrow(_count_batches, "lang string, item int, n long")
    table = counted.groupBy("lang", "item").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(sizes)
    counts = np.zeros((BUCKETS + len(_NAMES), len(names)))
    place = {name: i for i, name in enumerate(names)}
    columns = [table.column(c).to_pylist() for c in ("lang", "item", "n")]
    for name, item, n in zip(*columns):
        counts[item, place[name]] = n
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    gain = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS))
    spoken = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(axis=0))
    prior = np.array([sizes[n] for n in names], dtype=np.float64)
    return Languages(names, gain.astype(np.float32), spoken, prior / prior.sum())


def word_scores(model: Languages, data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Log probability per word and language, and whether some language uses the word's script.

    Languages without that script are ruled out; if none has it, the word's scores are equal.
    """
    n = len(words.starts)
    out = np.zeros((n, len(model.names)), dtype=np.float32)
    if not n:
        return out, np.zeros(0, dtype=bool)
    grams, begins = _trigrams(data, words)
    for j in range(len(model.names)):
        out[:, j] = np.add.reduceat(model.gain[grams, j], begins[:-1])
    allowed = model.spoken[word_scripts(data, words)]
    known = allowed.any(axis=1)
    out[~allowed] = -1e4
    out[~known] = 0
    return out, known


def viterbi(scores: np.ndarray, of_text: np.ndarray, penalty: float) -> np.ndarray:
    """Best language per word where each change costs ``penalty``.

    Texts advance side by side, longest first, so a step is a few array
    operations over all texts that are not over yet.
    """
    n, k = scores.shape
    back = np.zeros((n, k), dtype=np.int16)
    lengths = np.diff(of_text)
    order = np.argsort(-lengths, kind="stable")
    first, size = of_text[:-1][order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(1, longest + 1), "right")
    value = scores[first[: alive[0]]] if longest else np.zeros((0, k))
    own = np.arange(k, dtype=np.int16)
    final = np.zeros(len(size), dtype=np.int64)
    for t in range(1, longest):
        m = alive[t]
        if m < len(value):
            final[m : len(value)] = value[m:].argmax(axis=1)
            value = value[:m]
        best = value.argmax(axis=1)
        top = value.max(axis=1) - penalty
        stay = value >= top[:, None]
        at = first[:m] + t
        back[at] = np.where(stay, own, best[:, None])
        value = np.maximum(value, top[:, None]) + scores[at]
    final[: len(value)] = value.argmax(axis=1)
    path = np.zeros(n, dtype=np.int16)
    state = final
    for t in range(longest - 1, -1, -1):
        m = alive[t]
        at = first[:m] + t
        path[at] = state[:m]
        if t:
            state[:m] = back[at, state[:m]]
    return path


def _has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


_SPAN = pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])
_LABELLED = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])
_LABELLED_SQL = "lang string, score double, spans array<struct<lang: string, begin: long, end: long>>"


def label_texts(texts: pa.Array, model: Languages, penalty: float, with_spans: bool) -> pa.Array:
    langs, shares, spans = [], [], []
    for chunk in chunks(texts, _CHUNK):
        data, words = _words(chunk)
        scores, known = word_scores(model, data, words)
        path = viterbi(scores, words.of_text, penalty)
        n, k = len(chunk.bounds) - 1, len(model.names)
        text = np.repeat(np.arange(n), np.diff(words.of_text))
        lengths = words.ends - words.starts
        letters = np.bincount(text * k + path, lengths * known, n * k).reshape(n, k)
        total = np.bincount(text, lengths, n)
        top = np.where(letters.any(axis=1), letters.argmax(axis=1), int(model.prior.argmax()))
        plain = per_text(ASCII_LETTER[data], chunk.bounds)
        some = np.diff(words.of_text) > 0
        for i in range(n):
            begin, end = int(chunk.bounds[i]), int(chunk.bounds[i + 1])
            # Characters beyond ASCII may be signs: only texts without a-z need a closer look.
            letter = some[i] and (plain[i] > 0 or _has_letter(chunk.data[begin:end].tobytes()))
            langs.append(model.names[top[i]] if letter else UNKNOWN)
            shares.append(float(letters[i, top[i]] / total[i]) if letter else 0.0)
            if with_spans:
                one = path[words.of_text[i] : words.of_text[i + 1]] if letter else path[:0]
                cuts = np.flatnonzero(np.diff(one)) + 1
                edges = [0, *cuts.tolist(), len(one)] if len(one) else []
                spans.append([{"lang": model.names[one[b]], "begin": b, "end": e} for b, e in zip(edges[:-1], edges[1:])])
            else:
                spans.append(None)
    return pa.StructArray.from_arrays(
        [pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, pa.list_(_SPAN))], fields=list(_LABELLED)
    )


def language_of(
    text: str | Column, model: Languages | None, documents: DataFrame, penalty: float = SWITCH_PENALTY, with_spans: bool = True
) -> Column:
    """struct(lang, score, spans): the main language, its share of the letters, and word spans by language.

    A text that is null or has no letter is ``und`` with score zero and no
    spans, and so is every text if there is no model.  Letters of scripts that no
    language uses count for none; a text of nothing else gets the commonest
    language with score zero.  Words are runs of letters
    A-Z and of characters beyond ASCII; ties go to the first language by name.
    """
    if model is None:
        none = F.lit(None).cast("array<struct<lang: string, begin: long, end: long>>")
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), none.alias("spans"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(_LABELLED_SQL)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield label_texts(texts, shared.value, penalty, with_spans)

    return run(text)


def identify_languages(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    penalty: float = SWITCH_PENALTY,
    with_spans: bool = True,
) -> DataFrame:
    """One row per document: key, lang_pred, score, spans; see ``language_of``.

    Languages are learned from the same table; see ``learn_languages``.  Repeated
    rows and null keys are labelled like any other; other columns are not carried.
    """
    model = learn_languages(documents, key, text, lang, sample)
    found = language_of(F.col(text), model, documents, penalty, with_spans)
    return documents.select(F.col(key), found.alias("__found")).select(
        key, F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("score"), F.col("__found.spans").alias("spans")
    )
