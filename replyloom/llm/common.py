"""What several operators share: stored tables, folds and a flat view of texts.

The flat view holds the bytes of some hundred texts at a time, so that words,
windows and their digests are found with array operations.  A chunk holds one
text at least, so memory follows the longest text, never the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.session import shared_folder

CHUNK_BYTES = 1 << 20
FOLDS = 3
HELD_OUT_FOLD = 1
SPACES = (0x20, *range(0x09, 0x0E))


# -- tables ------------------------------------------------------------------


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path that does not exist yet, in the folder every executor reaches."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Stored(NamedTuple):
    rows: DataFrame
    path: str

    def drop(self) -> None:
        """Give the disk back once nothing reads the table any more."""
        jvm = self.rows.sparkSession._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.rows.sparkSession._jsc.hadoopConfiguration()
        place.getFileSystem(conf).delete(place, True)


def store(df: DataFrame, label: str) -> Stored:
    """Write ``df`` to the shared folder and read it again.

    This cuts the lineage: what comes after reads the files, and the loss of an
    executor cannot make Spark compute what came before once more.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path), path)


def held_out(key: str | Column) -> Column:
    """True for rows whose label and language no model may see; null keys are seen."""
    column = F.col(key) if isinstance(key, str) else key
    fold = F.pmod(F.crc32(column.cast("string")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def bounded_sample(df: DataFrame, n_rows: int, bound: int, *keys: str) -> DataFrame:
    """About ``bound`` of ``n_rows`` rows, chosen by a hash of ``keys``; all, if fewer.

    The choice depends on the row alone, so a task that runs again chooses alike.
    """
    if n_rows <= bound:
        return df
    grains = 1 << 30
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(grains)) < int(grains * bound / n_rows))


# -- flat texts --------------------------------------------------------------


def byte_table(*members: int) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = ~byte_table(*SPACES)
#: Digits, a-z and every byte of a character beyond ASCII, in lower-cased text.
ALNUM = byte_table(*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100))
LETTER = byte_table(*range(0x61, 0x7B), *range(0x80, 0x100))


class Texts(NamedTuple):
    """Rows ``first`` to ``last`` of an array: their bytes, and where each begins."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Byte ranges of words, and at ``of_text`` the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    of_text: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Slices of a string array by bytes; a null is an empty text."""
    plain = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(plain, pa.ChunkedArray):
        plain = plain.combine_chunks()
    n = len(plain)
    if not n:
        return
    _, offsets, data = plain.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[plain.offset : plain.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + limit, "right")) - 1)
        yield Texts(first, last, raw[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
        first = last


def split_words(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> Words:
    """Maximal runs of the bytes in ``member``; a run ends where its text does."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = member[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    here = inside[1:-1]
    starts = np.flatnonzero(here & (edge[:-1] | ~inside[:-2]))
    ends = np.flatnonzero(here & (edge[1:] | ~inside[2:])) + 1
    return Words(starts, ends, np.searchsorted(starts, bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def word_digests(data: np.ndarray, words: Words) -> np.ndarray:
    """64-bit digests of the words, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = words.ends - words.starts
    out = mix(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, alive = words.starts, None
    while len(left):
        value = mix((lanes[at] & _KEEP[np.minimum(left, 8)]) ^ (out if alive is None else out[alive]))
        if alive is None:
            out = value
        else:
            out[alive] = value
        more = np.flatnonzero(left > 8)
        alive = more if alive is None else alive[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def window_digests(digests: np.ndarray, length: int) -> np.ndarray:
    """Digests of ``length`` consecutive items, one per possible first item."""
    n = len(digests) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = digests[:n]
    for k in range(1, length):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) ^ digests[k : k + n])
    return out


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the flags between two bounds are set."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal a small table out to all cores; larger scans have splits enough."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
