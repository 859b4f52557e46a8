"""What several operators share: words of a text, cached word hashes, reading tables, held-out folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import stage_table

T = TypeVar("T")

# Entries a per-worker cache holds before it is emptied; bounds its memory, never a result.
CACHED_WORDS = 300_000
# Bytes of texts a worker takes from its batch at once, where one text is not longer; bounds its memory, never a result.
PORTION_BYTES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(text: str = "text") -> Column:
    """A text as UTF-8 bytes, null as empty.

    ``bytes.lower().split()`` then lower-cases A-Z alone and splits at the six
    ASCII white-space characters alone.
    """
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def held_out(id_column: str, folds: int, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds``; a null id is held out."""
    return F.coalesce(
        F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds)) == fold,
        F.lit(True),
    )


class WordCache(dict, Generic[T]):
    """A dict that computes what it lacks; when half full it starts anew, and takes over what is asked for again."""

    def __init__(self, compute: Callable[[bytes], T], most: int = CACHED_WORDS) -> None:
        super().__init__()
        self.compute, self.most = compute, most
        self.before: dict[bytes, T] = {}

    def __missing__(self, word: bytes) -> T:
        if 2 * len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        value = self.before.get(word)
        if value is None:
            value = self.compute(word)
        self[word] = value
        return value


def hash_cache() -> WordCache[int]:
    return WordCache(xxhash.xxh64_intdigest)


def hashes(words: list[bytes], cache: WordCache[int]) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def batches(column: list, size: int) -> Iterator[list]:
    for start in range(0, len(column), size):
        yield column[start : start + size]


def portions(frames: Iterator[pa.RecordBatch], *columns: str, most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows in order, in slices whose ``columns`` hold ``most`` bytes together, or a single row of more."""
    for frame in frames:
        sizes = np.zeros(frame.num_rows, np.int64)
        for name in columns:
            sizes += pc.fill_null(pc.binary_length(frame.column(name)), 0).to_numpy(zero_copy_only=False)
        ends, low = np.cumsum(sizes), 0
        while low < frame.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - sizes[low] + most, "right")))
            yield frame.slice(low, high - low)
            low = high


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later joins see plain shuffles of stored rows."""
    return stage_table(df, name)
