"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdcast.session import materialise, release  # noqa: F401

#: White space that separates words, for Java regular expressions; bytes.split() uses the same six.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """The table under positional column names, so that no name of its own can clash."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, found by exact name, whatever else the table holds."""
    return numbered(df).select(*[F.col(f"_{df.columns.index(n)}").alias(n) for n in names])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """These columns, and the whole row as the struct ``row_``; ``unpacked`` gives the row back."""
    return numbered(df).select(*[F.col(f"_{df.columns.index(n)}").alias(n) for n in names],
                               F.struct("*").alias("row_"))


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"row_._{i}").alias(n) for i, n in enumerate(like.columns)])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo; 0 without an id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit integers (public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash(dict):
    """64-bit hash of each word (bytes), remembered; forgets all beyond ``most`` words."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lowered(text: str | None) -> bytes:
    """A text as UTF-8 with A-Z in lower case; its split() are its words."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def words_bytes(text: str | None) -> list[bytes]:
    return lowered(text).split()


def pieces_of(batches: Iterable, rows: int = 1_000):
    """Arrow batches cut to a few rows, as Python copies of ten thousand texts would weigh on every worker."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def columns_of(batches: Iterable, names: tuple[str, ...]):
    """Python lists of the named columns of each Arrow batch."""
    for batch in batches:
        yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)
