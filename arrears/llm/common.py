"""What the operators share: batches of rows, words, hashes, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.session import fresh_path

#: Maps bytes to lower case where they belong to a word of ASCII letters, digits or non-ASCII characters, and to a
#: blank elsewhere.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: A batch given to an operator's function holds at most so many bytes of text, or one row.
BATCH_BYTES = 2 << 20
#: Rows of numbers that one file of a staged table holds, where a bound of its rows is known.
FILE_ROWS = 1 << 17


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.translate(PLAIN).split()


def blank_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` cuts at exactly these six bytes."""
    return text.split()


class WordHashes(dict):
    """XXH64 of words, remembered until there are ``most`` of them."""

    def __init__(self, seed: int = 0, most: int = 300_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, self.seed)
        if len(self) < self.most:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def sum_tail(text: bytes) -> int:
    """Continuation bytes of UTF-8 text: bytes minus characters."""
    return 0 if text.isascii() else int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], text: int = 0) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``BATCH_BYTES`` of the text column (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column(text)).to_pylist()])
        cell = np.cumsum(sizes) // BATCH_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def map_text(
    df: DataFrame, schema: str | T.StructType, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], text: str
) -> DataFrame:
    """``mapInArrow`` over small batches; ``text`` names the column that decides their size.

    A column ``row`` comes first in the result if the input has one; ``schema`` gives the other columns.
    """
    position = df.columns.index(text)
    if isinstance(schema, str) and "row" in df.columns:
        schema = T.StructType([df.schema["row"], *T.StructType.fromDDL(schema).fields])
    return df.mapInArrow(lambda batches: work(small_batches(batches, position)), schema)


def pack(keep: Iterable[str]) -> Column:
    """The given columns, whatever their names, as one column ``row``, so that none clashes with an operator's own."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in keep]).alias("row")


def keyed(docs: DataFrame, key: str, *content: str) -> DataFrame:
    """``row`` (all columns), ``id`` (the key) and ``mark`` (hash of the given columns).

    Rows that agree in id and mark get the same verdicts, so these can be joined back and texts need not be staged.
    """
    return docs.select(pack(docs.columns), F.col(key).alias("id"), F.xxhash64(*content).alias("mark"))


def with_verdicts(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Keyed rows joined with verdicts, of which there is one for each id (null too) and mark.

    A task's verdicts are hashed, so that the rows, which hold texts, need not be sorted.
    """
    right = verdicts.withColumnsRenamed({"id": "id ", "mark": "mark "}).hint("shuffle_hash")
    return rows.join(right, rows["id"].eqNullSafe(right["id "]) & (rows["mark"] == right["mark "])).drop("id ", "mark ")


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write below ``spark.checkpoint.dir`` and read back: cuts the lineage, survives lost executors.

    ``rows`` bounds the rows of a table of a few numbers: it then gets a file for each ``FILE_ROWS`` of them, at least
    one for each core, however many partitions made it. Each file costs processes and requests, whatever it holds.
    """
    path = fresh_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lists(values: np.ndarray, counts: Iterable[int], kind: pa.DataType) -> pa.ListArray:
    """A list column out of flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
