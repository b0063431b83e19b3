"""What the training-data operators share: reading tables, word splitting and hashing inside tasks."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of a task's word-hash cache before it starts anew; bounds a worker's memory.
CACHE_WORDS = 1 << 17

MIX_1 = np.uint64(0x9E3779B97F4A7C15)
MIX_2 = np.uint64(0xBF58476D1CE4E5B9)


#: Rows of an Arrow batch. Texts are long: Spark's default of 10,000 rows is tens of megabytes, held
#: by the JVM and by Python at once.
BATCH_ROWS = 1_000


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once in each application, as ``--py-files`` would, and bound
    Arrow batches to ``BATCH_ROWS`` unless the session asks for less."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_sitefold_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="sitefold-"), "sitefold"), "zip",
        os.path.dirname(package), os.path.basename(package),
    )
    context.addPyFile(archive)
    context._sitefold_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; others can't clash with its own."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def crc_part(id_col: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return (F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % parts).cast("int")


class WordHash(dict):
    """word (bytes) -> 64-bit hash, computed once per word while it is in the cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * MIX_2
    return values ^ (values >> np.uint64(27))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, in order; empty when there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return hashes[:0]
    value = hashes[:count]
    for step in range(1, size):
        value = mix(value * MIX_1 + hashes[step : step + count])
    return value


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
