"""Helpers shared by the operators of this subpackage.

Inputs are plain DataFrames.  Every operator selects the columns it needs by name, so
extra columns (also ones named like its own results) are ignored unless it says that it
carries them along.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.session import scratch_path

#: The documents' word separators: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"

#: Bytes of text that a Python task turns into words at a time.
SLICE_BYTES = 2 << 20


def workers_find_us(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Matters where it is neither installed nor shipped nor in the working folder; a path that
    an executor lacks is ignored there.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage: a lost executor costs the tasks that read the written files, not the
    whole plan above them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores after it while there is such a column (in any case) already."""
    have = {c.lower() for c in columns}
    while name.lower() in have:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """array<string> of the words; empty for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    """Number of words as bigint; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on beside others after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes of text each.

    Bounds what a task holds at a time by bytes, whatever the number of rows in a batch; a
    longer single text makes a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
        give_back()


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and the number of words of each text."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(text)
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    counts = np.diff(lists.offsets.to_numpy())
    mask = real.to_numpy(zero_copy_only=False)
    if not mask.all():
        row = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(row[mask], minlength=len(counts))
        flat = flat.filter(real)
    return flat, counts.astype(np.int64)


def coded_words(text: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words as codes into the distinct words, the distinct words, and the words of each text.

    ``lower`` puts A-Z in lower case.
    """
    flat, counts = split_words(text)
    coded = flat.dictionary_encode()
    codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    if lower:  # of the distinct words only
        again = pc.ascii_lower(distinct).dictionary_encode()
        codes, distinct = again.indices.to_numpy().astype(np.int64)[codes], again.dictionary
    return codes, distinct, counts


def string_hashes(values: pa.Array) -> np.ndarray:
    """A fixed 64-bit hash (SipHash) of each string."""
    from pandas.util import hash_array

    return hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mixing of unsigned 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each run begins when runs of these lengths follow each other."""
    return np.cumsum(counts) - counts


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(doc_id.cast("string"))


#: DuckDB: the text with A-Z in lower case (null: empty), and the crc32 of the id written as text.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CRC32_OF_ID = """xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT),
    lambda acc, b: list_reduce(range(8), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END, xor(acc, b)),
    4294967295::BIGINT), 4294967295::BIGINT)"""

#: Bits of the filter of may_be_in(): 256 bitmaps of 4 KB, whatever the number of ids.
FILTER_BITS, BITMAP_BITS = 1 << 23, 1 << 15


def may_be_in(df: DataFrame, column: str, ids: DataFrame, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false only if ``column`` isn't among ``ids`` (one column).

    Spares the join that follows from shuffling rows that have no partner.  The filter is a
    table of at most FILTER_BITS bits, so it can be broadcast at any size of input; with very
    many ids it is true more often, and the join still decides.
    """
    place = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(FILTER_BITS))
    bits = ids.select(place(ids[ids.columns[0]]).alias("p")).groupBy(F.floor(F.col("p") / BITMAP_BITS).alias("__map")).agg(F.bitmap_construct_agg(F.pmod("p", F.lit(BITMAP_BITS))).alias("__bits"))
    p = place(df[column])
    d = df.withColumns({"__map": F.floor(p / BITMAP_BITS), "__bit": F.pmod(p, F.lit(BITMAP_BITS))}).join(F.broadcast(bits), "__map", "left")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(F.col("__bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.bit_get(byte, F.pmod("__bit", F.lit(8)).cast("int")) == 1, F.lit(False))
    return d.select(*df.columns, hit.alias(out))
