"""Shared pieces: reading tables, words and their hashes, ranks, groups that repeat, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hemicycle.session import stored

#: Rows of an Arrow batch: bounds a worker's memory where texts are long.
BATCH_ROWS = 256
#: Words that one vectorised step takes at most, unless a single text is longer.
STEP_WORDS = 1 << 20
#: Entries of a worker's cache before it is emptied.
CACHE_ENTRIES = 400_000
#: Bytes of a word that is kept: text without blanks is one word of any length.
LONGEST = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table, read in Arrow batches that keep a worker's memory small."""
    small_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column, without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words; those of short words are kept until the cache is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST:
            self[word] = value
        return value


def word_hashes(texts: Sequence[bytes], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each text.

    Words are runs of bytes other than the six ASCII white-space bytes, which is what
    ``bytes.split`` cuts at.
    """
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    return np.fromiter(map(cache.__getitem__, chain.from_iterable(split)), np.uint64, int(counts.sum())), counts


def steps(texts: Sequence[bytes], size: int = 8 * STEP_WORDS) -> Iterator[slice]:
    """Slices of the texts of about ``size`` bytes each."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def rolling(words: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive words, in O(n log k) vector steps."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    base = int(mixed(np.array([seed], np.uint64))[0]) | 1
    # done: hash of the first `covered` words at each place; block: hash of 2^i words at each place.
    block, span, power = mixed(words ^ np.uint64(seed)), 1, base
    done, covered = None, 0
    while True:
        if k & span:
            if done is None:
                done, covered = block, span
            else:
                n = len(words) - covered - span + 1
                done = done[:n] * np.uint64(power) + block[covered : covered + n]
                covered += span
        if covered == k:
            return mixed(done[: len(words) - k + 1])
        block = block[:-span] * np.uint64(power) + block[span:]
        power, span = power * power % 2**64, span * 2


def scrambled(c: Column) -> Column:
    """A bijection of long values (shifts and exclusive or), so that their order says nothing."""
    x = c.bitwiseXOR(F.lit(0x2545F4914F6CDD1D))
    x = x.bitwiseXOR(F.shiftleft(x, 13))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return x.bitwiseXOR(F.shiftleft(x, 17))


def ranked(rows: DataFrame, order: Sequence[str], label: str, rank: str = "rank") -> DataFrame:
    """``rows`` with their place from 0 in the order of the columns ``order``, nulls first.

    The rows are range-partitioned and sorted; what is summed up over all of them is one count
    for each partition. The sorted rows are written, as a repeated sort could cut elsewhere.
    """
    part, at = "_llm_part", "_llm_at"
    dealt = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        label,
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(part).agg(F.count("*").alias("_llm_n"))
    starts = starts.select(part, F.coalesce(F.sum("_llm_n").over(before), F.lit(0)).alias("_llm_start"))
    return dealt.join(starts, part).withColumn(rank, F.col("_llm_start") + F.col(at)).drop(part, at, "_llm_start")


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of the edges ``(a, b)``: ``(id, component)`` with the least id reached.

    Each round every vertex joins its least neighbour in a scrambled order and the edges between
    joined vertices remain, so the edges shrink by a factor and chains do not make it slow.
    Every round is written to the shared folder; a lost executor costs one round's task.
    """
    start = stored(edges.filter("a <> b").distinct(), label)
    rest = stored(start.select(scrambled(F.col("a")).alias("u"), scrambled(F.col("b")).alias("v")), label)
    maps = []
    while not rest.isEmpty():
        both = rest.union(rest.select("v", "u"))
        least = stored(
            both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to")), label
        )
        maps.append(least)
        step = rest.join(least, "u").select(F.col("to").alias("u"), "v")
        step = stored(step, label).join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("to").alias("v"))
        rest = stored(step.filter("u <> v").distinct(), label)
    ids = start.select(F.col("a").alias("id")).union(start.select("b")).distinct()
    found = ids.withColumn("root", scrambled(F.col("id")))
    for least in maps:
        found = stored(
            found.join(least.withColumnRenamed("u", "root"), "root", "left")
            .select("id", F.coalesce("to", "root").alias("root")),
            label,
        )
    if not maps:
        return ids.select("id", F.col("id").alias("component"))
    names = stored(found.groupBy("root").agg(F.min("id").alias("component")), label)
    return stored(found.join(names, "root").select("id", "component"), label)
