"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to a few bits, the curve gives every cell a place, rows are sorted by that
place and cut into runs of equal length. Rows of one shard are close in all dimensions, so the
per-file statistics of each of them prune files.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import ranked
from hemicycle.session import stored

SHARDS = 16
BITS = 4


def hilbert_places(coords: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells given by one array of ``bits``-bit values per dimension.

    From the highest bit down, a set bit of a dimension flips the lower bits of the first one and a
    clear bit exchanges them with it; the Gray code of the result, read across the dimensions, is the
    place.
    """
    x = [np.array(c, np.int64) for c in coords]
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for i in range(len(x)):
            high = (x[i] >> q) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> q) & 1 == 1, (1 << q) - 1, 0)
    place = np.zeros_like(x[0])
    for q in range(bits - 1, -1, -1):
        for c in x:
            place = (place << 1) | (((c ^ flip) >> q) & 1)
    return place


def hilbert_index(dims: Sequence[Column], bits: int = BITS) -> Column:
    """The place of a row's cell, computed a batch at a time."""

    @F.arrow_udf("long")
    def place(cells: pa.Array) -> pa.Array:
        return pa.array(hilbert_places([c.to_numpy(zero_copy_only=False) for c in cells.flatten()], bits))

    return place(F.struct(*[d.cast("long").alias(f"d{i}") for i, d in enumerate(dims)]))


def text_level(c: Column, bits: int = BITS) -> Column:
    """Quantises a name: the high bits of its hash, null first."""
    return F.when(c.isNull(), F.lit(0)).otherwise(F.xxhash64(c).bitwiseAND(F.lit((1 << bits) - 1))).cast("long")


def size_level(c: Column, bits: int = BITS) -> Column:
    """Quantises a count: its binary order of magnitude, small and missing counts first."""
    level = F.floor(F.log2(F.greatest(F.coalesce(c, F.lit(0)), F.lit(1)).cast("double")))
    return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), level - 3)).cast("long")


def hilbert_shards(rows: DataFrame, dims: Sequence[Column], ties: Sequence[str], shards: int = SHARDS) -> DataFrame:
    """Adds ``curve``, ``shard`` (0 to ``shards`` - 1, counts at most one apart) and ``slot`` to narrow rows.

    ``ties`` orders rows of one cell. Row number r of n goes to shard floor(r * shards / n). Keep the
    rows narrow: they are sorted once; texts are joined to the result where they are written.
    An empty table gives an empty table.
    """
    placed = stored(rows.withColumn("curve", hilbert_index(dims)), "sharding_rows")
    order = ranked(placed, ["curve", *ties], "sharding_order")
    total = placed.agg(F.count("*").alias("total"))
    r, n = F.col("rank"), F.col("total")
    # Exact in whole numbers: the quotient of long values, not of doubles.
    shard = F.call_function("div", r * F.lit(shards), n)
    out = order.join(total).withColumn("shard", shard.cast("int"))
    first = F.call_function("div", F.col("shard").cast("long") * n + F.lit(shards - 1), F.lit(shards).cast("long"))
    return out.withColumn("slot", r - first).drop("rank", "total")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shards of ``documents`` by source, language and length; the law is equal row counts.

    Returns ``doc_id, size`` (UTF-8 bytes + 1)``, text_crc32, law, shard, slot, grown_shard, curve``, one
    row per input row. Null texts count as empty, null names and counts come first in their dimension.
    Equal texts of one cell lie side by side; equal rows take neighbouring slots.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "source", "lang", "n_chars", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    dims = [text_level(F.col("source")), text_level(F.col("lang")), size_level(F.col("n_chars"))]
    out = hilbert_shards(rows, dims, ["text_crc32", "doc_id"], shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )
