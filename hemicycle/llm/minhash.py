"""Near-duplicate documents by min-max MinHash, banding and exact confirmation.

Every permutation gives two values, the least and the greatest hash of the set, so 80 permutations
make a signature of 160 values at half the hash evaluations. 40 bands of 4 values miss a pair of
similarity 0.75 with probability (1 - 0.75^4)^40 = 2.5e-7. Links are confirmed on the full sets.

Equal sets are one class; only classes are compared. Within a band bucket, every class is compared
with the first one, never all with all. Classes of one bucket that this leaves in different components
meet once more in blocks, but only where they hang together by their rarest shingles, which loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hemicycle.llm.common import WordHashes, as_bytes, components, mixed, rolling, small_batches, word_hashes
from hemicycle.session import stored

SHINGLE = 5
PERCENT = 75
BANDS = 40
ROWS = 4
#: Sets of a block, where blocks are compared with each other.
BLOCK = 256

_CACHE = WordHashes()
_STEP = 2048


def shingle_set(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words, A-Z lower-cased.

    Fewer words make one shingle of all; no words make an empty set.
    """
    words, _ = word_hashes([(text or b"").lower()], _CACHE)
    if not len(words):
        return words
    # The length is part of the seed, so a short text never equals a shingle of a longer one.
    size = min(k, len(words))
    return np.unique(rolling(words, size, seed=11 + size))


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and masks of ``n`` permutations of 32-bit values."""
    draw = np.random.default_rng(20_240_501)
    odd = draw.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], draw.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def min_max_signature(shingles: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Least values under all permutations, then the greatest ones."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    high = np.zeros(len(factors), np.uint32)
    for i in range(0, len(x), _STEP):
        y = (x[None, i : i + _STEP] ^ masks) * factors
        np.minimum(low, y.min(axis=1), out=low)
        np.maximum(high, y.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key of each band; its number is part of it."""
    values = signature.reshape(bands, rows).astype(np.uint64)
    key = mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for i in range(rows):
        key = mixed(key ^ values[:, i])
    return key


def _signed(bands: int, rows: int):
    factors, masks = permutations(bands * rows // 2)
    kind = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, keys = [], [], [], []
            for text in as_bytes(batch.column("text")):
                shingles = shingle_set(text)
                sizes.append(len(shingles))
                if not len(shingles):
                    one.append(None)
                    two.append(None)
                    keys.append(None)
                    continue
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                one.append(int.from_bytes(digest[:8], "little", signed=True))
                two.append(int.from_bytes(digest[8:], "little", signed=True))
                keys.append(band_hashes(min_max_signature(shingles, factors, masks), bands, rows).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()), pa.array(keys, kind),
                ],
                ["doc_id", "n_shingles", "one", "two", "bands"],
            )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_set(text).view(np.int64) for text in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("pivot"), pa.array(found, pa.list_(pa.int64()))], ["id", "pivot", "shingles"]
        )


def confirmed(sets: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` of ids whose full shingle sets have the similarity asked for; ``a`` is a pivot in ``sets``."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = both.join(sets.filter("pivot").select(F.col("id").alias("a"), F.col("shingles").alias("of_a")), "a")
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a") + F.size("of_b") - common
    return both.filter((common > 0) & (100 * common >= percent * union)).select("a", "b")


def classes_of(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Of every document its size and set key; of every set its least id and its band keys."""
    small_batches(docs.sparkSession)
    signed = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _signed(bands, rows), "doc_id long, n_shingles long, one long, two long, bands array<long>"
        ),
        "minhash_signed",
    )
    least = signed.filter("one is not null and doc_id is not null").groupBy("one", "two").agg(F.min("doc_id").alias("rep"))
    least = stored(least, "minhash_classes")
    first = signed.join(least.withColumnRenamed("rep", "doc_id"), ["one", "two", "doc_id"])
    return signed.drop("bands"), stored(first.select(F.col("doc_id").alias("rep"), "one", "two", "bands"), "minhash_reps")


def links(docs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Component of every class that has a link: ``(id, component)``."""
    rows = reps.select("rep", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("pivot"))
    buckets = stored(buckets.filter("n > 1").select("band", "pivot"), "minhash_buckets")
    members = stored(rows.join(buckets, "band").select("band", "rep", "pivot"), "minhash_members")
    pairs = members.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = stored(pairs, "minhash_pairs")
    ids = members.groupBy(F.col("rep").alias("id")).agg(F.max(F.col("rep") == F.col("pivot")).alias("pivot"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(stored(ids, "minhash_ids"), "id").select("id", "pivot", "text")
    sets = stored(texts.mapInArrow(_sets, "id long, pivot boolean, shingles array<long>"), "minhash_sets")
    edges = stored(confirmed(sets, pairs, percent), "minhash_edges")
    named = components(edges, "minhash_components")
    apart = stored(apart_in_buckets(members.select("band", "rep"), named), "minhash_apart")
    if apart.isEmpty():
        return named
    found = block_links(sets, apart, rare_shingles(sets, apart, percent), percent)
    return components(edges.union(found), "minhash_components")


def apart_in_buckets(members: DataFrame, named: DataFrame) -> DataFrame:
    """Classes ``(id, component)`` in the buckets that hold more than one component."""
    labelled = members.join(named.select(F.col("id").alias("rep"), "component"), "rep", "left")
    labelled = stored(labelled.withColumn("component", F.coalesce("component", "rep")), "minhash_labelled")
    several = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = stored(several.filter("low < high").select("band"), "minhash_several")
    return labelled.join(several, "band").select(F.col("rep").alias("id"), "component").distinct()


def rare_shingles(sets: DataFrame, apart: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rarest shingles of each set, of which it shares one with any partner in another component.

    Such a pair shares only shingles that occur in several components. Sets that share ``percent`` of
    their union share one of the first n - ceil(n * percent / 100) + 1 shingles of each in any common
    order, so those alone need to meet; with the unshared ones first and the rarest next, few do.
    """
    flat = sets.join(apart, "id").select("id", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    held = flat.groupBy("s").agg(F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    rows = flat.join(stored(held.filter("low < high").select("s", "df"), "minhash_frequencies"), "s")
    mine = Window.partitionBy("id")
    rows = rows.withColumn("place", F.row_number().over(mine.orderBy("df", "s"))).withColumn("shared", F.count("*").over(mine))
    # The intersection is no larger than what is shared, and the union no smaller than the set.
    rows = rows.filter(100 * F.col("shared") >= percent * F.col("n"))
    places = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("shared"))
    return stored(rows.filter(F.col("place") <= places).select("s", "id", "component", "n", "shared"), "minhash_rare")


def block_links(sets: DataFrame, apart: DataFrame, rare: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between sets of different components, found by comparing blocks of sets: ``(a, b)``.

    Sets that hang together by rare shingles form a cluster. A cluster is dealt into blocks of about
    ``BLOCK`` sets and every two blocks meet in one task, which counts all intersections by a matrix
    product and gives the links only.
    """
    first = stored(rare.groupBy("s").agg(F.min("id").alias("pivot")), "minhash_first")
    stars = rare.join(first, "s").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    clusters = components(stars, "minhash_clusters").withColumnRenamed("component", "cluster")
    counts = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = clusters.join(stored(counts, "minhash_blocks"), "cluster").withColumn("block", mine)
    dealt = dealt.join(apart, "id").select("id", "cluster", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("id", "cluster", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    key = ["cluster", "low", "high"]
    rows = stored(dealt, "minhash_dealt").join(sets.select("id", "shingles"), "id").repartition(*key).sortWithinPartitions(*key)
    return rows.select(*key, "id", "component", "block", "shingles").mapInArrow(_compare(percent), "a long, b long")


def _compare(percent: int):
    def linked(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        low, high = rows[0][1], rows[0][2]
        left = [r for r in rows if r[5] == low]
        right = left if low == high else [r for r in rows if r[5] == high]
        group = left if low == high else left + right
        sizes = np.array([len(r[6]) for r in group])
        _, code, df = np.unique(np.concatenate([r[6] for r in group]), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(group)), sizes)
        keep = df[code] > 1
        code, owner = code[keep], owner[keep]
        _, code = np.unique(code, return_inverse=True)
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        n_left = len(left)
        here = np.zeros((n_left, len(right)), np.float32)
        for begin in range(0, int(code[-1]) + 1 if len(code) else 0, _STEP):
            span = slice(*np.searchsorted(code, [begin, begin + _STEP]))
            dense = np.zeros((len(group), _STEP), np.float32)
            dense[owner[span], code[span] - begin] = 1
            here += dense[:n_left] @ (dense if low == high else dense[n_left:]).T
        n = sizes.astype(np.float64)
        n_right = n if low == high else n[n_left:]
        union = n[:n_left, None] + n_right[None, :] - here
        parts_left, parts_right = (np.array([r[4] for r in side]) for side in (left, right))
        ids_left, ids_right = (np.array([r[3] for r in side]) for side in (left, right))
        apart = (parts_left[:, None] != parts_right[None, :]) & (ids_left[:, None] != ids_right[None, :])
        i, j = np.nonzero(apart & (100.0 * here >= percent * union))
        return ids_left[i], ids_right[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def give() -> pa.RecordBatch:
            a, b = linked(waiting) if waiting else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            shingles = batch.column("shingles")
            ends, values = shingles.offsets.to_numpy(), shingles.values.to_numpy(zero_copy_only=False)
            plain = zip(*(batch.column(c).to_pylist() for c in ("cluster", "low", "high", "id", "component", "block")), strict=True)
            for i, row in enumerate(plain):
                if waiting and waiting[-1][:3] != row[:3]:
                    yield give()
                    waiting.clear()
                waiting.append((*row, values[ends[i] : ends[i + 1]]))
        yield give()

    return run


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Args: ``docs`` with integer ``doc_id`` and ``text``; other columns are not read. Documents whose
    sets of five-word shingles have 100 * intersection >= ``percent`` * union are linked; the component
    is the least id that links reach. Documents without words are linked with nothing. Rows of one id
    count as one document. A row without an id takes no part: its component is null and it is kept.
    An empty table gives an empty table.
    """
    documents, reps = classes_of(docs, bands, rows)
    named = links(docs, reps, percent)
    classes = reps.select("rep", "one", "two").join(named.withColumnRenamed("id", "rep"), "rep", "left")
    classes = stored(classes.select("one", "two", F.coalesce("component", "rep").alias("component")).distinct(), "minhash_named")
    out = documents.join(classes, ["one", "two"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; of rows that share an id, one."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    kept = stored(near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct(), "minhash_kept")
    keyed = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").alias("by"), row)
    turn = F.row_number().over(Window.partitionBy("key").orderBy("by"))
    left = keyed.join(kept, keyed["key"] == kept["doc_id"], "left_semi").withColumn("turn", turn).filter("turn = 1")
    return left.select("doc").union(keyed.filter("key is null").select("doc")).select("doc.*")
