"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits; two link at ``distance`` or fewer differing bits. Its bits are cut into
``SEGMENTS`` equal segments on a ring. Whenever two fingerprints link, some segment starts a chain along
which the differences of the first l segments sum up to no more than l * distance / SEGMENTS, for every
l. With eight segments and three bits the first two segments of such a chain are equal, and of the next
three at most one bit differs; so the two agree on the first two segments and on two of the next three:

1. distinct fingerprints meet in buckets of these 32 bits, one for each start and segment left out;
2. in a bucket the chain from its start prunes the pairs, length by length, before the full Hamming check;
3. a bucket gives the links of a spanning forest only, never all its pairs. One with more than ``LIMIT``
   fingerprints is dealt again: of the bits outside its key, cut into ``distance`` + 1 parts, linked
   fingerprints agree on one part, which makes the key longer. Once few bits are left a bucket cannot
   be large, as its fingerprints are distinct; so no task gets an unbounded group and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import as_bytes, components, small_batches
from hemicycle.session import stored

BITS = 64
SHINGLE = 3
SEED = 42
DISTANCE = 3
SEGMENTS = 8
#: Fingerprints that one bucket may hold.
LIMIT = 512
#: Shingles whose bits are counted in one step, and about as many pairs that are compared in one.
_STEP = 1 << 16
_PAIRS = 1 << 19
#: A bucket's key is the first three: where its chain starts, the bits that its fingerprints share, and their values.
_KEY = ["start", "mask", "value"]
_COLUMNS = [*_KEY, "fingerprint", "rep"]


def fingerprint(text: bytes | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: those that are set in over half of the hashes of the runs of ``k`` words, A-Z lower-cased.

    Fewer words make one run of all; no words give zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    k = min(k, len(words))
    runs = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    n = len(words) - k + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(seed)), np.dtype("<u8"), n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, _STEP):
        part = hashes[i : i + _STEP].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in as_bytes(batch.column("text"))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])


def budgets(distance: int, segments: int) -> list[int]:
    """Differences that a chain of 1, 2, ... segments may have."""
    return [length * distance // segments for length in range(1, segments + 1)]


def _mask(positions: Iterator[int]) -> int:
    return sum(1 << p for p in positions)


def first_masks(distance: int, segments: int) -> list[tuple[int, int]]:
    """Of every key that fingerprints meet by first: the segment its chain starts at, and the bits it has."""
    width = BITS // segments
    allowed = budgets(distance, segments)
    equal = sum(b == 0 for b in allowed)
    one_off = sum(b == 1 for b in allowed)
    found = []
    for start in range(segments):
        ring = [_mask(range(s % segments * width, (s % segments + 1) * width)) for s in range(start, start + segments)]
        for left_out in range(one_off or 1):
            found.append((start, sum(ring[:equal]) + sum(m for i, m in enumerate(ring[equal : equal + one_off]) if i != left_out)))
    return found


def finer_masks(mask: int, parts: int) -> list[int]:
    """The mask with each of ``parts`` parts of the bits that it lacks."""
    free = [p for p in range(BITS) if not mask >> p & 1]
    return [mask | _mask(map(int, part)) for part in np.array_split(free, parts)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _finer(distance: int):
    """The rows of crowded buckets with longer keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = distance + 1
        for batch in batches:
            masks, which = np.unique(batch.column("mask").to_numpy().view(np.uint64), return_inverse=True)
            finer = np.array([finer_masks(int(m), parts) for m in masks], np.uint64).reshape(-1, parts)[which].ravel()
            start, prints, reps = (np.repeat(batch.column(c).to_numpy(), parts) for c in ("start", "fingerprint", "rep"))
            value = (prints.view(np.uint64) & finer).view(np.int64)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (start, finer.view(np.int64), value, prints, reps))), _COLUMNS)

    return run


def linked_pairs(prints: np.ndarray, ends: np.ndarray, starts: np.ndarray, distance: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of each bucket: ``ends[i]`` is where the bucket of place i ends, ``starts[i]`` its chain's start."""
    width = BITS // segments
    count = ends - np.arange(len(prints)) - 1
    left = np.repeat(np.arange(len(prints)), count)
    right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
    differ = prints[left] ^ prints[right]
    total = np.zeros(len(left), np.int64)
    for step, allowed in enumerate(budgets(distance, segments)[:-1]):
        shift = ((starts[left] + step) % segments * width).astype(np.uint64)
        total = total + np.bitwise_count((differ >> shift) & np.uint64((1 << width) - 1))
        alive = np.flatnonzero(total <= allowed)
        left, right, differ, total = left[alive], right[alive], differ[alive], total[alive]
    alive = np.bitwise_count(differ) <= distance
    return left[alive], right[alive]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least place that each of ``n`` places reaches by the links."""
    label = np.arange(n)
    while len(left):
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _compare(distance: int, segments: int):
    """Links ``(a, b)`` that connect the linked fingerprints of each bucket; the rows come sorted by bucket."""

    def linked(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        start, mask, value, prints, reps = columns
        new = np.flatnonzero((start[1:] != start[:-1]) | (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
        bounds = np.concatenate([[0], new, [len(start)]])
        sizes = np.diff(bounds)
        step = (np.cumsum(sizes * (sizes - 1) // 2) - 1) // _PAIRS
        for at in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(step)) + 1):
            here = slice(bounds[at[0]], bounds[at[-1] + 1])
            ends = np.repeat(bounds[at + 1] - bounds[at[0]], sizes[at])
            left, right = linked_pairs(prints[here].view(np.uint64), ends, start[here], distance, segments)
            label = forest(len(ends), left, right)
            odd = np.flatnonzero(label != np.arange(len(ends)))
            yield pa.RecordBatch.from_arrays([pa.array(reps[here][odd]), pa.array(reps[here][label[odd]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in _COLUMNS]
            if waiting is not None:
                rows = [np.concatenate(pair) for pair in zip(waiting, rows, strict=True)]
            if not len(rows[0]):
                continue
            earlier = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in rows[:3]]))
            cut = int(earlier[-1]) + 1 if len(earlier) else 0
            if cut:
                yield from linked([c[:cut] for c in rows])
            waiting = [c[cut:] for c in rows]
        if waiting is not None and len(waiting[0]):
            yield from linked(waiting)

    return run


def links(reps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, limit: int = LIMIT) -> DataFrame:
    """Links ``(a, b)`` that connect all ``reps`` (``fingerprint``, ``rep``; distinct fingerprints) that reach each other."""
    if not 0 <= distance < segments or BITS % segments:
        raise ValueError("fewer differing bits than segments, and segments of equal width, are needed")
    keys = [
        F.struct(F.lit(start).alias("start"), F.lit(_signed(m)).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("value"))
        for start, m in first_masks(distance, segments)
    ]
    rows = reps.select(F.explode(F.array(*keys)).alias("key"), "fingerprint", "rep").select("key.*", "fingerprint", "rep")
    found = []
    while True:
        sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("n")).filter("n > 1")
        met = stored(rows.join(stored(sizes, "simhash_sizes"), _KEY), "simhash_met")
        few = met.filter(F.col("n") <= limit).drop("n").repartition(*_KEY).sortWithinPartitions(*_KEY)
        found.append(stored(few.mapInArrow(_compare(distance, segments), "a long, b long"), "simhash_links"))
        many = met.filter(F.col("n") > limit).drop("n")
        if many.isEmpty():
            break
        # Two keys can grow into the same longer one.
        rows = many.mapInArrow(_finer(distance), "start int, mask long, value long, fingerprint long, rep long").distinct()
    edges = found[0]
    for more in found[1:]:
        edges = edges.union(more)
    return edges


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    Args: ``docs`` with integer ``doc_id`` and ``text``; other columns are not read. ``fingerprint`` is 16
    lowercase hex digits. ``component_id`` is the least id reached by links of ``distance`` or fewer
    differing bits; equal fingerprints are linked. Texts that are null, empty or without words have the
    fingerprint zero and link like any other. Rows that repeat an id share what either is linked with.
    A row without an id takes no part: its component is null. An empty table gives an empty table.
    ``limit`` is the size of a bucket beyond which it is dealt again; it changes no result.
    """
    small_batches(docs.sparkSession)
    prints = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_prints, "doc_id long, fingerprint long")
    prints = stored(prints, "simhash_prints")
    known = prints.filter("doc_id is not null")
    reps = stored(known.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "simhash_reps")
    edges = links(reps, distance, segments, limit)
    # Rows of one id and different texts connect what their fingerprints are linked with.
    repeated = known.groupBy("doc_id").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).filter("low < high")
    several = known.join(repeated.select("doc_id"), "doc_id").join(reps, "fingerprint").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    named = components(edges.union(several), "simhash_components")
    classes = reps.join(named.withColumnRenamed("id", "rep"), "rep", "left")
    classes = stored(classes.select("fingerprint", F.coalesce("component", "rep").alias("component")), "simhash_classes")
    out = prints.join(classes, "fingerprint", "left")
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )
