"""MinHash fingerprints of documents.

A fingerprint has the least value of the shingles of a text, runs of nine bytes, under each of 64
universal hash permutations, computed in numpy. The share of equal places of two fingerprints
estimates the Jaccard similarity of the shingle sets. Bands of a longer signature find alike documents
by a join, and the full sets confirm them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm import minhash
from hemicycle.llm.common import as_bytes, components, rolling, small_batches
from hemicycle.session import stored

SHINGLE = 9
PERMUTATIONS = 64
#: Bands of four values, least and greatest ones, that find alike texts.
BANDS = 40
ROWS = 4
PERCENT = 75
#: Ranges of document ids; a range is read as a stream, so its length costs no memory.
RANGES = 1024

_DRAW = np.random.default_rng(20_240_502)
_FACTORS = (_DRAW.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADDED = _DRAW.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)[:, None]
_STEP = 2048
_EMPTY = np.iinfo(np.uint32).max


def shingles(text: bytes) -> np.ndarray:
    """64-bit hashes of all runs of nine bytes, with repeats; a shorter text is one shingle, an empty one none."""
    if not text:
        return np.empty(0, np.uint64)
    size = min(SHINGLE, len(text))
    return rolling(np.frombuffer(text, np.uint8).astype(np.uint64), size, seed=21 + size)


def signature(text: bytes) -> np.ndarray:
    """Least value under each permutation; all ones for an empty text."""
    low = np.full(PERMUTATIONS, _EMPTY, np.uint32)
    for start in range(0, len(text), 1 << 20):  # long texts a piece at a time; pieces overlap by a shingle
        x = (shingles(text[start : start + (1 << 20) + SHINGLE - 1]) >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(x), _STEP):
            np.minimum(low, (x[None, i : i + _STEP] * _FACTORS + _ADDED).min(axis=1), out=low)
        if start + (1 << 20) + SHINGLE - 1 >= len(text):
            break
    return low


def shown(found: np.ndarray) -> str:
    """A fingerprint as text: four hexadecimal digits for each permutation."""
    return found.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal places, 0 to 1, of what :func:`shown` shows."""
    return float((a.astype(np.uint16) == b.astype(np.uint16)).mean())


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, guests last: every row that is no guest is compared with the row after it."""
    held = None
    for batch in batches:
        out: dict[str, list] = {c.split()[0]: [] for c in _SCHEMA.split(", ")}
        columns = (batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))
        for part, guest, doc_id, text in zip(*columns, strict=True):
            text = text or ""
            if guest and (held is None or held[1] or held[0] != part):
                held = (part, True, None, "", None)  # a second guest: nothing waits for it
                continue
            mine = signature(text.encode())
            if held and held[0] == part and not held[1]:
                _, _, before, body, sign = held
                half = len(body) // 2
                edited = (body[: len(body) - half] + text[:half]).encode()
                other = signature(edited)
                row = (before, len(body), hashlib.sha256(edited).hexdigest(), shown(sign), shown(other), likeness(sign, other), likeness(sign, mine))
                for values, value in zip(out.values(), row, strict=True):
                    values.append(value)
            held = (part, bool(guest), doc_id, text, mine)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


def edited_fingerprints(docs: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Fingerprints of every text and of its edited text, in which the next text's start replaces the second half.

    Args: ``docs`` with integer ``doc_id`` and ``text``. The next document is that of the next larger id,
    after the last one the first; rows of one id go by text, and a null id is the smallest. Null texts
    count as empty; a single document is its own next. Texts move once, by range of the ids; the first
    document of a range also goes to the range before. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ids = docs.select(at.alias("at"))
    cuts = np.unique(np.array(ids.approxQuantile("at", [i / ranges for i in range(1, ranges)], 0.25 / ranges), np.float64))
    cuts = np.clip(cuts, -(2.0**63), 2.0**63 - 1024).astype(np.int64)

    @F.arrow_udf("int")
    def range_of(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, values.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    # One row for each range comes to the driver.
    firsts = sorted(tuple(r) for r in ids.groupBy(range_of("at").alias("range")).agg(F.min("at").alias("at")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    @F.arrow_udf("int")
    def guest_of(values: pa.Array) -> pa.Array:
        return pa.array([before.get(v) for v in values.to_pylist()], pa.int32())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", at.alias("at"))
    rows = rows.withColumn("places", F.array(range_of("at"), guest_of("at")))
    rows = rows.select("doc_id", "text", "at", F.posexplode("places").alias("guest", "range")).filter("range is not null")
    order = ["range", "guest", "at", "text"]
    dealt = rows.repartition("range").sortWithinPartitions(*order)
    return dealt.select("range", "guest", "doc_id", "text").mapInArrow(_compare, _SCHEMA)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors, masks = minhash.permutations(BANDS * ROWS // 2)
    for batch in batches:
        signs = (minhash.min_max_signature(np.unique(shingles(t)), factors, masks) for t in as_bytes(batch.column("text")))
        keys = [minhash.band_hashes(sign, BANDS, ROWS).view(np.int64) for sign in signs]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.list_(pa.int64()))], ["id", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(shingles(t)).view(np.int64) for t in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.int64()))], ["id", "shingles"])


def _jaccard(percent: int):
    @F.arrow_udf("boolean")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(as_bytes(a), as_bytes(b), strict=True):
            x, y = np.unique(shingles(x)), np.unique(shingles(y))
            common = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    return run


def alike(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, class_id``: the least id that links reach; texts of ``percent`` Jaccard similarity are linked.

    Texts that share a band are candidates: each is compared with its bucket's first one, and what a
    bucket leaves in different components is compared in blocks, so no link within the buckets is lost.
    A pair at exactly 0.75 shares no band with probability 2.5e-7. Equal texts are one; rows of one id
    are one document. Empty texts and null ids are alone.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text <> ''")
    rows = rows.withColumn("key", F.sha2("text", 256))
    keys = stored(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id")), "fingerprint_keys")
    # Written, as the numbers of a repeated run could be others.
    ids = stored(keys.withColumn("id", F.monotonically_increasing_id()), "fingerprint_ids")
    members = stored(rows.select("doc_id", "key").join(ids.select("key", "id"), "key").select("doc_id", "id").distinct(), "fingerprint_members")
    texts = stored(rows.join(ids, ["key", "doc_id"]).dropDuplicates(["id"]).select("id", "text"), "fingerprint_texts")
    bands = texts.mapInArrow(_banded, "id long, bands array<long>").select("id", F.explode("bands").alias("band"))
    bands = stored(bands, "fingerprint_bands")
    firsts = stored(bands.groupBy("band").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "fingerprint_buckets")
    shared = stored(bands.join(firsts, "band").select("band", "id", "first"), "fingerprint_shared")
    pairs = shared.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    pairs = stored(pairs, "fingerprint_pairs")
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("of_b")), "b")
    both = both.join(texts.select(F.col("id").alias("a"), F.col("text").alias("of_a")), "a")
    edges = both.filter(_jaccard(percent)("of_a", "of_b")).select("a", "b")
    same = members.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("high")).filter("a < high")
    edges = stored(edges.union(members.join(same, "doc_id").filter("id <> a").select("a", F.col("id").alias("b"))), "fingerprint_links")
    named = components(edges, "fingerprint_classes")
    apart = stored(minhash.apart_in_buckets(shared.select("band", F.col("id").alias("rep")), named), "fingerprint_apart")
    if not apart.isEmpty():
        sets = stored(texts.join(apart.select("id"), "id", "left_semi").mapInArrow(_sets, "id long, shingles array<long>"), "fingerprint_sets")
        found = minhash.block_links(sets, apart, minhash.rare_shingles(sets, apart, percent), percent)
        named = components(edges.union(found), "fingerprint_classes")
    placed = stored(members.join(named, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component")).distinct(), "fingerprint_placed")
    least = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    classes = placed.join(least, "component").select("doc_id", "class_id")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(classes, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )
