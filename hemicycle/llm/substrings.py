"""Substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words. Its minimiser is the least hash among the ``m``-word runs in
it. Consecutive windows that share their minimiser form a super-k-mer. Equal windows have equal
minimisers, so a window whose minimiser occurs once in the corpus is unique and never travels:

1. every super-k-mer sends only its minimiser; those that occur again are found by a count that
   combines in the map task;
2. the super-k-mers with such a minimiser travel as one packed string of word hashes. Equal ones become
   one row with a multiplicity, so a passage that many documents share is counted once;
3. in the bucket of the minimiser the windows of the distinct super-k-mers are sorted and counted by
   their multiplicities;
4. a minimiser with more than ``LIMIT`` distinct super-k-mers would fill a task. They are cut again by
   a second minimiser of longer runs and another seed, and the shorter pieces are counted in the same
   way. The runs grow with every turn up to whole windows, when a bucket is a single window;
5. the runs of repeated windows go back to the super-k-mers by their digest, and to the documents, whose
   covered words are left out.

Words are compared by 64-bit hashes, windows and super-k-mers by two 64-bit hashes of those, rows by two
64-bit hashes of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import WordHashes, as_bytes, mixed, rolling, small_batches, steps, word_hashes
from hemicycle.session import stored

WINDOW = 35
MINIMISER = 8
#: Windows of a super-k-mer at most; a longer run of equal minimisers is cut, nothing is lost.
RUN = 256
#: Distinct super-k-mers of a minimiser that one bucket takes.
LIMIT = 2048

_CACHE = WordHashes()


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of every ``w`` consecutive values."""
    size, low = 1, x
    while size * 2 <= w:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    n = len(x) - w + 1
    return np.minimum(low[:n], low[w - size : w - size + n])


def super_kmers(words: np.ndarray, counts: np.ndarray, k: int = WINDOW, m: int = MINIMISER, seed: int = 3):
    """Row, first word in the row, windows, and minimiser of each super-k-mer; and the first word overall.

    The texts lie one after the other in ``words``; no window crosses from one to the next.
    """
    none = np.empty(0, np.int64)
    if len(words) < k:
        return none, none, none, none.astype(np.uint64), none
    row = np.repeat(np.arange(len(counts)), counts)
    low = sliding_min(rolling(words, m, seed), k - m + 1)
    at = np.flatnonzero(row[: len(low)] == row[k - 1 :])
    if not len(at):
        return none, none, none, none.astype(np.uint64), none
    value = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    if length.max() > RUN:
        pieces = -(-length // RUN)
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + inner * RUN
        length = np.diff(np.append(first, len(at)))
    begin = at[first]
    starts = np.cumsum(counts) - counts
    return row[begin], begin - starts[row[begin]], length, value[first], begin


def _spans(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the spans one after the other, and where each span begins among them."""
    heads = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(begin - heads, length), heads


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in as_bytes(batch.column("text"))]


def _packed(words: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[list[bytes], pa.Array, pa.Array]:
    """The words of the spans as bytes, and the two halves of their digests."""
    places, heads = _spans(begin, size)
    raw, ends = words[places].tobytes(), (8 * np.append(heads, int(size.sum()))).tolist()
    strings = [raw[i:j] for i, j in zip(ends, ends[1:], strict=False)]
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), np.int64).reshape(-1, 2)
    return strings, pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1]))


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _announce(k: int, m: int):
    """Of every super-k-mer: document key, first word, minimiser, and whether it may repeat inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, (keys, also) = _texts(batch), _numbers(batch, "key", "also")
            for part in steps(texts):
                words, counts = word_hashes(texts[part], _CACHE)
                row, start, length, value, begin = super_kmers(words, counts, k, m)
                if not len(row):
                    continue
                runs = rolling(words, m, seed=3)
                places, heads = _spans(begin, length + (k - m))
                same = np.add.reduceat(runs[places] == np.repeat(value, length + (k - m)), heads)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value.view(np.int64)), pa.array(keys[part][row]), pa.array(also[part][row]),
                        pa.array(start.astype(np.int32)), pa.array(np.minimum(same, 2).astype(np.int32)),
                    ],
                    ["minimiser", "key", "also", "start", "weight"],
                )

    return run


def _pack(k: int, m: int):
    """The announced super-k-mers that travel, with their digests and packed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, (keys, also) = _texts(batch), _numbers(batch, "key", "also")
            wanted = batch.column("starts")
            ends = wanted.offsets.to_numpy()
            asked = wanted.values.to_numpy(zero_copy_only=False)
            for part in steps(texts):
                words, counts = word_hashes(texts[part], _CACHE)
                row, start, length, value, begin = super_kmers(words, counts, k, m)
                owner = np.repeat(np.arange(len(counts)), np.diff(ends[part.start : part.stop + 1]))
                marks = owner * (1 << 40) + asked[ends[part.start] : ends[part.stop]]
                at = np.flatnonzero(np.isin(row * (1 << 40) + start, marks))
                if not len(at):
                    continue
                strings, one, two = _packed(words, begin[at], length[at] + (k - 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value[at].view(np.int64)), one, two, pa.array(keys[part][row[at]]), pa.array(also[part][row[at]]),
                        pa.array(start[at].astype(np.int32)), pa.array(strings, pa.binary()),
                    ],
                    ["minimiser", "one", "two", "key", "also", "start", "words"],
                )

    return run


def _recut(k: int, m: int):
    """Crowded super-k-mers cut by longer runs: pieces with where they lie in the whole and its multiplicity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column("words").to_pylist()
            if not strings:
                continue
            words = np.frombuffer(b"".join(strings), np.uint64)
            counts = np.array([len(x) // 8 for x in strings])
            minimiser, one, two, n = _numbers(batch, "minimiser", "one", "two", "n")
            row, start, length, value, begin = super_kmers(words, counts, k, m, seed=3 + m)
            # The new value goes on top of the old one: equal windows have both in common.
            value = mixed(value ^ mixed(minimiser.view(np.uint64))[row])
            pieces, piece_one, piece_two = _packed(words, begin, length + (k - 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value.view(np.int64)), piece_one, piece_two, pa.array(one[row]), pa.array(two[row]),
                    pa.array(start.astype(np.int32)), pa.array(n[row]), pa.array(pieces, pa.binary()),
                ],
                ["minimiser", "one", "two", "whole_one", "whole_two", "start", "n", "words"],
            )

    return run


def _count(k: int):
    """Sorts the windows of each minimiser and gives the runs of those that occur more than once, by super-k-mer.

    The rows come sorted by minimiser; those of the last one in a batch wait for the next batch.
    """

    def counted(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        words = np.frombuffer(b"".join(r[4] for r in rows), np.uint64)
        counts = np.array([len(r[4]) // 8 for r in rows])
        windows = counts - (k - 1)
        places, _ = _spans(np.cumsum(counts) - counts, windows)
        one, two = rolling(words, k, seed=5)[places], rolling(words, k, seed=7)[places]
        owner = np.repeat(np.arange(len(rows)), windows)
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        times = np.add.reduceat(np.array([r[3] for r in rows])[owner[order]], np.flatnonzero(new))
        again = np.zeros(len(a), bool)
        again[order] = (times > 1)[np.cumsum(new) - 1]
        start = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = np.flatnonzero(again)
        first = at[np.append(True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]]))] if len(at) else at
        size = np.diff(np.append(np.searchsorted(at, first), len(at)))
        held, heads, n_runs = np.unique(owner[first], return_index=True, return_counts=True)
        ends = pa.array(np.append(heads, len(first)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][1] for i in held], pa.int64()), pa.array([rows[i][2] for i in held], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(start[first].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(size.astype(np.int32))),
            ],
            ["one", "two", "firsts", "sizes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, int, int, bytes]] = []
        for batch in batches:
            rows = waiting + list(zip(*(batch.column(c).to_pylist() for c in ("minimiser", "one", "two", "n", "words")), strict=True))
            cut = len(rows)
            while cut and rows[cut - 1][0] == rows[-1][0]:
                cut -= 1
            if cut:
                yield counted(rows[:cut])
            waiting = rows[cut:]
        if waiting:
            yield counted(waiting)

    return run


def ladder(k: int, m: int) -> list[int]:
    """Lengths of the runs whose least hash is the minimiser, halfway to whole windows each time: 8, 22, 29, 32, 34, 35."""
    lengths = [m]
    while lengths[-1] < k:
        lengths.append(-(-(lengths[-1] + k) // 2))
    return lengths


def _runs_of(cuts: DataFrame, lengths: list[int], k: int, limit: int) -> DataFrame:
    """Runs of repeated windows of each distinct super-k-mer: ``one, two, firsts, sizes``.

    ``cuts`` has ``minimiser, one, two, words`` and the multiplicity ``n``; ``lengths`` are the runs to come.
    """
    distinct = cuts.groupBy("minimiser", "one", "two").agg(F.sum("n").alias("n"), F.first("words").alias("words"))
    distinct = stored(distinct, "substring_distinct")
    crowds = stored(distinct.groupBy("minimiser").agg(F.count("*").alias("held")).filter(F.col("held") > limit).select("minimiser"), "substring_crowds")
    if not lengths or crowds.isEmpty():
        few, many = distinct, None
    else:
        few, many = distinct.join(crowds, "minimiser", "left_anti"), distinct.join(crowds, "minimiser", "left_semi")
    few = few.repartition("minimiser").sortWithinPartitions("minimiser")
    found = few.mapInArrow(_count(k), "one long, two long, firsts array<int>, sizes array<int>")
    if many is None:
        return found
    pieces = stored(
        many.mapInArrow(
            _recut(k, lengths[0]), "minimiser long, one long, two long, whole_one long, whole_two long, start int, n long, words binary"
        ),
        "substring_pieces",
    )
    inner = stored(_runs_of(pieces.select("minimiser", "one", "two", "n", "words"), lengths[1:], k, limit), "substring_inner")
    back = pieces.select("one", "two", "whole_one", "whole_two", "start").join(inner, ["one", "two"])
    moved = F.transform("firsts", lambda x: x + F.col("start"))
    back = back.groupBy(F.col("whole_one").alias("one"), F.col("whole_two").alias("two")).agg(
        F.flatten(F.collect_list(moved)).alias("firsts"), F.flatten(F.collect_list("sizes")).alias("sizes")
    )
    return found.union(back)


def repeated_runs(docs: DataFrame, k: int = WINDOW, m: int = MINIMISER, limit: int = LIMIT) -> DataFrame:
    """Runs of repeated windows by document: ``key, also, firsts, sizes``, arrays of first window and number of windows.

    ``docs`` has ``key`` and ``also`` (together the same for identical rows only) and ``text``.
    """
    row = ["key", "also"]
    announced = stored(
        docs.mapInArrow(_announce(k, m), "minimiser long, key long, also long, start int, weight int"), "substring_minimisers"
    )
    again = announced.groupBy("minimiser").agg(F.sum("weight").alias("weight"))
    again = stored(again.filter("weight > 1").select("minimiser"), "substring_repeated")
    asked = announced.select("minimiser", *row, "start").join(again, "minimiser")
    asked = asked.groupBy(*row).agg(F.collect_set("start").alias("starts"))
    packed = stored(
        docs.join(asked, row).select(*row, "text", "starts").mapInArrow(
            _pack(k, m), "minimiser long, one long, two long, key long, also long, start int, words binary"
        ),
        "substring_packed",
    )
    cuts = packed.select("minimiser", "one", "two", F.lit(1).cast("long").alias("n"), "words")
    runs = stored(_runs_of(cuts, ladder(k, m)[1:], k, limit), "substring_counted")
    back = packed.select("one", "two", *row, "start").join(runs, ["one", "two"])
    moved = F.transform("firsts", lambda x: x + F.col("start"))
    # Rows that repeat in whole give the same runs again.
    found = back.groupBy(*row).agg(F.collect_set(F.struct(moved.alias("firsts"), "sizes")).alias("runs"))
    return found.select(*row, F.flatten("runs.firsts").alias("firsts"), F.flatten("runs.sizes").alias("sizes"))


def _cut(k: int):
    """A column function: words, removed words, kept words joined by one space and their SHA-256."""
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("sha256", pa.string())])

    @F.arrow_udf("struct<n_words: long, n_removed: long, kept: string, sha256: string>")
    def cut(text: pa.Array, firsts: pa.Array, sizes: pa.Array) -> pa.Array:
        out = []
        for raw, first, size in zip(as_bytes(text), firsts.to_pylist(), sizes.to_pylist(), strict=True):
            words = (raw or b"").split()
            if first:
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, first, 1)
                np.add.at(edges, np.array(first) + np.array(size) + (k - 1), -1)
                keep = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
                left = [words[i] for i in keep.tolist()]
            else:
                left = words
            kept = b" ".join(left)
            out.append((len(words), len(words) - len(left), kept.decode(), hashlib.sha256(kept).hexdigest()))
        return pa.array([dict(zip(("n_words", "n_removed", "kept", "sha256"), x, strict=True)) for x in out], kind)

    return cut


def remove_repeats(docs: DataFrame, k: int = WINDOW, m: int = MINIMISER, limit: int = LIMIT) -> DataFrame:
    """Removes every word covered by a window of ``k`` words that also starts anywhere else.

    Args: ``docs`` with ``doc_id``, ``text`` and any other columns. Windows are judged on the input;
    repeats inside one document count.
    Returns one row per input row: ``doc`` (the whole row), ``n_words``, ``n_removed``, ``kept`` (kept
    words joined by one space) and ``sha256`` of it. A null or empty text has no words; a text of
    fewer than ``k`` words loses none. Repeated rows are repeats of each other. An empty table gives
    an empty table. Null ids are ids like any other. ``limit`` is the number of distinct super-k-mers of a
    minimiser beyond which they are cut again; it changes no result.
    """
    small_batches(docs.sparkSession)
    keyed = docs.select(
        F.xxhash64("doc_id", "text").alias("key"), F.xxhash64(F.lit(1), "doc_id", "text").alias("also"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    runs = repeated_runs(keyed.select("key", "also", F.col("doc.text").alias("text")), k, m, limit)
    joined = keyed.join(stored(runs, "substring_runs"), ["key", "also"], "left")
    cut = joined.select("doc", _cut(k)(F.col("doc.text"), "firsts", "sizes").alias("cut"))
    return cut.select("doc", "cut.*")
