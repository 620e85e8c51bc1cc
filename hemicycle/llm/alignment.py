"""Cross-tokenizer alignment with an identity map as the fast path.

A text is cut into units before single blanks between visible characters. Neither tokenizer has tokens
across such a place, so a unit is aligned on its own, and a worker keeps what it has aligned. Byte offsets
at which tokens of both end cut a text into groups; the last tokens of a group end together and make a link.

A link of tokens with the same bytes is a group of one token each. The identity map gives the B id that
has the bytes of an A id, so a task counts such links in a vector as long as the vocabulary. Only links of
irregular groups are counted by pair through a shuffle. When the counts go back to the documents, the
vector, the highest count of each B id and the most frequent pairs are sent to every task (their sizes
are those of the vocabularies and ``FREQUENT``); what is left joins the pair counts, and is never hot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import small_batches
from hemicycle.session import stored

#: Irregular pairs whose counts are sent to every task.
FREQUENT = 1 << 16
#: Units that a worker keeps aligned (and as many older ones), and the letters of a unit that it keeps.
KEPT_UNITS, LONGEST = 120_000, 64
#: Units that are given to the tokenizers at a time.
BATCH = 20_000
#: Entries of a piece of the vector of one-to-one counts, and pairs that a task counts at a time.
PIECE, PAIRS = 1 << 12, 1 << 20
#: Before a blank that stands alone between characters that are no white space in any tokenizer.
CUT = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")
#: Units of visible ASCII and Latin letters, which every version of the letter classes cuts in the same way.
SAFE = re.compile(r" [!-~À-ÖØ-öø-ɏ]+")
# Fixed value: the pattern that a byte-level vocabulary cuts text by before its merges.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if visible, else the next free one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def quick_encoder(path: str, raw: list[bytes]) -> tiktoken.Encoding | None:
    """A faster encoder of the same vocabulary for :data:`SAFE` units, if its ids are in the order of its merges."""
    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    letters = byte_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    made = [bytes(letters[c] for c in left + right) for left, right in pairs]
    ranks = {x: i for i, x in enumerate(raw) if x}
    order = [ranks[x] for x in made]
    single = all(bytes([b]) in ranks and ranks[bytes([b])] < order[0] for b in range(256))
    if not single or order != sorted(set(order)) or len(ranks) != 256 + len(order):
        return None
    return tiktoken.Encoding("quick", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


class Vocabularies:
    """Both tokenizers, the bytes of every id, and the B id with the bytes of each A id (-1: none)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.quick = quick_encoder(path_a, self.bytes_a)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces of this model reach across blanks")
        of_byte = [self.b.is_byte(i) for i in range(len(pieces))]
        plain = [not self.b.is_control(i) and not self.b.is_unknown(i) for i in range(len(pieces))]
        self.bytes_b = [
            bytes([int(_BYTE_PIECE.fullmatch(p)[1], 16)]) if byte else p.replace("▁", " ").encode() if text else b""
            for p, byte, text in zip(pieces, of_byte, plain, strict=True)
        ]
        # A piece of text goes before a byte piece with the same byte.
        known = {raw: i for i, raw in enumerate(self.bytes_b) if of_byte[i]}
        known |= {raw: i for i, raw in enumerate(self.bytes_b) if raw and not of_byte[i]}
        self.same = np.array([known.get(raw, -1) if raw else -1 for raw in self.bytes_a], np.int64)

    def exact(self, links: np.ndarray) -> np.ndarray:
        """Whether links are those of one A and one B token with the same bytes."""
        return self.same[links // len(self.bytes_b)] == links % len(self.bytes_b)


class Aligner(dict):
    """``(n_a, n_b, groups, links)`` of a unit, None where tokens do not give its bytes; short units are kept."""

    def __init__(self, vocabularies: Vocabularies):
        super().__init__()
        self.of = of = vocabularies
        self.older: dict = {}
        self.size_b = len(of.bytes_b)
        self.shown_a, self.shown_b = (list(map(str, range(len(x)))) for x in (of.bytes_a, of.bytes_b))
        # The group and the link of an A id with the B id that has its bytes.
        self.same = of.same.tolist()
        self.pair = [f"{a}|{b}" for a, b in enumerate(self.same)]
        self.link = [a * self.size_b + b for a, b in enumerate(self.same)]

    def learn(self, units: list[str]) -> dict:
        """Aligns the units that are not kept yet; gives those of them that are too long to be kept.

        When the cache is full its entries become the older half, from which those that are met go on.
        """
        new = list({u for u in units if u not in self})
        if self.older:
            self.update((u, self.older[u]) for u in new if u in self.older)
            new = [u for u in new if u not in self]
        if len(self) + len(new) > KEPT_UNITS:
            self.older = dict(self)
            self.clear()
            self.update((u, self.older[u]) for u in units if u in self.older)
        long = {}
        for i in range(0, len(new), BATCH):
            part = new[i : i + BATCH]
            b = self.of.b.encode([u[1:] for u in part], num_threads=1)  # the library puts the blank back
            for unit, ids_a, ids_b in zip(part, self.encode(part), b, strict=True):
                (self if len(unit) <= LONGEST else long)[unit] = self.aligned(unit, ids_a, ids_b)
        return long

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids by A."""
        if self.of.quick is None:
            return [e.ids for e in self.of.a.encode_batch_fast(units, add_special_tokens=False)]
        quick = self.of.quick.encode_ordinary
        found = [quick(u) if len(u) <= LONGEST and SAFE.fullmatch(u) else None for u in units]
        slow = [i for i, ids in enumerate(found) if ids is None]
        for i, e in zip(slow, self.of.a.encode_batch_fast([units[i] for i in slow], add_special_tokens=False), strict=True):
            found[i] = e.ids
        return found

    def aligned(self, unit: str, a: list[int], b: list[int]) -> tuple[int, int, str, tuple[int, ...]] | None:
        """Groups as text, and of each group the link of its last tokens, as A id * size of B + B id."""
        raw_a = [self.of.bytes_a[i] for i in a]
        raw = unit.encode()
        if b"".join(raw_a) != raw:
            return None
        if [self.same[i] for i in a] == b:
            return len(a), len(b), ";".join([self.pair[i] for i in a]), tuple([self.link[i] for i in a])
        raw_b = [self.of.bytes_b[i] for i in b]
        if b"".join(raw_b) != raw:
            return None
        if len(a) == 1 or len(b) == 1:  # one group
            groups = ",".join([self.shown_a[x] for x in a]) + "|" + ",".join([self.shown_b[x] for x in b])
            return len(a), len(b), groups, (a[-1] * self.size_b + b[-1],)
        after_b = dict(zip(accumulate(map(len, raw_b)), range(1, len(b) + 1), strict=True))
        groups, links, i, j = [], [], 0, 0
        for next_a, end in enumerate(accumulate(map(len, raw_a)), 1):
            if end in after_b:
                next_b = after_b[end]
                groups.append(",".join([self.shown_a[x] for x in a[i:next_a]]) + "|" + ",".join([self.shown_b[x] for x in b[j:next_b]]))
                links.append(a[next_a - 1] * self.size_b + b[next_b - 1])
                i, j = next_a, next_b
        return len(a), len(b), ";".join(groups), tuple(links)

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, int, str, list[int]]]:
        """Tokens of A and of B, the digest of the groups, and all links; none where the tokens do not give the bytes."""
        cut = [CUT.split(" " + t) if t else [] for t in texts]
        # Units of few texts at a time, so that what is learnt stays within what is kept.
        for part in steps(list(map(len, cut))):
            long = self.learn(list(chain.from_iterable(cut[part])))
            get = (lambda u: self[u] if u in self else long[u]) if long else self.__getitem__
            for units, text in zip(cut[part], texts[part], strict=True):
                found = list(map(get, units))
                if None in found:
                    found = [self.learn_whole(text)]
                if not found or found[0] is None:
                    yield 0, 0, "", []
                    continue
                groups = ";".join([v[2] for v in found]).encode()
                links = list(chain.from_iterable([v[3] for v in found]))
                yield sum([v[0] for v in found]), sum([v[1] for v in found]), hashlib.sha256(groups).hexdigest(), links

    def learn_whole(self, text: str):
        """A text whose tokens do not give the bytes of some unit, as one unit."""
        return self.aligned(" " + text, self.of.a.encode(" " + text, add_special_tokens=False).ids, self.of.b.encode(text))


def steps(units: list[int]) -> Iterator[slice]:
    """Slices of the texts with about ``BATCH`` units each."""
    start = held = 0
    for i, n in enumerate(units):
        if held and held + n > BATCH:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(units):
        yield slice(start, len(units))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(Vocabularies(path_a, path_b))
    return _ALIGNERS[path_a, path_b]


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values))


def _align(path_a: str, path_b: str):
    """Of every document its token counts, digest, distinct links and how often it has each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        for batch in batches:
            n_a, n_b, digests, links, times = [], [], [], [], []
            for a, b, digest, found in align.documents(batch.column("text").to_pylist()):
                distinct, n = np.unique(np.array(found, np.int64), return_counts=True)
                n_a.append(a)
                n_b.append(b)
                digests.append(digest)
                links.append(distinct)
                times.append(n)
            lengths = np.array([len(x) for x in links], np.int64)
            flat, count = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (links, times))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(digests, pa.string()), _lists(flat, lengths), _lists(count, lengths)],
                ["doc_id", "n_a", "n_b", "groups_sha256", "links", "times"],
            )

    return run


def _flat(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    """The values of list columns one after the other; then the length of each list."""
    columns = [batch.column(c) for c in names]
    return [c.flatten().to_numpy() for c in columns] + [np.diff(columns[0].offsets.to_numpy())]


def _count(path_a: str, path_b: str):
    """A task's one-to-one counts in pieces of a vector (``piece, counts``), and its irregular pairs (``link, n``)."""

    def pairs(links: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, place = np.unique(links, return_inverse=True)
        n = np.zeros(len(distinct), np.int64)
        np.add.at(n, place, times)
        return distinct, n

    def row(piece, counts, links, n) -> pa.RecordBatch:
        size = len(piece) + len(links)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*piece, *[None] * len(links)], pa.int32()), pa.array([*counts, *[None] * len(links)], pa.list_(pa.int64())),
                pa.concat_arrays([pa.nulls(len(piece), pa.int64()), pa.array(links, pa.int64())]),
                pa.concat_arrays([pa.nulls(len(piece), pa.int64()), pa.array(n, pa.int64())]),
            ],
            ["piece", "counts", "link", "n"],
        ).slice(0, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = aligner(path_a, path_b).of
        vector = np.zeros(len(of.bytes_a), np.int64)
        held = (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            links, times, _ = _flat(batch, "links", "times")
            exact = of.exact(links)
            np.add.at(vector, links[exact] // len(of.bytes_b), times[exact])
            held = pairs(*(np.concatenate(x) for x in zip(held, (links[~exact], times[~exact]), strict=True)))
            if len(held[0]) > PAIRS:
                yield row([], [], *held)
                held = (held[0][:0], held[1][:0])
        pieces = [vector[i : i + PIECE] for i in range(0, len(vector), PIECE)]
        yield row(range(len(pieces)), [p.tolist() for p in pieces], *held)

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the pieces of the vector that come to this task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch.column("piece").to_pylist(), batch.column("counts"), strict=True):
            values = counts.values.to_numpy()
            total[piece] = total[piece] + values if piece in total else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], ["piece", "counts"]
    )


def _look_up(path_a: str, path_b: str, shared):
    """Sums over the links whose counts every task has; the others with the highest count of their B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = aligner(path_a, path_b).of
        vector, best, frequent, frequent_n = shared.value
        for batch in batches:
            links, times, lengths = _flat(batch, "links", "times")
            a, b = links // len(of.bytes_b), links % len(of.bytes_b)
            exact = of.exact(links)
            count = np.where(exact, vector[a], 0)
            place = np.minimum(np.searchsorted(frequent, links), max(len(frequent) - 1, 0))
            listed = ~exact & (frequent[place] == links) if len(frequent) else np.zeros(len(links), bool)
            count[listed] = frequent_n[place[listed]]
            known = exact | listed
            ends = np.cumsum(lengths)

            def by_document(values: np.ndarray) -> np.ndarray:
                upto = np.concatenate([[0], np.cumsum(values)])
                return upto[ends] - upto[ends - lengths]

            rest = ~known
            rest_lengths = by_document(rest.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), pa.array(by_document(times)), pa.array(by_document(times * (known & (count == best[b])))),
                    pa.array(by_document(times * count)), _lists(links[rest], rest_lengths), _lists(times[rest], rest_lengths),
                    _lists(best[b[rest]], rest_lengths),
                ],
                ["key", "n_links", "n_best", "count_sum", "rest", "rest_times", "rest_best"],
            )

    return run


def aligned(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``docs``.

    Args: ``docs`` with ``doc_id`` and ``text``, other columns are not read; a byte-level .json (A) and a
    .model (B) that every executor has. Texts that are null, empty, or whose tokens do not give back the
    bytes of a blank and the text have no tokens: zeros and an empty digest. Rows that repeat an id or a
    text are rows of their own and count each. A null id is an id like any other. An empty table gives an
    empty table. ``frequent`` bounds the pairs sent to every task and changes no result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _align(path_a, path_b), "doc_id long, n_a long, n_b long, groups_sha256 string, links array<long>, times array<long>"
    )
    found = stored(found.withColumn("key", F.monotonically_increasing_id()), "alignment_documents")
    counted = found.select("links", "times").mapInArrow(_count(path_a, path_b), "piece int, counts array<long>, link long, n long")
    counted = stored(counted, "alignment_counted")
    size_a, size_b = (len(x) for x in (aligner(path_a, path_b).of.bytes_a, aligner(path_a, path_b).of.bytes_b))
    summed = counted.filter("piece is not null").select("piece", "counts").repartition("piece").mapInArrow(_add, "piece int, counts array<long>")
    vector = np.zeros(size_a, np.int64)
    for piece, counts in summed.collect():  # as long as the vocabulary
        vector[piece * PIECE : piece * PIECE + len(counts)] = counts
    pairs = stored(counted.filter("link is not null").groupBy("link").agg(F.sum("n").alias("n")), "alignment_pairs")
    best = np.zeros(size_b, np.int64)
    same = aligner(path_a, path_b).of.same
    np.maximum.at(best, same[same >= 0], vector[same >= 0])
    highest = pairs.groupBy(F.pmod("link", F.lit(size_b)).alias("b")).agg(F.max("n").alias("n"))
    for b, n in highest.collect():  # one row for each B id at most
        best[b] = max(best[b], n)
    top = sorted(map(tuple, pairs.orderBy(F.desc("n"), "link").limit(frequent).collect()))
    shared = spark.sparkContext.broadcast((vector, best, np.array([x for x, _ in top], np.int64), np.array([n for _, n in top], np.int64)))
    looked = found.select("key", "links", "times").mapInArrow(
        _look_up(path_a, path_b, shared),
        "key long, n_links long, n_best long, count_sum long, rest array<long>, rest_times array<long>, rest_best array<long>",
    )
    looked = stored(looked, "alignment_looked_up")
    rest = looked.select("key", F.explode(F.arrays_zip("rest", "rest_times", "rest_best")).alias("x"))
    rest = rest.select("key", F.col("x.rest").alias("link"), F.col("x.rest_times").alias("times"), F.col("x.rest_best").alias("best")).join(pairs, "link")
    rest = rest.groupBy("key").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    known = found.select("key", "doc_id", "n_a", "n_b", "groups_sha256").join(looked.select("key", "n_links", "n_best", "count_sum"), "key")
    out = known.join(rest, "key", "left")
    return out.select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
