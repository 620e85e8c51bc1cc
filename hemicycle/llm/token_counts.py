"""Token counts by a two-tier lookup in the map task; no pre-token is shuffled to be encoded.

A pre-token is a piece of text that the tokenizer never joins with its neighbours. The first tier is a
table of the lengths of the most frequent pre-tokens, counted over all documents and sent to every
task; its size is fixed. What it does not have goes through a cache of the worker, and on a miss to
the tokenizer itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import CACHE_ENTRIES, as_bytes, small_batches

LIMIT = 4096
#: Entries of the broadcast table, and of what each task proposes for it.
FREQUENT, PROPOSED = 32_768, 16_384
#: Letters of a pre-token that the table or a cache may hold: bounds both where texts have no blanks.
LONGEST = 64
#: A line break and what follows it without a blank; blanks and what follows them; blanks alone.
PRE_TOKEN = re.compile(r"\n[^ \n]*| *[^ \n]+| +")

_PROCESSORS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The tokenizer of a .model file, checked once for the pre-tokens to be independent."""
    if path not in _PROCESSORS:
        found = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [found.id_to_piece(i) for i in range(found.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces) or found.encode("  a", out_type=str)[0] == "▁a":
            raise ValueError("pieces of this model reach across pre-tokens")
        _PROCESSORS[path] = found
    return _PROCESSORS[path]


def pre_tokens(text: str) -> list[str]:
    """The text with the leading blank that the tokenizer adds, cut into pre-tokens."""
    return PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


class Lengths(dict):
    """Tokens of a pre-token: frequent ones always, others until the cache is full."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.encode = processor(path).encode
        self.frequent = frequent

    def __missing__(self, unit: str) -> int:
        if len(self) >= CACHE_ENTRIES + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        # The tokenizer puts a blank before its input: it stands for the first blank of the unit, or
        # is one token of its own before a line break.
        if unit == " ":
            value = 1  # a blank alone; the library gives nothing for an empty text
        else:
            value = len(self.encode(unit[1:])) if unit[0] == " " else len(self.encode(unit)) - 1
        if len(unit) <= LONGEST:
            self[unit] = value
        return value


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(u for u in pre_tokens(text or "") if len(u) <= LONGEST)
        if len(seen) > CACHE_ENTRIES:
            seen = Counter(dict(seen.most_common(CACHE_ENTRIES // 4)))
    top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:PROPOSED]
    yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["unit", "n"])


def frequent_lengths(docs: DataFrame, path: str) -> tuple[str, np.ndarray]:
    """The most frequent pre-tokens, joined by a zero character, and their token counts.

    At most ``FREQUENT`` of at most ``LONGEST`` letters, that is 8 MB of UTF-8 at most, whatever the input.
    """
    proposed = docs.select("text").mapInArrow(_propose, "unit string, n long")
    top = proposed.filter("instr(unit, char(0)) = 0").groupBy("unit").agg(F.sum("n").alias("n"))
    units = [r[0] for r in top.orderBy(F.desc("n"), "unit").limit(FREQUENT).select("unit").collect()]
    lengths = Lengths(path, {})
    return "\0".join(units), np.array([lengths[u] for u in units], np.int32)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs`` (``doc_id``, ``text``).

    ``path`` names a .model file that every executor has. Counts are those of the library on whole
    texts, without special tokens. Null and empty texts have none. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    units, lengths = frequent_lengths(docs, path)
    table = docs.sparkSession.sparkContext.broadcast((units, lengths))
    held: list[Lengths] = []

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        if not held:
            names, counts = table.value
            held.append(Lengths(path, dict(zip(names.split("\0"), counts.tolist(), strict=True)) if names else {}))
        get = held[0].__getitem__
        return pa.array([sum(map(get, pre_tokens(t or ""))) for t in texts.to_pylist()], pa.int64())

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    out = docs.select("doc_id", size.alias("n_bytes"), tokens("text").alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
