"""Inverted index for searches inside short texts: which rows have which three letters in a row.

Postings are rows of (gram, key) in the order of the gram, so a lookup reads the few row groups that hold
its grams, however many texts there are, and a common gram is spread over files like any other rows. Every
letter of a text starts a gram; the last two are filled up, so terms of one or two letters are found as the
beginnings of grams. What the index finds is checked exactly, so grams only have to let nothing slip.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.operators.filters import search_text

GRAM = 3
#: Grams of a term that are looked up: the rarest ones.
LOOKED_UP = 3
#: Share of all texts beyond which a scan of the texts reads less than the postings and the texts do.
COMMON = 0.1
_FILL = "\0"


#: Letters and texts that are cut into grams at a time; a longer text is cut alone.
LETTERS_AT_A_TIME, TEXTS_AT_A_TIME = 1 << 20, 1024
#: Letters of texts whose grams are sorted by one task; there are no more grams than letters.
LETTERS_PER_TASK = 1 << 22


def gram_cutter() -> Callable[[Iterator], Iterator]:
    """The cutter of texts; a function of its own, so that workers get its code and need not import this module."""

    def grams_of(batches: Iterator) -> Iterator:
        """Arrow batches of (key, text) to batches of (key, gram): the distinct grams of each text, one from every letter on."""
        import numpy as np
        import pyarrow as pa

        def cut(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
            lengths = np.array([len(t) for t in texts])
            # The fill after each text ends its last grams.
            fill = _FILL * (GRAM - 1)
            letters = np.frombuffer((fill.join(texts) + fill).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
            text = np.repeat(np.arange(len(texts)), lengths)
            place = np.arange(len(text)) + text * (GRAM - 1)
            codes = letters[place]
            for n in range(1, GRAM):
                codes = codes << 21 | letters[place + n]
            found, which = np.unique(codes, return_inverse=True)
            has = np.zeros((len(texts), len(found)), dtype=bool)
            has[text, which] = True
            text, which = np.nonzero(has)
            names = pa.array(["".join(chr(int(code) >> 21 * n & 0x1FFFFF) for n in reversed(range(GRAM))) for code in found], pa.string())
            return pa.RecordBatch.from_arrays([keys.take(pa.array(text)), names.take(pa.array(which))], ["key", "gram"])

        for batch in batches:
            keys, texts, begin, letters = batch.column(0), batch.column(1).to_pylist(), 0, 0
            for n, text in enumerate(texts):
                if n > begin and (letters + len(text) > LETTERS_AT_A_TIME or n - begin >= TEXTS_AT_A_TIME):
                    yield cut(keys.slice(begin, n - begin), texts[begin:n])
                    begin, letters = n, 0
                letters += len(text)
            if begin < len(texts):
                yield cut(keys.slice(begin), texts[begin:])

    return grams_of


def build_index(rows: DataFrame, key: str, text: str, path: str) -> None:
    """Writes the index of ``text`` by ``key`` (rows that share a key are found together), replacing an older one."""
    spark = rows.sparkSession
    texts = rows.select(F.col(key).alias("key"), F.make_valid_utf8(F.lower(text)).alias("text")).filter("key is not null and text <> ''")
    keys = texts.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("letters"))
    repeated, letters = keys.agg(F.count_if(F.col("n") > 1), F.coalesce(F.sum("letters"), F.lit(0))).first()
    # Dealt before they grow, as a table may be one row group.
    dealt = texts.repartition("key", "text")
    schema = texts.select("key", F.lit("").alias("gram")).schema
    if repeated:
        # A text has each of its grams once; only rows that share a key can repeat one.
        keys.filter("n > 1").select("key").write.mode("overwrite").parquet(f"{path}/repeated")
        often = spark.read.parquet(f"{path}/repeated")
        once, more = (dealt.join(often, "key", how).mapInArrow(gram_cutter(), schema) for how in ("left_anti", "left_semi"))
        postings = once.unionByName(more.distinct())
    else:
        postings = dealt.mapInArrow(gram_cutter(), schema)
    ordered = postings.repartitionByRange(max(1, -(-letters // LETTERS_PER_TASK)), "gram", "key").sortWithinPartitions("gram", "key")
    ordered.write.mode("overwrite").parquet(f"{path}/postings")
    counts = spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("n"))
    # The empty gram stands for all keys.
    everything = rows.agg(F.lit("").alias("gram"), F.count_distinct(key).alias("n"))
    counts.unionByName(everything).repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/grams")


def lowered(spark: SparkSession, term: str) -> str:
    """The term as Spark lowers texts."""
    return spark.range(1).select(F.lower(F.lit(term))).first()[0]


def rarest_grams(spark: SparkSession, path: str, low: str) -> tuple[list[str], float] | None:
    """The grams to look up and the share of keys that have the rarest; None if some gram is nowhere."""
    wanted = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
    # A row for each gram of the term at most.
    counts = dict(spark.read.parquet(f"{path}/grams").filter(F.col("gram").isin([*wanted, ""])).collect())
    if any(g not in counts for g in wanted):
        return None
    chosen = sorted(wanted, key=lambda g: (counts[g], g))[:LOOKED_UP]
    return chosen, counts[chosen[0]] / max(counts[""], 1)


def keys_with(spark: SparkSession, path: str, grams: Sequence[str]) -> DataFrame:
    """Keys whose texts have all the grams."""
    found = spark.read.parquet(f"{path}/postings").filter(F.col("gram").isin(list(grams)))
    return found.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") == len(grams)).select("key")


def search_index(rows: DataFrame, key: str, text: str, term: str, path: str) -> DataFrame:
    """:func:`hemicycle.operators.filters.search_text` for a literal term, by the index of ``rows``.

    An empty term matches every text. A term whose rarest gram is in more than ``COMMON`` of all texts is
    looked for in the texts themselves; the rows are the same.
    """
    spark = rows.sparkSession
    low = lowered(spark, term)
    if not low:
        return search_text(rows, text, term)
    if len(low) < GRAM:
        found = spark.read.parquet(f"{path}/postings").filter(F.col("gram").startswith(low)).select("key").distinct()
    else:
        looked_up = rarest_grams(spark, path, low)
        if looked_up is None:
            return rows.filter(F.lit(False))
        grams, share = looked_up
        if share > COMMON:
            return search_text(rows, text, term)
        found = keys_with(spark, path, grams)
    return search_text(rows.join(found, rows[key] == found["key"], "left_semi"), text, term)
