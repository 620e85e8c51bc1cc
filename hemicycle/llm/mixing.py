"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Every document of a source has the same expected number of copies, target / size of the source. The
documents are put in the order of their size, the expected copies are summed up along that order
after one offset per source, and a document is taken once for each whole number it passes. As
neighbours in that order have nearly the same size, the words taken come within about one document
of the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hemicycle.llm.common import ranked
from hemicycle.session import stored

#: A word, and the weights that the sources take in turn.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Adds ``place``, ``target`` and ``offset`` to one row per source, ``source, docs, source_size``.

    All sizes are shared out by weight. No source gets more than ``most`` times its own size; the rest
    is shared again. So the target is weight * level up to that limit, and the sources stop in the
    order of limit / weight; the level is the first that lies under the next source's stop.
    """
    # One row per source: the windows over all rows see the sources only, not the documents.
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    place = F.row_number().over(by_name) - 1
    listed = sizes.withColumn("place", place).withColumn("limit", F.col("source_size") * most)
    listed = listed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    order = Window.orderBy((F.col("limit") / F.col("weight")).asc(), "place")
    gone = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - gone) / left
    listed = listed.withColumn("own", level).withColumn("under", F.col("own") * F.col("weight") <= F.col("limit"))
    listed = listed.withColumn("level", F.max(F.when(F.col("under"), F.col("own"))).over(every))
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    # A multiple of 2^-24, so that adding whole copies to it is exact.
    draw = F.conv(F.substring(F.md5(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), 1, 6), 16, 10).cast("long")
    return listed.select("source", "place", "docs", "source_size", target.alias("target"), (draw / F.lit(1 << 24)).alias("offset"))


def mixed_rows(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """How often the mix takes each document.

    Args: ``docs`` with ``doc_id``, ``text``, ``source``; ``carry`` names further columns to keep, packed
    by the caller. Returns ``doc_id, size, source_size, target, taken, copies`` and ``carry``, a row for
    each input row. A null text has no words. A null source is a source of its own, the last one. Equal
    sizes go by ``doc_id``, null first; rows alike in both take turns. An empty table gives an empty table.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry)
    sized = stored(sized, "mixing_sizes")
    totals = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    plan = targets(totals)
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    plan = stored(plan.withColumn("before", F.coalesce(F.sum("docs").over(before), F.lit(0))), "mixing_targets")
    placed = ranked(
        sized.withColumn("_last", F.col("source").isNull()), ["_last", "source", "size", "doc_id"], "mixing_order"
    ).drop("_last")
    names = plan.withColumnRenamed("source", "name")
    joined = placed.join(names, F.col("source").eqNullSafe(F.col("name")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = (F.col("rank") - F.col("before")).cast("double")
    copies = F.floor((at + 1) * rate + F.col("offset")) - F.floor(at * rate + F.col("offset"))
    out = joined.withColumn("copies", F.least(copies, F.lit(MOST_COPIES)).cast("long"))
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *carry
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it."""
    packed = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    taken = mixed_rows(packed, ["_doc"]).filter("copies > 0")
    return taken.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "_doc").select("_doc.*")


#: The same rows for DuckDB.
MIXED_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (
  SELECT source, count(*) AS docs, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS BIGINT) AS place
  FROM sized GROUP BY source),
caps AS (SELECT *, 3 * source_size AS most, place % 3 + 1 AS weight FROM totals),
tried AS (
  SELECT (SELECT sum(source_size) FROM caps)::DOUBLE AS total, a.place,
         (coalesce((SELECT sum(b.most) FROM caps b
                    WHERE (b.most::DOUBLE / b.weight, b.place) < (a.most::DOUBLE / a.weight, a.place)), 0))::DOUBLE AS gone,
         (SELECT sum(b.weight) FROM caps b
          WHERE (b.most::DOUBLE / b.weight, b.place) >= (a.most::DOUBLE / a.weight, a.place))::DOUBLE AS parts,
         a.most, a.weight
  FROM caps a),
level AS (SELECT max((total - gone) / parts) AS height FROM tried WHERE (total - gone) / parts * weight <= most),
goal AS (
  SELECT source, source_size, least(most::DOUBLE, coalesce(height * weight, 0.0)) AS target,
         ('0x' || md5(coalesce('s' || source, 'n'))[1:6])::BIGINT / 16777216.0::DOUBLE AS shift
  FROM caps, level),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1)::DOUBLE AS pos FROM sized)
SELECT p.doc_id, p.size, g.source_size, g.target,
       CAST(p.size * least(3, CASE WHEN g.source_size > 0 THEN
         floor((pos + 1) * (target / g.source_size) + shift) - floor(pos * (target / g.source_size) + shift) ELSE 0 END)
         AS BIGINT) AS taken
FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source
"""
