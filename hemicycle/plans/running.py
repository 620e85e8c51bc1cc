"""Majorities and alignment that follow from run to run, without a pass over the fact.

Three signed, additive tables hold what the reports need: ballots per roll call, party and vote;
what each roll call stands for (majorities, policy area); and each member's sums. A run writes what it
adds to them as a batch of its own: a corrected ballot's old row is taken back and its new one added.
Only where a roll call's majority or policy area changes are its other ballots looked up in the fact,
and only in the congress folders that the run touches. Sums over all batches are the state.

A batch counts once its last table stands in its place, which one renaming does; what a run that died
left behind before that is not read and is written anew. The run's ballots are kept beside the batch until
the fact has them: the next run brings a fact that lags behind up to date first. So a run can be repeated
at any point, and one that has gone through changes nothing when it is repeated.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.functions.votes import PARTY_LETTERS, was_cast
from hemicycle.operators.filters import where_all
from hemicycle.operators.majority import majority_of_counts, vote_counts
from hemicycle.operators.merge import files_of, join_on_key, rename, table_exists, unique_source, upsert_table
from hemicycle.operators.dedupe import top_per_group
from hemicycle.plans.reports import FLAGS, MEMBER
from hemicycle.plans.views import MAJORITY, MAJORITY_KEY, member_lookup
from hemicycle.session import stored

ROLL = ["congress", "session", "chamber", "roll_call_number", "bill_name", "bill_key"]
_CONTEXT = [*MAJORITY.values(), "policyArea"]
SUMS = ["n", "votes_cast", *[f"with_{letter}" for letter in MAJORITY]]
_GROUP = ["congress", "chamber", "policyArea", "id_kind", "id"]
#: Columns of the tables; the batch and the congress are folders.
TABLES = {
    "counts": "bill_key string, roll_call_number long, party string, vote string, vote_count long",
    "contexts": "session long, chamber string, roll_call_number long, bill_name string, bill_key string, "
    + ", ".join(f"{c} string" for c in _CONTEXT) + ", sign long",
    "alignment": "chamber string, policyArea string, id_kind string, id string, " + ", ".join(f"{c} long" for c in SUMS),
}
#: The last table of a batch to be written, and the ballots that the fact has to get.
_LAST, _BALLOTS = "alignment", "ballots"


def batches(spark: SparkSession, state: str) -> list[str]:
    """Names of the complete batches."""
    files, make = files_of(spark, state)
    root = make(f"{state}/{_LAST}")
    if not files.exists(root):
        return []
    return sorted(f.getPath().getName().removeprefix("batch=") for f in files.listStatus(root) if f.getPath().getName().startswith("batch="))


def read_state(spark: SparkSession, state: str, table: str, congresses: Collection[int] | None = None) -> DataFrame:
    """Rows of all complete batches, of the chosen congresses' folders only."""
    schema = f"{TABLES[table]}, batch string, congress long"
    complete = batches(spark, state)
    if not complete:
        return spark.createDataFrame([], schema).drop("batch")
    found = spark.read.schema(schema).parquet(f"{state}/{table}").filter(F.col("batch").isin(complete))
    return where_all(found, [F.col("congress").isin(*congresses) if congresses is not None else None]).drop("batch")


def _write(df: DataFrame, state: str, table: str, batch: str) -> None:
    spark = df.sparkSession
    target, ready = f"{state}/{table}/batch={batch}", f"{state}/_writing/{table}"
    if table == _BALLOTS:  # in no folders
        df.write.mode("overwrite").parquet(ready)
    else:  # A task writes to few folders; a folder that is too large is split.
        df.hint("rebalance", "congress").write.mode("overwrite").partitionBy("congress").parquet(ready)
    files, make = files_of(spark, state)
    files.delete(make(target), True)
    files.mkdirs(make(f"{state}/{table}"))
    rename(spark, ready, target)


def summed(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Signed sums per key; keys whose sums are all zero are gone."""
    left = df.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in sums])
    return left.filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums]))


def ballots_of(fact: DataFrame, *more: str) -> DataFrame:
    """Ballots under the one id that each has."""
    kind = F.when(F.col("bioguideID").isNotNull(), "bioguideID").otherwise("lisid")
    return fact.select(*ROLL, kind.alias("id_kind"), F.coalesce("bioguideID", "lisid").alias("id"), "party", "vote", *more)


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ballots that are added (``sign`` 1) and those whose place they take (-1); unchanged ones are left out.

    Both are rows of the fact, unique on its keys, so one join tells which row takes whose place.
    """
    columns = list(dict.fromkeys([*keys, *ROLL, "bioguideID", "lisid", "party", "vote"]))
    before = old.select(*[F.col(c).alias(f"__o_{c}") for c in columns], F.lit(True).alias("__o"))
    pairs = join_on_key(new.select(*columns), before, {k: f"__o_{k}" for k in keys}, "left")
    added = F.struct(*columns, F.lit(1).cast("long").alias("sign"))
    taken = F.struct(
        *[F.col(f"__o_{c}").cast(kind).alias(c) for c, kind in new.select(*columns).dtypes], F.lit(-1).cast("long").alias("sign")
    )
    unchanged = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__o_{c}")) for c in columns if c not in keys])
    both = F.when(F.col("__o").isNull(), F.array(added)).when(~unchanged, F.array(taken, added))
    return ballots_of(pairs.select(F.explode(both).alias("b")).select("b.*"), "sign")


def contributions(ballots: DataFrame, contexts: DataFrame) -> DataFrame:
    """What signed ballots add per member and scope; a ballot counts for each roll call that it belongs to, by both signs."""
    cast = was_cast("vote")
    hits = [(F.col(column) == F.col("vote")).alias(f"with_{letter}") for letter, column in MAJORITY.items()]
    signed = ballots.join(contexts.select(*ROLL, *_CONTEXT, F.col("sign").alias("__sign")), ROLL)
    return signed.withColumn("sign", F.col("sign") * F.col("__sign")).select(
        *_GROUP, F.col("sign").alias("n"), (F.col("sign") * cast).alias("votes_cast"),
        *[F.when(F.coalesce(hit, F.lit(False)), F.col("sign")).otherwise(0).alias(f"with_{letter}") for letter, hit in zip(MAJORITY, hits, strict=True)],
    )


def apply_run(
    spark: SparkSession, tables: str, state: str, name: str, ballots: DataFrame, keys: Sequence[str],
    order: Sequence[Column] | None = None, also: Collection[int] = (),
) -> None:
    """Upserts a run's ballots into the stored fact and adds to the state what they change.

    The run's roll calls and bills must be stored already. ``also`` names congresses without ballots in
    this run whose roll calls or bills changed. Ballots of roll calls not stored yet count from the run
    that brings them.
    """
    _finish(spark, tables, state, keys)
    batch = f"{len(batches(spark, state)):06d}-{name}"
    _write(unique_source(ballots, keys, order), state, _BALLOTS, batch)
    _add_batch(spark, tables, state, batch, keys, also)
    _finish(spark, tables, state, keys)


def _finish(spark: SparkSession, tables: str, state: str, keys: Sequence[str]) -> None:
    """Gives the fact the ballots of complete batches that it has not got; others were left by a run that died."""
    files, make = files_of(spark, state)
    root = make(f"{state}/{_BALLOTS}")
    if not files.exists(root):
        return
    complete = batches(spark, state)
    for folder in sorted(f.getPath().getName() for f in files.listStatus(root)):
        if folder.removeprefix("batch=") in complete:
            source = spark.read.parquet(f"{state}/{_BALLOTS}/{folder}")
            if source.columns:
                upsert_table(spark, f"{tables}/fact_roll_call_vote", source, keys, partition_by="congress", unique=True)
        files.delete(make(f"{state}/{_BALLOTS}/{folder}"), True)


def _add_batch(spark: SparkSession, tables: str, state: str, batch: str, keys: Sequence[str], also: Collection[int]) -> None:
    path = f"{tables}/fact_roll_call_vote"
    new = spark.read.parquet(f"{state}/{_BALLOTS}/batch={batch}")
    # A congress lasts two years: their number is small.
    touched = sorted({r[0] for r in new.select("congress").distinct().collect()} | set(also), key=str)
    here = F.col("congress").isin([c for c in touched if c is not None])
    old = spark.read.parquet(path).filter(here) if table_exists(spark, path) else new.limit(0)
    known = [c for c in touched if c is not None]
    changed = stored(changes(old, new.filter(here), keys), "running_changes")

    more = summed(vote_counts(changed, [*MAJORITY_KEY, "sign"]).select(
        *MAJORITY_KEY, "party", "vote", (F.col("sign") * F.col("vote_count")).alias("vote_count")
    ), [*MAJORITY_KEY, "party", "vote"], ["vote_count"])
    more = stored(more, "running_counts")
    counts = counts_of(read_state(spark, state, "counts", known).unionByName(more))

    # One row per roll call of the touched congresses: stored, so that their sizes plan the joins with ballots.
    was = stored(summed(read_state(spark, state, "contexts", known), [*ROLL, *_CONTEXT], ["sign"]), "running_before")
    after = stored(contexts_of(spark, tables, counts, known).withColumn("sign", F.lit(1).cast("long")), "running_after")
    taken = was.withColumn("sign", -F.col("sign"))
    flips = stored(summed(after.unionByName(taken), [*ROLL, *_CONTEXT], ["sign"]), "running_contexts")

    # New ballots in new contexts less old ones in old contexts: what changed counts in the new contexts, and
    # what was there moves with the contexts that come and go.
    theirs = ballots_of(old).withColumn("sign", F.lit(1).cast("long"))
    added = contributions(changed, after).unionByName(contributions(theirs, flips))
    _write(more, state, "counts", batch)
    _write(flips, state, "contexts", batch)
    _write(summed(added, _GROUP, SUMS), state, _LAST, batch)


def counts_of(rows: DataFrame) -> DataFrame:
    """Ballots per roll call, party and vote, as :func:`hemicycle.operators.majority.vote_counts` gives them."""
    return summed(rows, [*MAJORITY_KEY, "party", "vote"], ["vote_count"])


def contexts_of(spark: SparkSession, tables: str, counts: DataFrame, congresses: Collection[int]) -> DataFrame:
    """Majorities and policy area of the stored roll calls of some congresses."""

    def rows(name: str) -> DataFrame:
        return spark.read.parquet(f"{tables}/{name}").filter(F.col("congress").isin(list(congresses)))

    areas = rows("dim_bills").select("bill_name", "congress", "policyArea").distinct()
    majority = majority_of_counts(counts.filter(F.col("party").isin(*MAJORITY)), MAJORITY_KEY, MAJORITY)
    rolls = rows("dim_votes").select(*ROLL).distinct()
    return rolls.join(majority, MAJORITY_KEY, "left").join(areas, ["bill_name", "congress"], "left").select(*ROLL, *_CONTEXT)


def party_majority(spark: SparkSession, state: str, congresses: Collection[int] | None = None) -> DataFrame:
    """Most frequent vote per roll call and party, from the state."""
    counts = counts_of(read_state(spark, state, "counts", congresses))
    return top_per_group(counts, [*MAJORITY_KEY, "party"], [F.desc("vote_count"), F.asc_nulls_first("vote")])


def majority_table(spark: SparkSession, state: str) -> DataFrame:
    """One row per roll call with the modal vote of each party, for :func:`hemicycle.plans.views.roll_call_context`."""
    counts = counts_of(read_state(spark, state, "counts"))
    return majority_of_counts(counts.filter(F.col("party").isin(*MAJORITY)), MAJORITY_KEY, MAJORITY)


def alignment(
    spark: SparkSession, state: str, members: DataFrame, chamber: str, policy_area: str | None = None,
    congresses: Collection[int] | None = None,
) -> DataFrame:
    """:func:`hemicycle.plans.reports.alignment` from the state: one row per member, scope and batch is read.

    Names and parties are those of ``members`` now, so a member's change of party needs no batch.
    """
    scope = [F.col("chamber") == chamber, F.col("policyArea") == policy_area if policy_area else None]
    sums = summed(where_all(read_state(spark, state, "alignment", congresses), scope), ["id_kind", "id"], SUMS)
    named = sums.join(member_lookup(members).withColumnRenamed("member", "bioguideID"), ["id_kind", "id"])
    whole = named.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in MEMBER]))
    own = F.coalesce(*[F.when(F.col("partyName") == PARTY_LETTERS[letter], F.col(f"with_{letter}")) for letter in MAJORITY], F.lit(0))
    totals = whole.withColumn("own", own).groupBy(*MEMBER).agg(*[F.sum(c).alias(c) for c in (*SUMS, "own")]).filter("n > 0")
    flags = dict(zip(FLAGS.values(), ("own", "with_D", "with_R"), strict=True))
    return totals.select(*MEMBER, "n", "votes_cast", *[F.try_divide(F.col(c), F.col("votes_cast")).alias(name) for name, c in flags.items()])
