"""Incremental load: upsert, high-water marks, new-rows filters."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.functions.dates import iso_instant, stated_instant
from hemicycle.operators.dedupe import top_per_group
from hemicycle.session import briefly_stored, files_of, shuffles_dropped

#: Mark of an empty or missing table, and the last year a former member may have left.
DEFAULT_MARK = "2015-01-01T00:00:00Z"
MEMBER_YEAR_LIMIT = 2015
#: Load-time stamps an update leaves alone.
AUDIT_COLUMNS = ("flowDate", "updateDatetime")
#: Rows of table and source that one write of an upsert into folders takes, unless a single folder has more.
#: Bounds the shuffle files that are on the disks at a time, some 100 bytes a row.
ROWS_PER_WRITE = 32_000_000


def unique_source(source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The source with one row per key.

    With ``order`` the first row of each key is kept. Without it the rows pass unchanged
    and a repeated key fails the job when it runs. The rows are sorted by a hash of the key
    first, which settles most comparisons by one number instead of by many texts.
    """
    if order is not None:
        return top_per_group(source, [F.xxhash64(*keys), *keys], order)
    rest = [c for c in source.columns if c not in keys]
    counted = source.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.any_value(c).alias(c) for c in rest])
    once = F.assert_true(F.col("__n") == 1, F.lit(f"merge source repeats a key of {', '.join(keys)}"))
    return counted.filter(once.isNull()).select(*source.columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = AUDIT_COLUMNS,
    order: Sequence[Column] | None = None,
    version: Sequence[str] = (),
) -> DataFrame:
    """Target after an upsert: matched rows take the source's values, new keys are added.

    Keys compare null-safe, so a row with a null key part is updated rather than added
    again. Columns in ``exclude`` keep the target's value on a match. Both sides are unique
    on the key, which spreads the full outer join evenly.

    ``version`` names columns whose first non-null value tells how new a row is. A target row
    that is newer than the source's stays as it is; a row without a version is the oldest.
    """
    return _merged(target, unique_source(source, keys, order), keys, exclude, version)


def _merged(target: DataFrame, new: DataFrame, keys: Sequence[str], exclude: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The upsert of a source that is unique on the keys."""
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*[F.col(c).alias(f"__t_{c}") for c in target.columns], F.lit(True).alias("__t"))
    new = new.select(*[F.col(c).alias(f"__s_{c}") for c in new.columns], F.lit(True).alias("__s"))
    joined = join_on_key(old, new, {f"__t_{k}": f"__s_{k}" for k in keys}, "full_outer")

    later = F.lit(False)
    if version:
        ours, given = (F.coalesce(*[F.col(f"{side}{c}") for c in version]) for side in ("__t_", "__s_"))
        later = F.col("__t") & ours.isNotNull() & (given.isNull() | (ours > given))

    def value(col: str) -> Column:
        mine, theirs = F.col(f"__t_{col}"), F.col(f"__s_{col}")
        if f"__s_{col}" not in new.columns:
            return mine
        if col in keys or col in exclude:
            return F.when(F.col("__t"), mine).otherwise(theirs)
        return F.when(F.col("__s") & ~F.coalesce(later, F.lit(False)), theirs).otherwise(mine)

    kinds = dict(target.dtypes)
    picked = {c: value(c).cast(kinds[c]).alias(c) for c in [*keys, *rest]}
    return joined.select(*[picked[c] for c in target.columns])


def join_on_key(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str) -> DataFrame:
    """Join of frames without a column name in common on pairs of key parts, compared null-safe.

    A hash of the parts that have the same type on both sides leads the key, so that the sort of
    a join compares one number for most rows; equal parts have equal hashes.
    """
    kinds, others = dict(left.dtypes), dict(right.dtypes)
    same = [F.col(l).eqNullSafe(F.col(r)) for l, r in keys.items()]
    alike = {l: r for l, r in keys.items() if kinds[l] == others[r]}
    if alike:
        left, right = left.withColumn("__l", F.xxhash64(*alike)), right.withColumn("__r", F.xxhash64(*alike.values()))
        same = [F.col("__l") == F.col("__r"), *same]
    return left.join(right, reduce(lambda a, b: a & b, same), how).drop("__l", "__r")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored at ``path``.

    An upsert that was cut off is finished first. A folder without a readable table is an error, as
    taking it for a new table would hide a loss.
    """
    _finish(spark, path)
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = AUDIT_COLUMNS,
    order: Sequence[Column] | None = None,
    partition_by: str | None = None,
    version: Sequence[str] = (),
    unique: bool = False,
) -> None:
    """Upsert into a Parquet table, made on first use.

    With ``partition_by`` (one of the keys) only the folders the source touches are read
    and rewritten, as many at a time as hold :data:`ROWS_PER_WRITE` rows. The merged rows are
    written beside the table (``<path>.writing``), named
    ``<path>.ready`` once complete, and only then take the place of what they replace. A job that
    dies before that leaves the table as it was; one that dies after it is finished by the next
    call. Needs a file system that renames folders at once. ``unique`` says that the source is
    stored and was made unique on the keys before, so that neither is done again.
    """
    if partition_by and partition_by not in keys:
        raise ValueError("partition_by must be part of the key")
    new = source if unique else unique_source(source, keys, order)
    target = spark.read.parquet(path) if table_exists(spark, path) else None
    with shuffles_dropped(source.sparkSession):
        if target is None:
            _write(new, f"{path}.writing", partition_by)
        elif not partition_by:
            _write(_merged(target, new, keys, exclude, version), f"{path}.writing")
        else:
            # Written once, as both the folders and the rows are taken from it.
            with nullcontext(new) if unique else briefly_stored(new, "upsert_source") as kept:
                # The folder as the table names it; at most one value per folder comes to the driver.
                place = F.col(partition_by).cast(target.schema[partition_by].dataType)
                touched = dict(kept.groupBy(place.alias(partition_by)).count().collect())
                there = _within(target, F.col(partition_by), touched)
                held = dict(there.groupBy(partition_by).count().collect())
                groups = packed({v: n + held.get(v, 0) for v, n in touched.items()}, ROWS_PER_WRITE)
                for number, values in enumerate(groups or [[]]):
                    old, given = _within(target, F.col(partition_by), values), _within(kept, place, values)
                    merged = _merged(old, given, keys, exclude, version)
                    _write(merged, f"{path}.writing", partition_by, "append" if number else "overwrite", len(values) > 1)
    rename(spark, f"{path}.writing", f"{path}.ready")
    _finish(spark, path)


def packed(sizes: Mapping, most: int) -> list[list]:
    """The keys in groups whose sizes come to ``most`` at most; a key beyond that is a group of its own."""
    groups, room = [], 0
    for key in sorted(sizes, key=sizes.get):
        if not groups or sizes[key] > room:
            groups.append([])
            room = most
        groups[-1].append(key)
        room -= sizes[key]
    return groups


def _within(df: DataFrame, folder: Column, values: Collection) -> DataFrame:
    """The rows of some folders; of a partitioned table no other folder is read."""
    known = folder.isin([v for v in values if v is not None])
    return df.filter(known | folder.isNull() if None in values else known)


def _write(rows: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite", spread: bool = True) -> None:
    """With ``spread`` no task writes to every folder and a folder that is too large is split; rows of one folder need not move."""
    if not partition_by:
        rows.write.mode(mode).parquet(path)
        return
    (rows.hint("rebalance", partition_by) if spread else rows).write.mode(mode).partitionBy(partition_by).parquet(path)


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, make = files_of(spark, old)
    if not files.rename(make(old), make(new)):
        raise OSError(f"cannot rename {old} to {new}")


def _finish(spark: SparkSession, path: str) -> None:
    """Put complete new rows in the place of the old ones; can be repeated from any point."""
    files, make = files_of(spark, path)
    ready, old = f"{path}.ready", f"{path}.old"
    if files.exists(make(ready)):
        found = files.listStatus(make(ready))
        folders = [f.getPath().getName() for f in found if f.isDirectory()]
        parts = [f for f in found if f.getPath().getName().endswith(".parquet")]
        if parts or not files.exists(make(path)):
            if files.exists(make(path)):
                files.delete(make(old), True)
                rename(spark, path, old)
            rename(spark, ready, path)
        else:
            files.mkdirs(make(old))
            for name in folders:
                if files.exists(make(f"{path}/{name}")):
                    files.delete(make(f"{old}/{name}"), True)
                    rename(spark, f"{path}/{name}", f"{old}/{name}")
                rename(spark, f"{ready}/{name}", f"{path}/{name}")
            files.delete(make(ready), True)
        spark.catalog.refreshByPath(path)
    if files.exists(make(old)):
        files.delete(make(old), True)


def high_water_mark(df: DataFrame, field: str, default: str = DEFAULT_MARK) -> DataFrame:
    """One row, one column ``mark``: the latest instant text, ``default`` if there is none."""
    return df.agg(F.coalesce(F.max(F.coalesce(F.col(field), F.lit(default))), F.lit(default)).alias("mark"))


def high_water_mark_of(spark: SparkSession, path: str, field: str, default: str = DEFAULT_MARK) -> Column:
    """The mark of a stored table as a value for filters; ``default`` if the table is missing."""
    if not table_exists(spark, path):
        return F.lit(default)
    return high_water_mark(spark.read.parquet(path), field, default).scalar()


def as_mark(mark: Column | str | DataFrame) -> Column:
    """A mark text, column or one-row frame as a timestamp."""
    if isinstance(mark, DataFrame):
        mark = mark.scalar()
    return iso_instant(F.lit(mark) if isinstance(mark, str) else mark)


def filter_new_bills(
    bills: DataFrame,
    mark: Column | str | DataFrame,
    field: str = "updateDateIncludingText",
    fallback: str = "updateDate",
) -> DataFrame:
    """Bills updated at or after the mark; bills without ``field`` go by ``fallback``.

    Rows without a date are left out; a date that cannot be read fails the job, here and below.
    """
    updated = F.coalesce(F.nullif(F.col(field), F.lit("")), F.col(fallback))
    return bills.filter(stated_instant(updated) >= as_mark(mark))


def filter_new_votes(votes: DataFrame, mark: Column | str | DataFrame, field: str = "date") -> DataFrame:
    """Recorded votes dated at or after the mark; a missing date counts as 1900."""
    return votes.filter(stated_instant(F.coalesce(F.col(field), F.lit("1900-01-01T00:00:00Z"))) >= as_mark(mark))


def filter_members(
    members: DataFrame,
    mark: Column | str | DataFrame,
    end_year: int = MEMBER_YEAR_LIMIT,
    terms: str = "terms_all.item",
    updated: str = "updateDate",
) -> DataFrame:
    """Members updated at or after the mark with an open term or one that ended after ``end_year``."""
    serves = F.exists(F.col(terms), lambda t: t["endYear"].isNull() | (t["endYear"] > end_year))
    return members.filter((stated_instant(updated) >= as_mark(mark)) & serves)
