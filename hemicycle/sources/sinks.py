"""Landing folders and exported tables."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.votes import HOUSE, SENATE
from hemicycle.session import shuffles_dropped

#: Rows per landing file.
ROWS_PER_FILE = 250
#: How landing files are packed; their lines are alike and shrink to a tenth. The quickest level takes hardly more
#: time than plain files do. A compression of ``none`` gives those.
PACKING = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: Tables that are exported for the dashboard.
EXPORTED = (
    "vw_votes_by_member", "vw_sponsored_bills_by_member", "vw_voting_members", "vw_terms_condensed",
    "dim_members", "dim_congressional_districts",
)


def write_ndjson(df: DataFrame, path: str, max_records: int = ROWS_PER_FILE) -> None:
    """Newline JSON, at most ``max_records`` rows per file, compressed; tasks write side by side."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").options(maxRecordsPerFile=max_records, **PACKING).json(path)


def write_run(df: DataFrame, path: str, run_date: datetime.date | str, max_records: int = ROWS_PER_FILE) -> None:
    """The rows of one run, in a folder named by its date.

    Writing the same run again replaces its folder and no other; a run without rows
    leaves a folder without rows.
    """
    day = run_date if isinstance(run_date, datetime.date) else datetime.date.fromisoformat(run_date)
    write_ndjson(df, f"{path.rstrip('/')}/run_date={day.isoformat()}", max_records)


def split_by_chamber(df: DataFrame, col: str = "chamber") -> tuple[DataFrame, DataFrame]:
    """House rows and Senate rows; rows of any other chamber are in neither."""
    return df.filter(F.col(col) == HOUSE), df.filter(F.col(col) == SENATE)


def overwrite_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Full rebuild. ``path`` must not be among the inputs of ``df``."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def export_views(tables: Mapping[str, DataFrame], out: str, partition_by: str | None = None) -> None:
    """Write each table as Snappy Parquet.

    With ``partition_by`` the tables that have the column are laid out in folders by it, so
    a session filter reads its own folder only; rows are first spread by that column so
    that no task holds a file open per folder, and AQE splits a folder that is too large.
    """
    for name, df in tables.items():
        path = f"{out.rstrip('/')}/{name}.parquet"
        if partition_by and partition_by in df.columns:
            overwrite_table(df.hint("rebalance", partition_by), path, partition_by)
        else:
            overwrite_table(df, path)
