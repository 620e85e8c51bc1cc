"""Landing files delivered to the stored tables as they come, each file once.

Every landing folder is a stream of its files; its checkpoint knows which were taken. A call takes what
is there and ends, so it can be scheduled like the batch load that it stands for. A micro-batch that died
is run again with the same files under the same number: upserts and the kept state give the same tables
whether or not part of it had gone through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hemicycle.operators.merge import table_exists
from hemicycle.plans import pipeline
from hemicycle.session import briefly_stored
from hemicycle.sources import readers, schemas

#: Files of a micro-batch at most; bounds what a run that died has to do again.
FILES_PER_BATCH = 1000


def landing_stream(spark: SparkSession, landing: str, kind: str, max_files: int = FILES_PER_BATCH) -> DataFrame:
    """The files of a landing folder, all runs, as a stream with the declared schema; unreadable lines fail."""
    return (
        spark.readStream.schema(schemas.landing_schema(kind))
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", readers.LANDING_FILES)
        .option("maxFilesPerTrigger", max_files)
        .json(f"{landing.rstrip('/')}/{kind}")
    )


def take_new(stream: DataFrame, checkpoint: str, store: Callable[[DataFrame, int], None]) -> int:
    """Hands the rows not taken yet to ``store`` with the number of their micro-batch; how many batches there were."""
    taken = []

    def each(batch: DataFrame, number: int) -> None:
        # Written once: every model of the kind reads it.
        with briefly_stored(batch, "delivery") as rows:
            store(rows, number)
        taken.append(number)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(taken)


def deliver(
    spark: SparkSession, landing: str, seeds: str, tables: str, checkpoints: str, state: str | None = None,
    kinds: tuple[str, ...] = (readers.BILLS, readers.HOUSE_VOTES, readers.SENATE_VOTES, readers.MEMBERS), max_files: int = FILES_PER_BATCH,
) -> dict[str, int]:
    """Delivers what is new in the landing folders to the stored tables; micro-batches taken by kind.

    Bills come before the votes on them. The list of senators' ids is a whole and is read as it is.
    ``checkpoints`` holds one folder for each kind; it belongs to one ``tables``.
    """

    def models(kind: str, rows: DataFrame) -> dict[str, DataFrame]:
        session = rows.sparkSession
        if kind == readers.BILLS:
            return pipeline.bill_tables(rows)
        if kind == readers.MEMBERS:
            overrides = readers.read_seed(session, f"{seeds}/senate_id_overrides.csv", "senate_id_overrides")
            return pipeline.member_tables(rows, readers.read_senate_ids(session, landing), overrides)
        house, senate = (rows if kind == k else session.createDataFrame([], schemas.landing_schema(k)) for k in (readers.HOUSE_VOTES, readers.SENATE_VOTES))
        return pipeline.vote_tables(house, senate)

    def store(kind: str) -> Callable[[DataFrame, int], None]:
        # The kept state needs bills and votes to be stored; until then there is nothing to follow.
        def each(rows: DataFrame, number: int) -> None:
            session = rows.sparkSession
            kept = state if state and (kind != readers.BILLS or table_exists(session, f"{tables}/dim_votes")) else None
            pipeline.store_tables(session, models(kind, rows), tables, kept, f"{kind}-{number}")

        return each

    return {
        kind: take_new(landing_stream(spark, landing, kind, max_files), f"{checkpoints.rstrip('/')}/{kind}", store(kind)) for kind in kinds
    }
