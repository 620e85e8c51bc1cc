"""What runs leave on the disks."""

import datetime
import os
import time

from conftest import rows
from hemicycle.functions.json import json_list
from hemicycle.operators import merge
from hemicycle.plans import pipeline
from hemicycle.plans.extras import structured_bills
from hemicycle.session import checkpoint_root
from hemicycle.sources import readers, sinks
from hemicycle.streaming import delivery
from parity import shapes

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"


def orders(spark, n):
    found = [(k, k % 5, "OFP"[k % 3], "1-URGENT", datetime.datetime(1996, 1 + k % 12, 1 + k % 28)) for k in range(n)]
    return spark.createDataFrame(found, ORDERS)


def files_under(path):
    return [os.path.join(at, f) for at, _, found in os.walk(path) for f in found if f.startswith("part-")]


def size(path):
    return sum(os.path.getsize(f) for f in files_under(path))


def shuffle_files(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.size()) if kept.apply(i).getName().startswith("shuffle_")}


def none_left(spark, before):
    """Whether the shuffle files since ``before`` go without the driver's memory being collected; they go beside the caller."""
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    return not shuffle_files(spark) - before


def scratch(spark):
    """Scratch tables of upserts and deliveries; the folder may hold those of other sessions."""
    root = checkpoint_root(spark).removeprefix("file:")
    return {f for f in (os.listdir(root) if os.path.isdir(root) else []) if f.startswith(("upsert_source-", "delivery-"))}


def test_landing_files_are_packed(spark, tmp_path):
    bills = structured_bills(shapes.bills(orders(spark, 600)))
    before = shuffle_files(spark)
    sinks.write_run(bills, f"{tmp_path}/packed/{readers.BILLS}", "2024-05-06")
    assert none_left(spark, before)
    found = files_under(tmp_path / "packed")
    assert len(found) >= 3 and all(f.endswith(".json.gz") for f in found)
    bills.write.json(f"{tmp_path}/plain/{readers.BILLS}/run_date=2024-05-06")
    assert size(tmp_path / "packed") * 5 < size(tmp_path / "plain")
    packed, plain = (readers.read_ndjson(spark, f"{tmp_path}/{n}", readers.BILLS) for n in ("packed", "plain"))
    assert packed.count() == 600 and rows(packed) == rows(plain)


def test_packed_and_plain_files_are_delivered(spark, tmp_path):
    votes = shapes.house_votes(orders(spark, 60))
    sinks.write_run(votes.filter("bill_number < 7"), f"{tmp_path}/landing/{readers.HOUSE_VOTES}", "2024-05-06")
    votes.filter("bill_number >= 7").write.json(f"{tmp_path}/landing/{readers.HOUSE_VOTES}/run_date=2024-05-07")
    taken = []
    delivery.take_new(
        delivery.landing_stream(spark, f"{tmp_path}/landing", readers.HOUSE_VOTES), f"{tmp_path}/marks",
        lambda batch, number: taken.append((batch.count(), batch.select("bill_number").distinct().count())),
    )
    assert taken == [(40, 8)]


def test_one_object_is_a_list_of_one(spark):
    texts = ['{"a":"1"}', '[{"a":"1"},{"a":null},null]', "[]", "{}", '"x"', "1", "[1]", "{", None, ' {"a":"1"}', '{"a":"1"} x']
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    found = [r[1] and [e and e["a"] for e in r[1]] for r in df.select("n", json_list("t", "$", "struct<a:string>")).orderBy("n").collect()]
    assert found[:4] == [["1"], ["1", None, None], [], [None]] and found[4:9] == [None] * 5 and found[9] == ["1"]
    # The path is looked up once for each value, not for each branch.
    plan = df.select(json_list("t", "$", "struct<a:string>").alias("l"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("get_json_object") == 1


def frame(spark, data):
    return spark.createDataFrame(data, "congress int, k string, v string")


def test_folders_are_merged_a_few_at_a_time(spark, tmp_path, monkeypatch):
    """The same table whatever a write takes; rows with null keys, folders only one side has."""
    first = [(c, f"k{n}", "old") for c in (1, 2, 3, None) for n in range(4)] + [(9, "k0", "old"), (3, None, "old")]
    second = [(c, f"k{n}", "new") for c in (1, 2, 3, 4, None) for n in (3, 4)] + [(3, None, "new"), (4, "k9", "new")]
    written, plain, found = [], merge._write, {}

    def noted(*more):
        written.append(more)
        plain(*more)

    monkeypatch.setattr(merge, "_write", noted)
    for most in (merge.ROWS_PER_WRITE, 7):
        monkeypatch.setattr(merge, "ROWS_PER_WRITE", most)
        path = f"{tmp_path}/{most}"
        merge.upsert_table(spark, path, frame(spark, first), ["congress", "k"], partition_by="congress")
        written.clear()
        before, others = shuffle_files(spark), scratch(spark)
        merge.upsert_table(spark, path, frame(spark, second), ["congress", "k"], partition_by="congress")
        assert none_left(spark, before) and scratch(spark) == others
        spark.catalog.refreshByPath(path)
        found[most] = rows(spark.read.parquet(path).select("congress", "k", "v"))
        assert len(written) == (1 if most > 7 else 5)
        # No row, so nothing to write.
        merge.upsert_table(spark, path, frame(spark, []), ["congress", "k"], partition_by="congress")
        spark.catalog.refreshByPath(path)
        assert rows(spark.read.parquet(path).select("congress", "k", "v")) == found[most]
    expected = {(c, k): v for c, k, v in [*first, *second]}
    for got in found.values():
        assert got == sorted([(c, k, v) for (c, k), v in expected.items()], key=lambda r: [(v is None, str(v)) for v in r])


def test_packed_groups():
    assert merge.packed({"a": 5, "b": 1, None: 2, "c": 9}, 4) == [["b", None], ["a"], ["c"]]
    assert merge.packed({"a": 2, "b": 2, "c": 1}, 3) == [["c", "a"], ["b"]]
    assert merge.packed({}, 3) == []


def test_a_delivery_leaves_no_scratch_files(spark, tmp_path):
    landing, tables = f"{tmp_path}/landing", f"{tmp_path}/tables"
    for day in (1, 2):
        sinks.write_run(shapes.house_votes(orders(spark, 30 * day)), f"{landing}/{readers.HOUSE_VOTES}", f"2024-05-0{day}")
        before, others = shuffle_files(spark), scratch(spark)
        assert delivery.deliver(spark, landing, "", tables, f"{tmp_path}/marks", kinds=(readers.HOUSE_VOTES,)) == {readers.HOUSE_VOTES: 1}
        assert none_left(spark, before) and scratch(spark) == others
    keys = pipeline.MODELS[pipeline.FACT].keys
    expected = shapes.fact(orders(spark, 60)).filter("bioguideID is not null").select(*keys).distinct()
    assert rows(spark.read.parquet(f"{tables}/{pipeline.FACT}").select(*keys)) == rows(expected)
