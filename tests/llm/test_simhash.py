"""SimHash fingerprints and their components against plain versions."""

import numpy as np
import pytest
import xxhash

import __spark_entry__ as driver
from hemicycle.llm import simhash

FOLDER = "/root/testdata/sf0.01"


def plain_print(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """Least id reached, by comparing all pairs of ``(id, fingerprint)``."""
    label = {i: i for i, _ in prints}
    for n, (i, x) in enumerate(prints):
        for j, y in prints[n + 1 :]:
            if (x ^ y).bit_count() <= distance and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    label = plain_components(sorted(prints.items()))
    got = driver.queries()["op13_simhash_near_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", label[i]) for i in texts}
    assert len(got) == len(texts) and len(set(label.values())) < len(texts)


@pytest.mark.parametrize("limit", [40, 512])
def test_links_of_crowded_prints(spark, limit):
    """Families of fingerprints that differ in few bits: every bucket is crowded and dealt again."""
    draw = np.random.default_rng(3)
    prints = set()
    for centre in draw.integers(0, 1 << 62, 6):
        places = draw.choice(64, 20, replace=False)
        for _ in range(120):
            flips = draw.choice(places, draw.integers(0, 5), replace=False)
            prints.add(int(centre) ^ sum(1 << int(b) for b in flips))
    # A chain of single steps, and bits at the far ends of the ring.
    prints |= {((1 << i) - 1) << 1 & (1 << 64) - 1 for i in range(0, 64, 3)} | {1 << 63 | 1, 1 << 63 | 7}
    rows = list(enumerate(sorted(prints)))
    reps = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, i) for i, x in rows], "fingerprint long, rep long")
    edges = simhash.links(reps, limit=limit).collect()
    assert all(a != b for a, b in edges)
    label = {i: i for i, _ in rows}
    for a, b in edges:
        low, high = sorted((label[a], label[b]))
        label = {k: low if v == high else v for k, v in label.items()}
    assert label == plain_components(rows)


def test_chains_hold_every_link():
    """Any two fingerprints at three bits or fewer agree on a key, and pass the chain from its start."""
    draw = np.random.default_rng(9)
    keys = simhash.first_masks(3, 8)
    assert len(keys) == 24 and all(m.bit_count() == 32 for _, m in keys)
    for _ in range(300):
        flips = sum(1 << int(b) for b in draw.choice(64, draw.integers(1, 4), replace=False))
        pair = np.array([0, flips], np.uint64)
        met = [s for s, m in keys if not flips & m]
        assert any(len(simhash.linked_pairs(pair, np.array([2, 2]), np.array([s, s]), 3, 8)[0]) for s in met)
    # The chains prune: most pairs that agree on a key and differ in eight other bits never reach the full check.
    assert sorted(p.bit_count() for p in simhash.finer_masks(keys[0][1], 4)) == [40] * 4


@pytest.mark.parametrize(("distance", "segments"), [(0, 8), (1, 4), (2, 8), (5, 16)])
def test_other_distances(spark, distance, segments):
    draw = np.random.default_rng(distance)
    prints = sorted({int(c) ^ sum(1 << int(b) for b in draw.choice(64, 3, replace=False)) for c in draw.integers(0, 1 << 62, 9) for _ in range(12)})
    rows = list(enumerate(prints))
    edges = simhash.links(spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, i) for i, x in rows], "fingerprint long, rep long"), distance, segments, limit=16).collect()
    label = {i: i for i, _ in rows}
    for a, b in edges:
        low, high = sorted((label[a], label[b]))
        label = {k: low if v == high else v for k, v in label.items()}
    assert label == plain_components(rows, distance)


def test_odd_and_empty_tables(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [
        (1, None, "k"), (2, "", "k"), (3, " \n\t ", None), (4, "One two", "k"), (5, "one TWO", "k"), (6, long, "k"), (7, long, "k"),
        (8, "x " * 200, "k"), (8, "x " * 200, "k"), (None, "one two", "k"), (None, None, None), (9, "One two three", "k"), (9, "one two", "k"),
        (10, "x" * 5_000_000, "k"), (11, "ÀÉ é", "k"),
    ]
    schema = "doc_id int, text string, fingerprint string"
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema).withColumn("rep", simhash.F.lit(1))).collect()
    assert len(got) == len(rows)
    expected = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 4, 10: 10, 11: 11}
    assert {r.doc_id: r.component_id for r in got} == {**expected, None: None}
    assert sorted(map(str, ((r.doc_id, r.fingerprint) for r in got))) == sorted(map(str, ((i, f"{plain_print(t):016x}") for i, t, _ in rows)))
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
