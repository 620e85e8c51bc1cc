"""Vector codes against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

import __spark_entry__ as driver
from hemicycle.llm import vector_codes
from parity.compare import connect

FOLDER = "/root/testdata/sf0.01"


def plain(rows, rounds=4):
    """Rows ``(vec_id, code, error, label_error, digest)`` of ``(vec_id, vector, label)`` in integers only."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(1, *(len(v) for _, v, _ in kept)) // 4)
    parts = [[(v + [0] * 4 * width)[p * width : (p + 1) * width] for _, v, _ in kept] for p in range(4)]
    books = [[list(x) for x in part[:256]] for part in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for part, book in zip(parts, books, strict=True):
            groups = {}
            for x in part:
                groups.setdefault(nearest(x, book)[1], []).append(x)
            for e, xs in groups.items():
                book[e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    found = [[nearest(x, book) for x in part] for part, book in zip(parts, books, strict=True)]
    errors = [sum(found[p][n][0] for p in range(4)) for n in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    name = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return [(i, "".join(f"{found[p][n][1]:02x}" for p in range(4)), errors[n], by_label[label], name) for n, (i, _, label) in enumerate(kept)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark):
    rows = connect(FOLDER).sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    got = driver.queries()["op11_vector_codes"](spark, FOLDER)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows_of(got) == sorted(plain(rows), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int, code string, of int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("case", ["few", "ties", "large", "huge", "short"])
def test_odd_vectors(spark, case):
    draw = np.random.default_rng(len(case))
    rows = [(int(i), [float(x) for x in draw.normal(size=8)], int(i) % 3 or None) for i in draw.permutation(40)]
    if case == "few":
        rows += [(50, None, 1), (51, [None] * 8, 1), (52, [float("nan")] * 8, 1), (53, [float("inf")] + [0.0] * 7, 1), (None, [0.5] * 8, 7), (3, [0.25] * 8, 7), (3, [0.25] * 8, 7)]
    elif case == "ties":
        rows = [(i, [float(x) for x in draw.integers(-1, 2, 8) / 1024], 1) for i in range(700)]
    elif case == "large":
        rows += [(60, [3e4 + 0.1] * 8, 2), (61, [-3e4] * 8, 2), (62, [-1e5, 2e5] * 4, 2)]
    elif case == "huge":
        rows = [(i, [x * 1e200 for x in v], label) for i, v, label in rows] + [(70, [1e-300, -1e-300] * 4, 1)]
    else:
        rows = [(i, v[: i % 8], label) for i, v, label in rows]
    if case == "huge":  # every vector has an entry of its own, so all errors are zero
        rows = rows[:200]
    assert rows_of(vector_codes.compressed(frame(spark, rows))) == sorted(plain(rows), key=str)


def test_without_vectors(spark):
    assert vector_codes.compressed(frame(spark, [])).collect() == []
    assert vector_codes.compressed(frame(spark, [(1, None, 1)])).collect() == []
    got = rows_of(vector_codes.compressed(frame(spark, [(1, [], 1), (2, [], None)])))
    assert [r[:4] for r in got] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]


def test_cells_leave_out_dominated_entries_only(monkeypatch):
    """Clustered parts: most entries are left out, cells are met again, and the nearest entry is always kept."""
    monkeypatch.setattr(vector_codes, "CELLS", 50)
    draw = np.random.default_rng(1)
    entries = draw.integers(-500, 500, (256, 4))
    cells = vector_codes.Cells(entries)
    parts = (entries[draw.integers(0, 256, 3000)] + draw.integers(-9, 10, (3000, 4))).astype(np.int64)
    entry, distance = cells.assign(parts)
    all_distances = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (entry == all_distances.argmin(axis=1)).all() and (distance == all_distances.min(axis=1)).all()
    left = cells.undominated(np.unique((parts - cells.low) // cells.size, axis=0))
    assert len(cells.kept) <= vector_codes.PAIRS // 256 and np.mean([len(x) for x in left]) < 40
    entry, distance = cells.assign(np.full((2, 4), 10**6))
    assert (entry == ((10**6 - entries) ** 2).sum(axis=1).argmin()).all()
