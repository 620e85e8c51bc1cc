"""Vector compression: four codebooks learnt in rounds, parts assigned through memoised grid cells.

A part of a vector lies in one cell of a coarse grid over the whole numbers, ``GRID`` cells across the
extent of the codebook in every dimension and as many beyond it as there is data. Of a cell's box the
least and the greatest squared distance to every entry are known; an entry whose least distance is above
the smallest greatest one is dominated: some other entry is nearer everywhere in the box. A worker keeps
the entries that are left by the hashed cell, and only those are evaluated exactly for the parts in it.
All arithmetic is on whole numbers, so ties are true ties and the rounds agree on any cluster.

A round gives one sum for each task, part and entry; those are added by part and entry. The codebooks
(4 x 256 entries) go through the driver, nothing else does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.session import stored

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Cells across the extent of a codebook, in each dimension.
GRID = 16
#: Cells that a worker keeps for each part position before it starts anew.
CELLS = 30_000
#: Values of the vectors that are assigned in one step, and pairs of part and entry that are evaluated in one.
STEP, PAIRS = 1 << 19, 1 << 19
#: Squared distances of whole numbers in double precision are exact below this.
_EXACT = 2.0**53


def whole(vectors: list, width: int) -> np.ndarray:
    """floor(1024 x) of each component, filled up with zeros to ``width``; Python integers where 64 bits are too few."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    if not out.size or np.abs(out).max() < 2.0**50:
        return np.floor(out * SCALE).astype(np.int64)
    # Halves and less have a fraction to floor, larger components may be beyond 64 bits.
    return np.array([[int(x) * SCALE if x.is_integer() else int(np.floor(x * SCALE)) for x in row] for row in out.tolist()], object)


def is_exact(values: np.ndarray, width: int) -> bool:
    """Whether squared distances between whole numbers of this size are exact in double precision."""
    return values.dtype != object and (not values.size or width * (4.0 * float(np.abs(values).max()) + 4) ** 2 < _EXACT)


class Cells:
    """One codebook, with the entries that matter in each cell met so far."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.exact = len(entries) > 0 and is_exact(entries, entries.shape[1])
        self.kept: dict[bytes, np.ndarray] = {}
        if self.exact:
            self.low = entries.min(axis=0)
            self.size = np.maximum(1, (entries.max(axis=0) - self.low) // GRID + 1)
            self.real = entries.astype(np.float64)

    def undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """Entries that can be nearest somewhere in each cell, ascending."""
        near, far = np.zeros((2, len(cells), len(self.entries)))
        for j in range(cells.shape[1]):
            numbers, place = np.unique(cells[:, j], return_inverse=True)
            low = (self.low[j] + numbers * self.size[j]).astype(np.float64)[:, None]
            high, entry = low + float(self.size[j] - 1), self.real[:, j]
            near += (np.maximum(np.maximum(low - entry, entry - high), 0) ** 2)[place]
            far += (np.maximum(np.abs(entry - low), np.abs(entry - high)) ** 2)[place]
        left = near <= far.min(axis=1)[:, None]
        return [np.flatnonzero(row) for row in left]

    def of_cells(self, cells: np.ndarray) -> list[np.ndarray]:
        names = [c.tobytes() for c in cells]
        new = [i for i, name in enumerate(names) if name not in self.kept]
        if len(self.kept) + len(new) > CELLS:
            self.kept.clear()
            new = list(range(len(names)))
        step = max(1, PAIRS // len(self.entries))
        for i in range(0, len(new), step):
            for at, left in zip(new[i : i + step], self.undominated(cells[new[i : i + step]]), strict=True):
                self.kept[names[at]] = left.astype(np.uint16)
        return [self.kept[name] for name in names]

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, ties to the lower one, and the squared distance."""
        if self.exact and is_exact(parts, parts.shape[1]):
            return self._near(parts)
        one_by_one = [self._plain(p) for p in parts.tolist()]
        return np.array([e for e, _ in one_by_one], np.int64), np.array([d for _, d in one_by_one], object)

    def _near(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells, which = np.unique((parts - self.low) // self.size, axis=0, return_inverse=True)
        entries, distances = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        real = parts.astype(np.float64)
        # As many parts at a time as even whole codebooks would make PAIRS pairs of.
        step = max(1, PAIRS // len(self.entries))
        for begin in range(0, len(cells), step):
            lists = self.of_cells(cells[begin : begin + step])
            mine = np.flatnonzero((which >= begin) & (which < begin + step))
            for i in range(0, len(mine), step):
                at = mine[i : i + step]
                chosen = [lists[w - begin] for w in which[at]]
                lengths = np.fromiter(map(len, chosen), np.int64, len(chosen))
                entry, point = np.concatenate(chosen).astype(np.int64), np.repeat(at, lengths)
                distance = np.zeros(len(entry))
                for j in range(parts.shape[1]):
                    distance += (real[point, j] - self.real[entry, j]) ** 2
                heads = np.cumsum(lengths) - lengths
                least = np.minimum.reduceat(distance, heads)
                first = np.flatnonzero(distance == np.repeat(least, lengths))
                first = first[np.searchsorted(first, heads)]
                entries[at], distances[at] = entry[first], least.astype(np.int64)
        return entries, distances

    def _plain(self, part: list[int]) -> tuple[int, int]:
        """For numbers beyond double precision."""
        found = [(sum((x - c) ** 2 for x, c in zip(part, entry, strict=True)), e) for e, entry in enumerate(self.entries.tolist())]
        distance, entry = min(found)
        return entry, distance


_CELLS: dict[str, list[Cells]] = {}


def cells_of(name: str, codebooks: list[np.ndarray]) -> list[Cells]:
    """The cells of the codebooks of a round; those of earlier rounds are let go."""
    if name not in _CELLS:
        _CELLS.clear()
        _CELLS[name] = [Cells(c) for c in codebooks]
    return _CELLS[name]


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimals by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for c in codebooks for entry in c.tolist() for x in entry).encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """The rows in tables of about ``STEP`` values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for i in range(0, batch.num_rows, max(1, STEP // width)):
            held.append(batch.slice(i, max(1, STEP // width)))
            if sum(b.num_rows for b in held) * width >= STEP:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _parts(table: pa.Table, width: int) -> list[np.ndarray]:
    points = whole(table.column("vector").to_pylist(), width)
    return np.split(points, PARTS, axis=1)


def _sum(shared, width: int):
    """A task's rows of each part and entry: ``part, entry, n, sums`` (decimals, as a sum may be of any size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, codebooks = shared.value
        cells = cells_of(name, codebooks)
        counts = np.zeros((PARTS, len(codebooks[0])), np.int64)
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        for table in _blocks(batches, width):
            for p, parts in enumerate(_parts(table, width)):
                entry, _ = cells[p].assign(parts)
                np.add.at(counts[p], entry, 1)
                if parts.dtype == object and sums[p].dtype != object:
                    sums[p] = sums[p].astype(object)
                np.add.at(sums[p], entry, parts)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
                pa.array([list(map(str, sums[p][e].tolist())) for p, e in zip(part, entry, strict=True)], pa.list_(pa.string())),
            ],
            ["part", "entry", "n", "sums"],
        )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the rows of all tasks; the task has all rows of its parts and entries."""
    total: dict[tuple[int, int], list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held = total.setdefault((row["part"], row["entry"]), [0, [0] * len(row["sums"])])
            held[0] += row["n"]
            held[1] = [a + int(b) for a, b in zip(held[1], row["sums"], strict=True)]
    rows = [{"part": p, "entry": e, "n": n, "sums": list(map(str, s))} for (p, e), (n, s) in total.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))]))


def _encode(shared, width: int):
    """Codes and errors of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, codebooks = shared.value
        cells = cells_of(name, codebooks)
        for table in _blocks(batches, width):
            found = [c.assign(p) for c, p in zip(cells, _parts(table, width), strict=True)]
            codes = ["".join(f"{e:02x}" for e in row) for row in np.stack([e for e, _ in found], axis=1).tolist()]
            errors = [sum(row) for row in zip(*(d.tolist() for _, d in found), strict=True)]
            out = pa.table([table.column("vec_id"), table.column("label"), pa.array(codes), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])
            yield from out.to_batches()

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows without null or non-finite components."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vector").isNotNull() & ~bad)


def codebooks(rows: DataFrame, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part position; at most ``ENTRIES`` vectors of ``width`` numbers pass through the driver."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    books = np.split(whole([r.vector for r in first], width), PARTS, axis=1)
    for number in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast((f"{number} {digest(books)}", books))
        sums = rows.select("vector").mapInArrow(_sum(shared, width), "part int, entry int, n long, sums array<string>")
        sums = sums.repartition("part", "entry").mapInArrow(_add, "part int, entry int, n long, sums array<string>")
        books = [b.astype(object) for b in books]
        for part, entry, n, values in sums.collect():
            books[part][entry] = [int(v) // n for v in values]
        books = [b.astype(np.int64) if all(abs(x) < 1 << 62 for x in b.flat) else b for b in books]
    return books


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each vector.

    Args: ``vectors`` with ``vec_id``, ``embedding`` and ``label``; other columns are not read. Rows whose
    vector is null or holds a null or non-finite component are left out. A vector shorter than the longest,
    or one whose length four does not divide, counts as filled up with zeros. Of fewer than 256 vectors the
    codebooks have as many entries. The first entries are those of the rows first by ``vec_id``, nulls last
    and rows of one id by their vector; repeated rows count each. Components of any finite size are exact;
    an error that does not fit into 64 bits fails. Null labels make one group. An empty table, or one
    without a usable vector, gives an empty table.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // PARTS)) * PARTS
    books = codebooks(rows, width, rounds)
    shared = spark.sparkContext.broadcast((f"codes {digest(books)}", books))
    schema = T.StructType([*rows.select("vec_id", "label").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = stored(rows.select("vec_id", "label", "vector").mapInArrow(_encode(shared, width), schema), "codes_rows")
    by_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes_labels").withColumnRenamed("label", "of")
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
