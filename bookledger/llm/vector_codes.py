"""Product codes of vectors: integer Lloyd rounds that look only at entries that moved."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookledger.llm.common import Scratch, spread_lookup

#: A component x becomes the integer floor(SCALE * x).
SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Integers beyond this could leave the range of a long when squared and summed.
LARGEST = 2**28
#: Vectors that a task looks at together.
BLOCK = 1024


def scaled(vectors: DataFrame, vector: str, vec_id: str, label: str) -> DataFrame:
    """``vec_id, label, v``: integer components of the rows whose vector has neither nulls nor non-finite values.

    ``label`` is a text that is never null, so equal labels and nulls stay together.
    """
    x = F.col(vector)
    # Checked before the cast to integers, which ends the query beyond their range.
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    fits = F.forall(x, lambda c: F.abs(c.cast("double") * SCALE) <= LARGEST)
    large = F.raise_error(F.lit(f"a component times {SCALE} is beyond {LARGEST}"))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("int"))
    return vectors.where(x.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("-")).alias("label"),
        F.when(fits, whole).otherwise(large.cast("array<int>")).alias("v"),
    )


def first_codebooks(rows: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> np.ndarray:
    """(part, entry, position): the parts of the vectors with the smallest ids, in order, null ids last.

    At most ``entries`` rows come to the driver.
    """
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    width = len(first[0][0]) if first else 0
    return np.array([r[0] for r in first], dtype=np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries, exact."""
    if not x.size or int(np.abs(x).max()) < 2**22 and int(np.abs(entries).max()) < 2**22:
        # Every product and sum is an integer below 2**53, so doubles hold it exactly.
        a, b = x.astype(np.float64), entries.astype(np.float64)
        out = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return out.astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)


def full_search(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its distance; of equal distances the lower index."""
    d = _distances(x, book)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def active_search(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, entry: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As ``full_search``, from the assignment to the book before some of its entries moved.

    Where the assigned entry stayed, its distance is still right and no other entry that stayed can be nearer,
    so only moved entries are compared with it. All other rows look at the whole book.
    """
    entry, distance = entry.copy(), distance.copy()
    at = np.flatnonzero(moved)
    if not len(at):
        return entry, distance
    gone = moved[entry]
    if gone.any():
        entry[gone], distance[gone] = full_search(x[gone], book)
    stay = np.flatnonzero(~gone)
    if len(stay):
        near, d = full_search(x[stay], book[at])
        index = at[near]
        better = (d < distance[stay]) | ((d == distance[stay]) & (index < entry[stay]))
        entry[stay[better]], distance[stay[better]] = index[better], d[better]
    return entry, distance


def _assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """``rows`` with new ``entry`` and ``distance``, one of each a part; ``moved`` is None in the first round."""
    parts, _, width = books.shape

    def column(batch: pa.RecordBatch, name: str, per_row: int) -> np.ndarray:
        return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, per_row).astype(np.int64)

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                v = column(batch, "v", parts * width)
                known = moved is not None and (column(batch, "entry", parts), column(batch, "distance", parts))
                entry, distance = (np.empty((len(v), parts), dtype=np.int64) for _ in range(2))
                for p in range(parts):
                    x = v[:, p * width : (p + 1) * width]
                    if known:
                        found = active_search(x, books[p], moved[p], known[0][:, p], known[1][:, p])
                    else:
                        found = full_search(x, books[p])
                    entry[:, p], distance[:, p] = found
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), batch.column("v"),
                     lists(entry, pa.int32()), lists(distance, pa.int64())],
                    names=["vec_id", "label", "v", "entry", "distance"],
                )

    schema = "vec_id long, label string, v array<int>, entry array<int>, distance array<long>"
    return rows.mapInArrow(run, schema)


def _sums(assigned: DataFrame, parts: int, entries: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, entry): how many parts are assigned, and the sums of their components.

    Each task sums what it reads, so at most ``parts * entries`` rows a task are shuffled and come out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width), dtype=np.int64)
        count = np.zeros(parts * entries, dtype=np.int64)
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)
            entry = batch.column("entry").flatten().to_numpy(zero_copy_only=False).reshape(-1, parts)
            cell = (entry + np.arange(parts) * entries).ravel()
            np.add.at(total, cell, v)
            count += np.bincount(cell, minlength=parts * entries)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), *(pa.array(total[used, i]) for i in range(width))],
            names=["cell", "count", *(f"s{i}" for i in range(width))],
        )

    names = [f"s{i}" for i in range(width)]
    schema = ", ".join(["cell long, count long", *(f"{n} long" for n in names)])
    cells = assigned.select("v", "entry").mapInArrow(run, schema)
    # Decimals, since the sums of very many rows leave the range of a long.
    added = cells.groupBy("cell").agg(F.sum("count"), *(F.sum(F.col(n).cast("decimal(20,0)")) for n in names))
    counts = np.zeros(parts * entries, dtype=object)
    totals = np.zeros((parts * entries, width), dtype=object)
    for row in added.collect():
        counts[row[0]], totals[row[0]] = int(row[1]), [int(x) for x in row[2:]]
    return counts.reshape(parts, entries), totals.reshape(parts, entries, width)


def trained_codes(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scratch: Scratch | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, v, entry, distance`` of every kept vector, and the codebooks (part, entry, position).

    Components become integers and vectors ``parts`` equal consecutive parts. Each part position's codebook starts
    with the ``entries`` smallest ids and goes through ``rounds`` of Lloyd's algorithm in whole numbers: nearest
    entry by squared distance, of equal ones the lower index; then every used entry becomes the floor of the mean
    of its parts. A last assignment follows. From the second assignment on only moved entries are compared where
    the assigned one stayed, against the stored exact distance.

    Rows whose vector is null or holds null or non-finite components are left out. So are vectors of another length
    than the one with the smallest id: they have no distance to its parts. A length that ``parts`` does not divide,
    and components beyond 2**18, end the query with an error. Of rows with equal ids the smaller
    vector comes first; null ids come last. With fewer rows than ``entries`` the codebooks are shorter. An
    empty table gives no rows and empty codebooks; other columns are ignored.

    Between rounds the vectors are kept with their assignment; a round's table is dropped when the next is complete.
    Only codebooks and their sums, of fixed size, pass through the driver.
    """
    scratch = scratch or Scratch(vectors.sparkSession)
    rows, path = scratch.keep_at(scaled(vectors, vector, vec_id, label))
    found = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v")).first()
    size = found[0] if found else 0
    if size % parts:
        raise ValueError(f"{size} components can't be cut into {parts} equal parts")
    rows = rows.where(F.size("v") == size)
    books = first_codebooks(rows, entries, parts)
    entries, width = books.shape[1:]
    if not entries or not width:
        empty = F.array_repeat(F.lit(0).cast("long"), parts)
        return rows.withColumns({"entry": empty.cast("array<int>"), "distance": empty}), books
    moved = None
    for n in range(rounds + 1):
        rows, new = scratch.keep_at(_assigned(rows, books, moved))
        scratch.drop(path)
        path = new
        if n == rounds:
            break
        counts, totals = _sums(rows, parts, entries, width)
        used = counts > 0
        fresh = books.copy()
        fresh[used] = (totals[used] // counts[used][:, None]).astype(np.int64)
        moved = (fresh != books).any(axis=2)
        books = fresh
    return rows, books


def codebooks_text(books: np.ndarray) -> str:
    """All entries' components in decimal, by part, entry and position."""
    return ",".join(map(str, books.ravel().tolist()))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def vector_codes(vectors: DataFrame, scratch: Scratch | None = None, **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that ``trained_codes`` keeps.

    code: two hex digits a part; error: squared distances summed over the parts; label_error: error summed
    over rows of the same label, nulls together. Errors are summed before the shuffle, and rows of a common label are
    spread when they meet its sum.
    """
    scratch = scratch or Scratch(vectors.sparkSession)
    rows, books = trained_codes(vectors, scratch=scratch, **options)
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    digits = F.transform("entry", lambda e: F.lower(F.lpad(F.hex(e), 2, "0")))
    coded = rows.select("vec_id", "label", F.array_join(digits, "").alias("code"), _sum(F.col("distance")).alias("error"))
    by_label = scratch.keep(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")))
    return spread_lookup(coded, by_label, "label", "n").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
