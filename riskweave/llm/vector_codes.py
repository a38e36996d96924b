"""Vectors as codes of codebook entries, one per part, learned in a few rounds of nearest entries and means.

Whole components make every distance an exact integer. Between rounds a part keeps a lower bound on its
distance to each group of entries, with the round in which it was measured. The codebooks of all rounds
are kept, so a bound is lowered by how far the group's entries really are from where they stood then:
the norm of the sum of their steps, never more than the sum of the norms of the steps. Only groups whose
bound does not exceed the distance to the part's own entry are measured again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskweave.llm.common import discard, stored_at, stored

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
GROUP = 16  # entries that share a bound
_LARGEST = 1 << 28  # components beyond are not coded: their squares would leave 64 bits
_STEP = 4.0  # bounds are kept in quarters, rounded down
_FAR = 1 << 30
_HOT = 1000  # a label with this share of the rows is hot, so there are no more of them

_STATE = pa.schema([
    ("vec_id", pa.int64()), ("label", pa.int64()), ("x", pa.list_(pa.int32())), ("code", pa.binary()),
    ("bounds", pa.list_(pa.int32())), ("stamps", pa.binary()), ("error", pa.int64()), ("measured", pa.int64()),
])
STATE = "vec_id long, label long, x array<int>, code binary, bounds array<int>, stamps binary, error long, measured long"


def whole_components(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """vec_id, label, x: the vectors without missing or non-finite components, scaled and floored.

    x is null where it cannot be cut into equal parts or a component is too large for exact distances.
    """
    bad = lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf"))
    x = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * scale))
    sound = (F.size(vector) % parts == 0) & ~F.exists(F.col(vector), lambda v: F.abs(v.cast("double")) * scale >= _LARGEST)
    kept = vectors.where(F.col(vector).isNotNull() & ~F.exists(F.col(vector), bad))
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.when(sound, x).cast("array<int>").alias("x"),
    )


def first_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """[part, entry, position]: the parts of the smallest vec_ids. Ties are ordered by the vector, null
    ids come last. Vectors of another length than the first are not looked at."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    sound = whole.where("x IS NOT NULL")
    rows = sound.orderBy(*order).limit(entries).collect()
    if not rows:
        return None
    length = len(rows[0]["x"])
    if any(len(r["x"]) != length for r in rows):
        rows = sound.where(F.size("x") == length).orderBy(*order).limit(entries).collect()
    first = np.array([r["x"] for r in rows], np.int64).reshape(len(rows), parts, length // parts)
    return first.transpose(1, 0, 2).copy()


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """[n, w] and [k, w] to exact squared distances [n, k]."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[None, :, j]) ** 2
    return out


class Marks(NamedTuple):
    """What a block of vectors remembers between rounds, by row and part."""

    code: np.ndarray  # [n, parts]
    bounds: np.ndarray  # [n, parts, groups], in quarters
    stamps: np.ndarray  # [n, parts, groups], the round a bound was measured in


def no_marks(n: int, parts: int, groups: int) -> Marks:
    return Marks(np.zeros((n, parts), np.int64), np.full((n, parts, groups), -1, np.int64), np.zeros((n, parts, groups), np.int64))


def displacement(history: list[np.ndarray], part: int) -> np.ndarray:
    """[round, group]: the furthest any entry of the group now is from where it stood in that round."""
    now = history[-1][part]
    net = [np.sqrt(((now - then[part]) ** 2).sum(1).astype(np.float64)) for then in history]
    return np.array([[d[g : g + GROUP].max() for g in range(0, len(now), GROUP)] for d in net])


def nearest(x: np.ndarray, history: list[np.ndarray], marks: Marks) -> tuple[Marks, np.ndarray, np.ndarray]:
    """Exact nearest entries (ties to the lower index) of [n, parts, w] under the newest codebooks.

    Returns the new marks, the squared distances [n, parts], and per row how many entries were measured.
    """
    now, entries = len(history) - 1, history[-1].shape[1]
    code, bounds, stamps = (m.copy() for m in marks)
    distance = np.zeros(code.shape, np.int64)
    measured = np.zeros(len(x), np.int64)
    for part in range(code.shape[1]):
        xs, book = x[:, part], history[-1][part]
        own = code[:, part].copy()
        best = ((xs - book[own]) ** 2).sum(1)
        moved = displacement(history, part)
        lower = bounds[:, part] / _STEP - moved[stamps[:, part], np.arange(moved.shape[1])]
        reach = np.sqrt(best.astype(np.float64)) * (1 + 1e-9) + 1e-6
        again = lower <= reach[:, None]
        again[np.arange(len(own)), own // GROUP] |= again.any(1)
        measured += 1
        found = []
        for g in range(moved.shape[1]):
            rows, low = np.flatnonzero(again[:, g]), g * GROUP
            d = squared(xs[rows], book[low : low + GROUP])
            found.append((rows, d))
            if not len(rows):
                continue
            k = d.argmin(1)
            least = d[np.arange(len(rows)), k]
            better = (least < best[rows]) | ((least == best[rows]) & (k + low < code[rows, part]))
            best[rows[better]], code[rows[better], part] = least[better], k[better] + low
            measured[rows] += d.shape[1]
        for g, (rows, d) in enumerate(found):
            if not len(rows):
                continue
            low = g * GROUP
            inside = (code[rows, part] >= low) & (code[rows, part] < min(low + GROUP, entries))
            d[inside, code[rows[inside], part] - low] = np.iinfo(np.int64).max
            others = np.floor(np.sqrt(d.min(1).astype(np.float64)) * (1 - 1e-9) * _STEP)
            bounds[rows, part, g], stamps[rows, part, g] = np.minimum(others, _FAR), now
        distance[:, part] = best
    return Marks(code, bounds, stamps), distance, measured


def _components(batch: pa.RecordBatch, parts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the rows that can be coded, and their components [n, parts, width]."""
    column = batch.column(batch.schema.names.index("x"))
    lengths = np.array(column.value_lengths().fill_null(-1), np.int64)
    places = np.flatnonzero(lengths == parts * width)
    taken = column.take(pa.array(places))
    flat = np.asarray(taken.flatten().to_numpy(zero_copy_only=False), np.int64)
    return places, flat.reshape(len(places), parts, width)


def _spread(places: np.ndarray, n: int, values: list) -> list:
    out: list = [None] * n
    for at, value in zip(places.tolist(), values):
        out[at] = value
    return out


def _round(history: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One round over a block of vectors: the first measures all, later ones use the marks they read."""
    parts, entries, width = history[-1].shape
    groups = -(-entries // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                yield one(whole.slice(at, 4096))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, x = _components(batch, parts, width)
        n, names = len(places), batch.schema.names
        if "code" in names:
            take = lambda name: batch.column(names.index(name)).take(pa.array(places))
            whole = lambda name: np.frombuffer(b"".join(take(name).to_pylist()), np.uint8).astype(np.int64)
            bounds = np.asarray(take("bounds").flatten().to_numpy(zero_copy_only=False), np.int64)
            marks = Marks(whole("code").reshape(n, parts), bounds.reshape(n, parts, groups), whole("stamps").reshape(n, parts, groups))
        else:
            marks = no_marks(n, parts, groups)
        marks, distance, measured = nearest(x, history, marks)
        as_bytes = lambda a: _spread(places, batch.num_rows, [row.tobytes() for row in a.reshape(n, -1).astype(np.uint8)])
        columns = [
            batch.column(names.index("vec_id")), batch.column(names.index("label")), batch.column(names.index("x")).cast(pa.list_(pa.int32())),
            pa.array(as_bytes(marks.code), pa.binary()),
            pa.array(_spread(places, batch.num_rows, list(marks.bounds.reshape(n, -1).astype(np.int32))), pa.list_(pa.int32())),
            pa.array(as_bytes(marks.stamps), pa.binary()),
            pa.array(_spread(places, batch.num_rows, distance.sum(1).tolist()), pa.int64()),
            pa.array(_spread(places, batch.num_rows, measured.tolist()), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_STATE)

    return run


def _sums(parts: int, entries: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task one row for each used entry: how many parts it has and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            places, x = _components(batch, parts, width)
            codes = batch.column(batch.schema.names.index("code")).take(pa.array(places)).to_pylist()
            code = np.frombuffer(b"".join(codes), np.uint8).reshape(len(places), parts)
            for part in range(parts):
                count[part] += np.bincount(code[:, part], minlength=entries)
                np.add.at(total[part], code[:, part], x[:, part])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"],
        )

    return run


def _means(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The next codebooks. The driver gets a row per part and entry, whatever the number of vectors."""
    parts, entries, width = book.shape
    per_task = state.where("code IS NOT NULL").select("x", "code").mapInArrow(
        _sums(parts, entries, width), "part int, entry int, n long, total array<long>"
    )
    sums = [F.sum(F.col("total")[j]).alias(f"_{j}") for j in range(width)]
    out = book.copy()
    for r in per_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        out[r["part"], r["entry"]] = [r[f"_{j}"] // r["n"] for j in range(width)]
    return out


def codebook_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def fitted(
    vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, list[np.ndarray]]:
    """The coded vectors as a stored table, and the codebooks [part, entry, position] of every round.

    Columns: vec_id, label, x, code (a byte per part), error, measured (entries whose distance was
    computed in the last assignment), and the marks. Vectors that are null or hold null or non-finite components are
    dropped. Vectors of another length than the one with the smallest vec_id, of a length that is no multiple of `parts` or
    with components of 2^28 and more after scaling keep their row with a null code and error. Repeated rows are
    coded each; of fewer than `entries` vectors all are entries. No vectors give no rows and no codebooks.

    A round reads the table of the round before and writes its own in the shared folder, which then
    replaces it. Tasks hold one block of rows; the closure holds the codebooks only.
    """
    if not 1 <= entries <= 256 or rounds > 255:
        raise ValueError("codes and stamps are bytes")
    whole = whole_components(vectors, vector, scale, parts)
    book = first_codebooks(whole, parts, entries)
    if book is None:
        return stored(whole.selectExpr("*", "CAST(NULL AS binary) AS code", "CAST(NULL AS long) AS error"), "vector-codes"), []
    history, before = [book], None
    state, path = stored_at(whole.mapInArrow(_round(history), STATE), "vector-codes")
    for _ in range(rounds):
        history.append(_means(state, history[-1]))
        before = path
        state, path = stored_at(state.mapInArrow(_round(history), STATE), "vector-codes")
        discard(state.sparkSession, before)
    return state, history


def _hex(code: Column) -> Column:
    return F.lower(F.hex(code))


def with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` with the errors of its label added up. Labels with a thousandth of all rows or more are at most a
    thousand, so these are broadcast and their rows stay where they are; the others join by label."""
    totals = coded.groupBy("label").agg(F.count("*").alias("_n"), F.coalesce(F.sum("error"), F.lit(0)).alias("label_error"))
    all_rows = coded.count()
    hot = totals.where(F.col("_n") * _HOT >= all_rows).select(F.col("label").alias("_hot"), "label_error")
    cold = totals.where(F.col("_n") * _HOT < all_rows).select(F.col("label").alias("_cold"), F.col("label_error").alias("_cold_error"))
    near = coded.join(F.broadcast(hot.withColumn("_found", F.lit(True))), F.col("label").eqNullSafe(F.col("_hot")), "left").drop("_hot")
    done = near.where("_found").drop("_found")
    rest = near.where("_found IS NULL").drop("_found", "label_error").join(cold, F.col("label").eqNullSafe(F.col("_cold"))).drop("_cold")
    return done.unionByName(rest.withColumnRenamed("_cold_error", "label_error"))


def code_table(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256; `fitted` has the rules."""
    state, history = fitted(vectors, **options)
    digest = codebook_digest(history[-1]) if history else None
    coded = with_label_error(state.select("vec_id", "label", "code", "error"))
    return coded.select("vec_id", _hex(F.col("code")).alias("code"), "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))
