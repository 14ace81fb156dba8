"""Vector code compression: product codes by active-entry Lloyd.

A vector is cut into equal consecutive parts, and every part position has a
codebook of at most ``ENTRIES`` integer entries.  A round assigns each part to
its nearest entry and moves each entry to the mean of its parts.  The state of
a part is the index of its entry and the exact squared distance to it.  In later
rounds a part whose entry stayed fixed compares only the entries that moved with
its stored distance: no other entry can have come nearer.  A part whose entry
moved looks at all entries again.  Both ways give the smaller index on ties.

Vectors travel as packed blocks, one row for up to ``BLOCK_ROWS`` vectors.  What
tasks return to the driver is a codebook's worth of sums: entries x dimensions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import stage, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors in a packed block at most, and numbers in it at most.
BLOCK_ROWS, BLOCK_NUMBERS = 4096, 1 << 18
#: Labels whose sums are joined by broadcast; more are joined by a shuffle.
SMALL_LABELS = 500_000

_BLOCK = "n int, dim int, ids binary, null_ids binary, labels binary, null_labels binary, v binary, code binary, dist binary"
_SUMS = "place int, entry int, n long, s array<long>"
_CODES = "vec_id long, label long, code string, error long"


@dataclass
class Codebooks:
    """``entries``: int64, (parts, entries, numbers in a part)."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)`` of the rows that take part: vector not null, of
    finite components only; each component x as floor(scale * x)."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("v"))
    return (rows.where("v is not null").where(finite)
            .withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double"))))


def _require_shape(rows: DataFrame, parts: int) -> int:
    """The vectors' length: 0 without vectors, an error unless it is one for all and a
    multiple of ``parts``, with components for which squared distances are exact."""
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    seen = rows.agg(F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi"), F.max(largest).alias("top")).first()
    if seen["lo"] is None:
        return 0
    if seen["lo"] != seen["hi"] or seen["hi"] == 0 or seen["hi"] % parts:
        raise ValueError(f"vectors of {seen['lo']} to {seen['hi']} components do not cut into {parts} equal parts")
    room = (2 * float(seen["top"]) + 1) ** 2 * seen["hi"]
    if room >= 2.0 ** 62:
        raise ValueError(f"components up to {seen['top']:.3g} are too large for exact distances")
    return int(seen["hi"])


def _pack(dim: int):
    most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                ids, labels = part.column(0), part.column(1)
                v = part.column(2).flatten().to_numpy(zero_copy_only=False).astype("<i8")
                row = [[part.num_rows], [dim], [_packed(ids)], [_nulls(ids)], [_packed(labels)], [_nulls(labels)], [v.tobytes()], [b""], [b""]]
                yield _row(row)

    return run


def _packed(column: pa.Array) -> bytes:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()


def _nulls(column: pa.Array) -> bytes:
    return np.packbits(column.is_null().to_numpy(zero_copy_only=False)).tobytes()


def _row(values: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 7
    names = [field.split()[0] for field in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)


# Distances ------------------------------------------------------------------


def nearest_entries(x: np.ndarray, entries: np.ndarray, index: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the nearest of ``entries`` (smaller index on ties)
    and its squared distance, exact in 64-bit integers; ``index`` names the entries."""
    best = np.zeros(len(x), dtype=np.int64)
    dist = np.full(len(x), np.iinfo(np.int64).max)
    for i, entry in zip(range(len(entries)) if index is None else index.tolist(), entries):
        gap = x - entry
        d = np.einsum("ij,ij->i", gap, gap)
        nearer = d < dist
        best[nearer] = i
        dist[nearer] = d[nearer]
    return best, dist


def reassign(x: np.ndarray, best: np.ndarray, dist: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The assignment after the entries marked ``moved`` changed.

    Rows whose own entry stayed fixed compare only the moved entries with their
    stored distance; the others rescan all entries.
    """
    if not moved.any():
        return best, dist
    best, dist = best.copy(), dist.copy()
    lost = moved[best]
    if lost.any():
        best[lost], dist[lost] = nearest_entries(x[lost], entries)
    kept = np.flatnonzero(~lost)
    if len(kept):
        active = np.flatnonzero(moved)
        near, d = nearest_entries(x[kept], entries[active], active)
        better = (d < dist[kept]) | ((d == dist[kept]) & (near < best[kept]))
        best[kept[better]], dist[kept[better]] = near[better], d[better]
    return best, dist


def _assign(books: np.ndarray, moved: np.ndarray | None):
    """Blocks with new codes and distances; ``moved`` is None in the first round."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["v"], dtype="<i8").reshape(row["n"], parts, width)
                code = np.empty((row["n"], parts), dtype=np.uint8)
                dist = np.empty((row["n"], parts), dtype=np.int64)
                if moved is not None:
                    old = np.frombuffer(row["code"], dtype=np.uint8).reshape(row["n"], parts)
                    far = np.frombuffer(row["dist"], dtype="<i8").reshape(row["n"], parts)
                for p in range(parts):
                    x = np.ascontiguousarray(v[:, p])
                    if moved is None:
                        code[:, p], dist[:, p] = nearest_entries(x, books[p])
                    else:
                        code[:, p], dist[:, p] = reassign(x, old[:, p].astype(np.int64), far[:, p], books[p], moved[p])
                row["code"], row["dist"] = code.tobytes(), dist.astype("<i8").tobytes()
                yield _row([[value] for value in row.values()])

    return run


def _sums(parts: int, entries: int, width: int):
    """Count and sum of the parts of every entry, once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["v"], dtype="<i8").reshape(row["n"], parts, width)
                code = np.frombuffer(row["code"], dtype=np.uint8).reshape(row["n"], parts)
                for p in range(parts):
                    count[p] += np.bincount(code[:, p], minlength=entries)
                    np.add.at(total[p], code[:, p], v[:, p])
        place, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[place, entry]),
             pa.array(total[place, entry].tolist(), pa.list_(pa.int64()))], names=["place", "entry", "n", "s"])

    return run


def _moved_books(blocks: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks after a round, and which entries changed; the sums collected are one codebook's worth."""
    parts, entries, width = books.shape
    rows = (blocks.mapInArrow(_sums(parts, entries, width), _SUMS).groupBy("place", "entry")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s")).collect())
    new = books.copy()
    for r in rows:
        new[r["place"], r["entry"]] = [s // r["n"] for s in r["s"]]
    return new, (new != books).any(axis=2)


def _codes(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                def column(name: str) -> pa.Array:
                    mask = np.unpackbits(np.frombuffer(row[f"null_{name}"], dtype=np.uint8), count=row["n"]).astype(bool)
                    return pa.array(np.frombuffer(row[name], dtype="<i8"), mask=mask)
                text = row["code"].hex()
                codes = [text[at: at + 2 * parts] for at in range(0, len(text), 2 * parts)]
                error = np.frombuffer(row["dist"], dtype="<i8").reshape(row["n"], parts).sum(axis=1)
                yield pa.RecordBatch.from_arrays([column("ids"), column("labels"), pa.array(codes, pa.string()), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    return run


def first_books(vectors: DataFrame, parts: int, entries: int, dim: int) -> np.ndarray:
    """Entry i of every part: that part of the i-th smallest vec_id (of repeated
    ids, the smaller vector first; null ids last)."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()  # entries x dimensions
    seeds = np.array([r["v"] for r in rows]).astype(np.int64).reshape(len(rows), parts, dim // parts)
    return np.ascontiguousarray(seeds.transpose(1, 0, 2))


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """``(vec_id, label, code, error)`` of every vector that takes part, and the final codebooks.

    ``code`` holds two hex digits for each part, ``error`` the squared distances
    summed.  Null vectors and vectors with null or non-finite components take no
    part; null ids and labels do.  Repeated rows are coded one by one.  Fewer
    rows than ``entries`` give as many entries.  An empty input gives no rows and
    no codebooks.  Vectors of several lengths, of a length that ``parts`` does
    not divide, or too large for exact 64-bit distances are an error.  Other
    columns do not take part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: from 1 to 256 entries")
    vectors = integer_vectors(df, key, vector, label, scale)
    dim = _require_shape(vectors, parts)
    if not dim:
        return df.sparkSession.createDataFrame([], _CODES), None
    books = first_books(vectors, parts, entries, dim)
    blocks, moved = vectors.mapInArrow(_pack(dim), _BLOCK), None
    for _ in range(rounds):
        blocks = stage(blocks.mapInArrow(_assign(books, moved), _BLOCK), "codes")
        books, moved = _moved_books(blocks, books)
    coded = stage(blocks.mapInArrow(_assign(books, moved), _BLOCK).mapInArrow(_codes(parts), _CODES), "codes")
    return coded, Codebooks(books)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels, null labels together."""
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "same")
    return coded.join(F.broadcast(sums) if sums.count() <= SMALL_LABELS else sums, F.col("label").eqNullSafe(F.col("same"))).drop("same")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all ``embeddings``."""
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(books.sha256 if books else None).cast("string").alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same by full scans of every entry in each round."""
    ctes = [f"""kept AS MATERIALIZED (
SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
       list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""cells AS MATERIALIZED (
SELECT row, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
FROM kept CROSS JOIN (SELECT unnest(range({parts})) AS p))""",
            f"book0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS y FROM cells WHERE row <= {entries})"]
    distance = "list_sum(list_transform(list_zip(c.x, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(rounds + 1):
        ctes.append(f"""near{r} AS MATERIALIZED (
SELECT row, p, min(k).e AS e, CAST(min(k).d AS BIGINT) AS d
FROM (SELECT c.row, c.p, {{'d': CAST({distance} AS BIGINT), 'e': b.e}} AS k FROM cells c JOIN book{r} b ON b.p = c.p) GROUP BY row, p)""")
        if r < rounds:
            ctes.append(f"""mean{r} AS (
SELECT p, e, list(m ORDER BY k) AS y FROM (
  SELECT p, e, k, CAST(floor(sum(x[k]) / count(*)) AS BIGINT) AS m
  FROM (SELECT n.p, n.e, c.x, unnest(range(1, len(c.x) + 1)) AS k FROM near{r} n JOIN cells c ON c.row = n.row AND c.p = n.p) GROUP BY p, e, k)
GROUP BY p, e)""")
            ctes.append(f"""book{r + 1} AS MATERIALIZED (
SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e)""")
    last = f"near{rounds}"
    ctes.append(f"""coded AS (
SELECT row, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM {last} GROUP BY row)""")
    ctes.append(f"""sha AS (
SELECT sha256(string_agg(s, ',' ORDER BY p, e)) AS h FROM (SELECT p, e, array_to_string(y, ',') AS s FROM book{rounds}))""")
    return "WITH " + ",\n".join(ctes) + """
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT h FROM sha) AS codebooks_sha256
FROM kept k JOIN coded c ON c.row = k.row"""
