"""MinHash near-dedup by min-max hashing.

A document's set is that of its distinct word shingles, as 64-bit hashes.  Under
each of ``PERMUTATIONS`` permutations both the smallest and the largest element
are kept, so that one evaluation gives two values of the signature, and two
documents agree on either with the Jaccard similarity as probability; the two
are negatively correlated, which lowers the estimate's variance.  Minima and
maxima are banded apart, ``ROWS`` values to a band: at a similarity of 0.8 a
pair shares no band with probability (1 - 0.8**6)**48 < 5e-7.

Documents of one set are one class, and only classes are compared:

1. In every bucket (the classes of one band value) the smallest class is the
   pivot; each class is compared with its pivots, full set against full set.
2. In buckets that then still hold classes of several components beside the
   pivot, the others are compared too, block against block, each task giving a
   spanning forest of the links that it finds.

So every pair in a bucket is either compared in full or already connected, no
pairs of a group are written, and a large bucket is dealt out in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ratecraft.llm.common import short_batches, stage, table, utf8
from ratecraft.llm.components import components

SHINGLE = 2
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
PERMUTATIONS = 144
ROWS = 6
SEED = 42
#: Set elements in a block of a large bucket, about.
BLOCK = 1 << 18

_SLICE_BYTES = 1 << 20
_SLICE_ELEMENTS = 1 << 11
_SPACE = b" \t\n\v\f\r"


# Sets and signatures ------------------------------------------------------------


def _word_slices(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    start = 0
    while start < len(raw):
        end = min(len(raw), start + _SLICE_BYTES)
        while end < len(raw) and raw[end] not in _SPACE:
            end += 1
        yield raw[start:end].split()
        start = end


def shingle_set(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct word shingles.

    Words are runs of bytes other than space and \\t to \\r, with A-Z in lower
    case.  Fewer words than a shingle are one shingle; no words give an empty set.
    """
    digest = xxhash.xxh3_64_intdigest
    sets, tail = [], np.empty(0, dtype=np.uint64)
    for words in _word_slices(utf8(text).lower()):
        known = {w: digest(w, seed) for w in set(words)}
        tail = np.concatenate((tail, np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))))
        if len(tail) >= shingle:
            sets.append(np.unique(_mixed(tail, shingle)))
            tail = tail[len(tail) - shingle + 1:]
    if not sets:
        return _mixed(tail, len(tail)) if len(tail) else tail
    return sets[0] if len(sets) == 1 else np.unique(np.concatenate(sets))


def _mixed(words: np.ndarray, shingle: int) -> np.ndarray:
    """One hash for each run of ``shingle`` words, from the hashes of the words in order."""
    n = len(words) - shingle + 1
    h = np.full(n, shingle, dtype=np.uint64)
    for k in range(shingle):
        h = (h ^ words[k: k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def permutations(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and shifts of x -> a * (x ^ c) modulo 2**64, a bijection each."""
    rng = np.random.Generator(np.random.PCG64(seed))
    draws = rng.integers(0, 1 << 64, size=(2, n), dtype=np.uint64)
    return draws[0] | np.uint64(1), draws[1]


def signature(elements: np.ndarray, a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of a set that is not empty under every permutation."""
    low, high = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64), np.zeros(len(a), dtype=np.uint64)
    for at in range(0, len(elements), _SLICE_ELEMENTS):
        part = elements[at: at + _SLICE_ELEMENTS]
        values = (part[None, :] ^ c[:, None]) * a[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band: the bands of minima, then those of maxima."""
    bands = np.concatenate((low, high)).reshape(-1, rows)
    return _mixed_rows(bands) ^ (np.arange(len(bands), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _mixed_rows(bands: np.ndarray) -> np.ndarray:
    h = np.zeros(len(bands), dtype=np.uint64)
    for k in range(bands.shape[1]):
        h = (h ^ bands[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def _signed(shingle: int, seed: int, permuted: int, rows: int, key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c = permutations(permuted, seed)
        for batch in batches:
            digests, sizes, keys = [], [], []
            for text in batch.column("text"):
                elements = shingle_set(text.as_py(), shingle, seed)
                sizes.append(len(elements))
                digests.append(xxhash.xxh3_128_digest(elements.tobytes()))
                keys.append(band_keys(*signature(elements, a, c), rows).view(np.int64) if len(elements) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").cast(key_type), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["key", "digest", "n", "bands"])

    return run


def _sets(shingle: int, seed: int):
    """``(digest, elements)`` of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), shingle, seed).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(f) for f in found], pa.binary()), pa.array(found, pa.binary())],
                                             names=["digest", "elements"])

    return run


# Comparisons ----------------------------------------------------------------------


def links_of(probes: list[int], sets: list[np.ndarray], component: list[int], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``probes`` and all members, by full sets.

    Members are numbered; those of one ``component`` are connected already and
    are not compared with each other.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    root = np.unique(np.array(component), return_inverse=True)[1]
    held = np.zeros(len(values), dtype=np.int64)
    out = []
    for p in probes:
        if (root == root[p]).all():
            continue
        own = flat[starts[p]: starts[p] + sizes[p]]
        held[own] = 1
        common = np.add.reduceat(held[flat], starts)
        held[own] = 0
        near = (100 * common >= percent * (sizes + sizes[p] - common)) & (root != root[p])
        for q in np.flatnonzero(near).tolist():
            if root[q] != root[p]:
                out.append((p, q))
                root[root == root[q]] = root[p]
    return out


_LINK = "u long, v long"


def _compare(percent: int):
    """Groups of rows ``(g1, g2, g3, probe, c, component, elements)``, together and
    in order, to the links that the probes of each group have."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        first: dict[int, tuple] = {}
        for row in rows:  # a class may stand on both sides
            if row[1] not in first or row[0]:
                first[row[1]] = row
        members = list(first.values())
        sets = [np.frombuffer(m[3], dtype=np.uint64) for m in members]
        probes = [i for i, m in enumerate(members) if m[0]]
        return [(members[i][1], members[j][1]) for i, j in links_of(probes, sets, [m[2] for m in members], percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []

        def emit() -> pa.RecordBatch:
            u, v = (list(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            names = list(zip(*[batch.column(g).to_pylist() for g in ("g1", "g2", "g3")]))
            body = zip(*[batch.column(c).to_pylist() for c in ("probe", "c", "component", "elements")])
            for name, row in zip(names, body):
                if name != group:
                    out += links(rows) if len(rows) > 1 else []
                    group, rows = name, []
                rows.append(row)
            if len(out) > 1 << 16:
                yield emit()
                out = []
        out += links(rows) if len(rows) > 1 else []
        if out:
            yield emit()

    return run


def _compared(rows: DataFrame, percent: int, name: str) -> DataFrame:
    dealt = rows.select("g1", "g2", "g3", "probe", "c", "component", "elements").repartition("g1", "g2", "g3").sortWithinPartitions("g1", "g2", "g3")
    return stage(dealt.mapInArrow(_compare(percent), _LINK), name)


def _parts(elements):
    return F.greatest(F.lit(1), F.ceil(elements / F.lit(float(BLOCK)))).cast("int")


def _part_of(c: str, parts: str):
    return F.pmod(F.xxhash64(c, F.lit(SEED)), F.col(parts)).cast("int")


def _with_pivots(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes and the pivots of their buckets; many classes of one pivot are dealt out in parts."""
    fits = 100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")  # no smaller set can reach the similarity
    pairs = stage(shared.where(F.col("c") != F.col("pivot")).where(fits).select("c", "n", "pivot").distinct(), "minmax-pairs")
    parts = pairs.groupBy("pivot").agg(_parts(F.sum("n")).alias("parts"))
    others = (pairs.join(parts, "pivot").join(sets, "c")
              .select(F.col("pivot").alias("g1"), _part_of("c", "parts").alias("g2"), F.lit(0).alias("g3"), F.lit(False).alias("probe"), "c", F.col("c").alias("component"), "elements"))
    pivots = (parts.join(sets, F.col("pivot") == F.col("c")).withColumn("g2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select(F.col("pivot").alias("g1"), "g2", F.lit(0).alias("g3"), F.lit(True).alias("probe"), "c", F.col("c").alias("component"), "elements"))
    return _compared(others.unionByName(pivots), percent, "minmax-pivot-links")


def _beside_pivots(shared: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links in buckets that hold several components beside their pivot; None without such buckets."""
    known = roots.select(F.col("node"), "root")
    rest = (shared.where(F.col("c") != F.col("pivot")).select("bucket", "c", "n")
            .join(known, F.col("c") == F.col("node"), "left").select("bucket", "c", "n", F.coalesce("root", "c").alias("component")))
    open_buckets = stage(rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("n").alias("total"))
                         .where("lo != hi").select("bucket", _parts(F.col("total")).alias("parts")), "minmax-open")
    if not open_buckets.count():
        return None
    members = stage(rest.join(open_buckets, "bucket").withColumn("part", _part_of("c", "parts")), "minmax-members")
    other = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = other.select(F.col("bucket").alias("g1"), F.least("part", "other").alias("g2"), F.greatest("part", "other").alias("g3"),
                        (F.col("part") <= F.col("other")).alias("probe"), "c", "component")
    return _compared(rows.join(sets, "c"), percent, "minmax-links")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                    permuted: int = PERMUTATIONS, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row.

    Rows are linked if their shingle sets have 100 * intersection >= percent *
    union; ``component_id`` is the smallest key of the rows reachable.  Null and
    wordless texts have an empty set, are linked with nothing and are their own
    component.  Repeated rows are kept; null keys are passed over as long as
    their component has another key.  An empty input gives an empty result, and
    other columns do not take part.  Long texts are cut into words by slices.
    """
    if 2 * permuted % rows or permuted % rows:
        raise ValueError("bands of minima and maxima need a multiple of rows as permutations")
    short_batches(df.sparkSession)
    texts = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = texts.schema["key"].dataType
    signed = stage(texts.mapInArrow(_signed(shingle, seed, permuted, rows, to_arrow_type(kind)),
                                    f"key {kind.simpleString()}, digest binary, n long, bands array<long>"), "minmax-signed")
    grouped = signed.where("n > 0").groupBy("digest").agg(F.min("key").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stage(grouped.withColumn("c", F.monotonically_increasing_id()), "minmax-classes")

    members = classes.select(F.explode("bands").alias("bucket"), "c", "n")
    least = F.min(F.struct("c", "n"))
    buckets = stage(members.groupBy("bucket").agg(least.alias("p"), F.count(F.lit(1)).alias("m")).where("m > 1")
                    .select("bucket", F.col("p.c").alias("pivot"), F.col("p.n").alias("pivot_n")), "minmax-buckets")
    shared = stage(members.join(buckets, "bucket"), "minmax-shared")

    needed = stage(shared.select("c").distinct().join(classes.select("c", "digest"), "c"), "minmax-needed")
    holders = stage(signed.join(needed.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.min("key").alias("holder"))
                    .select("holder").distinct(), "minmax-holders")
    elements = texts.join(holders, F.col("key").eqNullSafe(F.col("holder")), "left_semi").select("text").mapInArrow(_sets(shingle, seed), "digest binary, elements binary")
    sets = stage(needed.join(elements.dropDuplicates(["digest"]), "digest").select("c", "elements"), "minmax-sets")

    first = _with_pivots(shared, sets, percent)
    roots = stage(components(first), "minmax-roots")
    more = _beside_pivots(shared, roots, sets, percent)
    if more is not None:
        roots = stage(components(first.unionByName(more)), "minmax-roots")

    rooted = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").select("digest", "least", F.coalesce("root", "c").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = stage(rooted.join(named, "root").select("digest", "component_id"), "minmax-labels")
    full = signed.where("n > 0").select("key", "digest", "n").join(labels, "digest").select("key", F.col("n").alias("n_shingles"), "component_id")
    empty = signed.where("n = 0").select("key", F.col("n").alias("n_shingles"), F.col("key").alias("component_id"))
    return full.unionByName(empty).withColumnRenamed("key", key)


def one_per_group(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``near_duplicates`` with ``kept``: whether the row's key leads its component (false without a key)."""
    groups = near_duplicates(df, key, text, **options)
    return groups.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, near-duplicate component and leader mark of every document."""
    out = one_per_group(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def oracle_sql() -> str:
    """The same by the exact intersections of all pairs that share a shingle."""
    return r"""WITH RECURSIVE words AS MATERIALIZED (
SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
FROM documents),
sets AS MATERIALIZED (
SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
       ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
FROM words),
classes AS MATERIALIZED (SELECT min(doc_id) AS c, s FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
elements AS MATERIALIZED (SELECT c, unnest(s) AS e FROM classes),
links AS MATERIALIZED (
SELECT p.u, p.v FROM (SELECT a.c AS u, b.c AS v, count(*) AS k FROM elements a JOIN elements b ON a.e = b.e AND a.c <> b.c GROUP BY a.c, b.c) p
JOIN classes x ON x.c = p.u JOIN classes y ON y.c = p.v WHERE 100 * k >= 80 * (len(x.s) + len(y.s) - k)),
reach AS (SELECT c AS u, c AS v FROM classes UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
component AS (SELECT u AS c, min(v) AS component_id FROM reach GROUP BY u)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id,
       coalesce(coalesce(k.component_id, d.doc_id) = d.doc_id, false) AS kept
FROM sets d LEFT JOIN classes x ON x.s = list_sort(d.s) LEFT JOIN component k ON k.c = x.c"""
