"""SimHash near-dedup with a bit-sliced comparison.

A text's fingerprint is the majority vote of the 64-bit hashes of its word
shingles.  Equal fingerprints collapse first, so that a group of copies is one
row from then on.  Two fingerprints within the radius agree on one of
``BLOCKS`` blocks of bits and, over the rest, on one of ``BLOCKS`` blocks again;
each fingerprint goes to the bucket of every such pair of blocks, and so no link
is missed.  Inside a bucket the distances are taken bit-sliced: bit planes are
stored vertically, one word of a plane holds one bit of 64 comparisons, and
carry-save counters add plane after plane, until the radius is exceeded
everywhere in a block.  A bucket gives a spanning forest of its links, never all
pairs, and the components of the forests' union are the near-duplicate groups.

A bucket of more than ``BLOCK`` fingerprints is not compared in one task: its
rows pass through in blocks, and a second job compares pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import CARRIED, carried, short_batches, stage, table, utf8
from ratecraft.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Blocks of bits a fingerprint is cut into; must exceed the radius.
BLOCKS = 4
#: Fingerprints of a bucket that one task compares with each other.
BLOCK = 4096

_SLICE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash; zero where the text is null or has no word.

    Words are runs of bytes other than space and \\t to \\r, with A-Z in lower
    case.  A text of fewer words than a shingle has its whole word sequence as
    its only shingle.
    """
    words = utf8(text).lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return int(xxhash.xxh64_intdigest(line, seed))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    last = ends[shingle - 1:] - 1
    first = np.concatenate(([0], ends[: len(words) - shingle]))
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for a in range(0, len(first), _SLICE):
        pairs = zip(first[a: a + _SLICE].tolist(), last[a: a + _SLICE].tolist())
        hashes = np.array([digest(line[x:y], seed) for x, y in pairs], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(first), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``df`` with ``fingerprint``, the 64 bits as a signed long."""
    short_batches(df.sparkSession)

    @F.pandas_udf("long")
    def simhash(series: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in series.tolist()], dtype=np.uint64).view(np.int64))

    return df.withColumn("fingerprint", simhash(F.col(text)))


# Bit-sliced comparison ------------------------------------------------------


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit values: row b has bit b of every value, 64 values a word (padded by zeros)."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    room = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, room)))).view("<u8")


class _Counter:
    """Carry-save counters of many comparisons; ``over`` has a bit once a count exceeds the radius.

    The counters start so far below their overflow that the carry out of the
    top bit means just that.
    """

    def __init__(self, shape: tuple[int, ...], radius: int):
        width = max(1, (radius + 1).bit_length() if (radius + 1) & radius else radius.bit_length())
        start = (1 << width) - 1 - radius
        full, none = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
        self.bits = [np.full(shape, full if start >> k & 1 else none, dtype=np.uint64) for k in range(width)]
        self.over = np.zeros(shape, dtype=np.uint64)

    def add(self, plane: np.ndarray) -> None:
        carry = plane
        for k, bit in enumerate(self.bits):
            self.bits[k], carry = bit ^ carry, bit & carry
        self.over |= carry

    def keep(self, rows: np.ndarray) -> None:
        self.bits = [b[rows] for b in self.bits]
        self.over = self.over[rows]


def _near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether a[i] and b[i] differ in ``radius`` bits or fewer."""
    near = np.empty(len(a), dtype=bool)
    for at in range(0, len(a), 1 << 16):
        part = a[at: at + (1 << 16)] ^ b[at: at + (1 << 16)]
        planes = _planes(part)
        count = _Counter(planes.shape[1:], radius)
        for k in range(64):
            count.add(planes[k])
            if k % 8 == 7 and not (~count.over).any():
                break
        near[at: at + (1 << 16)] = np.unpackbits(count.over.view(np.uint8), bitorder="little")[: len(part)] == 0
    return near


def _near_blocks(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The (i, j) with left[i] and right[j] within the radius, of one block of queries after the other."""
    planes, found_i, found_j = _planes(right), [], []
    masks = np.array([0, 0xFFFFFFFFFFFFFFFF], dtype=np.uint64)
    size = max(16, (1 << 16) // max(1, planes.shape[1]))
    for at in range(0, len(left), size):
        active = np.arange(at, min(at + size, len(left)))
        count = _Counter((len(active), planes.shape[1]), radius)
        for k in range(64):
            bit = (left[active] >> np.uint64(k)) & np.uint64(1)
            count.add(planes[k][None, :] ^ masks[bit.astype(np.intp)][:, None])
            if k % 8 == 7:
                open_rows = (~count.over).any(axis=1)
                if not open_rows.all():
                    active = active[open_rows]
                    count.keep(open_rows)
                if not len(active):
                    break
        if len(active):
            near = np.unpackbits(count.over.view(np.uint8).reshape(len(active), -1), axis=1, bitorder="little")[:, : len(right)] == 0
            i, j = np.nonzero(near)
            found_i.append(active[i])
            found_j.append(j)
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The root (smallest index reachable) of each of n nodes."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
    return root


def _stars(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    root = _forest(len(values), i, j)
    at = np.flatnonzero(root != np.arange(len(values)))
    return values[at], values[root[at]]


def _shifted_pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs inside groups, one shift at a time: each member with the one s places on."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    for shift in range(1, int(sizes.max(initial=1))):
        live = sizes > shift
        count = (sizes[live] - shift)
        first = np.repeat(starts[live], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        yield first, first + shift


def _compare(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the groups [start, start + size) of ``values``."""
    small = (sizes > 1) & (sizes <= 64)
    found_i, found_j = [], []
    if small.any():
        for i, j in _shifted_pairs(starts[small], sizes[small]):
            near = _near_pairs(values[i], values[j], radius)
            found_i.append(i[near])
            found_j.append(j[near])
    for start, size in zip(starts[sizes > 64], sizes[sizes > 64]):
        block = values[start: start + size]
        for at in range(0, size, 512):
            i, j = _near_blocks(block[at: at + 512], block, radius)
            i = i + at
            i, j = i[i < j], j[i < j]
            root = _forest(int(size), i, j)  # a forest for each block of queries, not all links
            kept = np.flatnonzero(root != np.arange(size))
            found_i.append(kept + start)
            found_j.append(root[kept] + start)
    if not found_i:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return _stars(values, np.concatenate(found_i), np.concatenate(found_j))


_LINKS = "kind int, bucket long, part int, u long, v long"


def _rows(kind: int, bucket, part, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    n = len(u)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), pa.array(np.broadcast_to(np.asarray(bucket, np.int64), n)),
         pa.array(np.broadcast_to(np.asarray(part, np.int32), n)), pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
        names=["kind", "bucket", "part", "u", "v"])


def _buckets(radius: int, block: int):
    """Links inside the buckets of a partition sorted by bucket; a bucket over
    ``block`` rows leaves as rows of kind 1, with its block's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, big, passed = np.empty(0, np.int64), np.empty(0, np.uint64), None, 0

        def finish(keys, values):
            edge = np.flatnonzero(np.diff(keys)) + 1
            starts = np.concatenate(([0], edge)) if len(keys) else np.empty(0, np.int64)
            u, v = _compare(values, starts, np.diff(np.append(starts, len(keys))), radius)
            if len(u):
                yield _rows(0, 0, 0, u, v)

        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy(zero_copy_only=False)))
            values = np.concatenate((values, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if big is not None:
                end = int(np.searchsorted(keys, big, side="right")) if keys[0] == big else 0
                if end:
                    yield _rows(1, big, (passed + np.arange(end)) // block, values[:end], values[:end])
                    passed += end
                    keys, values = keys[end:], values[end:]
                if len(keys):
                    big, passed = None, 0
                else:
                    continue
            last = int(np.searchsorted(keys, keys[-1], side="left"))
            if last:
                yield from finish(keys[:last], values[:last])
                keys, values = keys[last:], values[last:]
            if len(keys) > block:
                big, passed = int(keys[0]), len(keys)
                yield _rows(1, big, np.arange(len(keys)) // block, values, values)
                keys, values = keys[:0], values[:0]
        yield from finish(keys, values)

    return run


def _block_pairs(radius: int):
    """Links between two blocks of a large bucket (or inside one)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf.loc[pdf["side"] == 0, "u"].to_numpy().view(np.uint64)
        right = pdf.loc[pdf["side"] == 1, "u"].to_numpy().view(np.uint64)
        if not len(left) or not len(right):  # a block with itself
            values = np.concatenate((left, right))
            u, v = _compare(values, np.array([0]), np.array([len(values)]), radius)
        else:
            values = np.concatenate((left, right))
            found_i, found_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for at in range(0, len(left), 512):
                i, j = _near_blocks(left[at: at + 512], right, radius)
                root = _forest(len(values), i + at, j + len(left))
                kept = np.flatnonzero(root != np.arange(len(values)))
                found_i.append(kept)
                found_j.append(root[kept])
            u, v = _stars(values, np.concatenate(found_i), np.concatenate(found_j))
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return run


def _bucket_keys(fp: str, radius: int) -> list:
    """Keys of the buckets of a fingerprint: a block of 16 bits, then a quarter of the 48 others."""
    if radius >= BLOCKS:
        raise ValueError(f"the radius must be under {BLOCKS}")
    keys = []
    for a in range(BLOCKS):
        first = F.shiftrightunsigned(F.col(fp), 16 * a).bitwiseAND(F.lit(0xFFFF))
        low = F.col(fp).bitwiseAND(F.lit((1 << 16 * a) - 1)) if a else F.lit(0).cast("long")
        high = F.shiftleft(F.shiftrightunsigned(F.col(fp), 16 * (a + 1)), 16 * a) if a < 3 else F.lit(0).cast("long")
        rest = low.bitwiseOR(high)  # the other 48 bits
        for b in range(BLOCKS):
            second = F.shiftrightunsigned(rest, 12 * b).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((a * BLOCKS + b) << 28).bitwiseOR(F.shiftleft(first, 12)).bitwiseOR(second))
    return keys


def links(fingerprints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of all links within the radius.

    ``fingerprints`` has the column ``fingerprint``, each value once.
    """
    keyed = fingerprints.select("fingerprint", F.explode(F.array(*_bucket_keys("fingerprint", radius))).alias("bucket"))
    ordered = keyed.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "fingerprint")
    first = stage(ordered.mapInArrow(_buckets(radius, block), _LINKS), "simhash-links")
    near = first.where("kind = 0").select("u", "v")
    large = first.where("kind = 1").select("bucket", "part", "u")
    counts = large.groupBy("bucket").agg((F.max("part") + 1).alias("parts"))
    with_counts = large.join(counts, "bucket")
    other = with_counts.select("bucket", "part", "u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    pairs = other.select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                         F.when(F.col("part") <= F.col("other"), 0).otherwise(1).alias("side"), "u")
    more = pairs.groupBy("bucket", "i", "j").applyInPandas(_block_pairs(radius), "u long, v long")
    return near.unionByName(more)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """``(key, fingerprint, component_id)`` for every row.

    ``component_id`` is the smallest key of the rows reachable by links of
    ``radius`` differing bits or fewer.  Null and wordless texts have
    fingerprint zero and are linked like any other.  Repeated rows are kept;
    null keys are passed over as long as their component has another key.  An
    empty input gives an empty result, and other columns do not take part.
    """
    prints = stage(with_fingerprint(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", shingle, seed).drop("text"), "simhash")
    classes = stage(prints.groupBy("fingerprint").agg(F.min("key").alias("least")), "simhash-classes")
    roots = components(links(classes.select("fingerprint"), radius))
    rooted = classes.join(roots, classes.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(named, "root").select(F.col("fingerprint").alias("_f"), "component_id")
    return prints.join(labels, prints.fingerprint == F.col("_f")).select(F.col("key").alias(key), "fingerprint", "component_id")


_ATOMS = ("string", "int", "bigint", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "binary")


def one_per_group(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``df`` for each near-duplicate group: that of the smallest key.

    Rows are told apart by key, text and other plain columns, so that a key
    that repeats loses only the rows whose text is in a group with another
    leader.  Of rows equal in all of that one stays; rows of one key in one
    group leave one, the first by a hash of the others.  Null keys come last.
    An empty input gives an empty result; all columns of ``df`` are kept.
    """
    groups = near_duplicates(df, key, text, shingle, radius).select("fingerprint", F.col("component_id").alias("group")).distinct()
    own, kept = carried(df, [])
    plain = [F.col("`" + c.replace("`", "``") + "`") for c, kind in df.dtypes if kind in _ATOMS]
    mark = F.concat(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.hex(F.xxhash64(*plain)))
    rows = with_fingerprint(df.select(F.col(key).alias("key"), mark.alias("mark"), F.col(text).alias("text")), "text", shingle).drop("text")
    groups = groups.withColumnRenamed("fingerprint", "f")
    seen = stage(rows.groupBy("key", "mark", "fingerprint").agg(F.count(F.lit(1)).alias("n"))
                 .join(groups, F.col("fingerprint") == F.col("f")).select("key", "mark", "n", "f", "group"), "simhash-rows")
    # rows without any key share a null group by fingerprint
    name = F.struct(F.col("group"), F.when(F.col("group").isNull(), F.col("f")).alias("f"))
    order = F.struct(F.col("key").isNull().alias("last"), "key", "mark")
    first = seen.groupBy(name.alias("name")).agg(F.min(order).alias("first"))
    first = first.select(F.col("first.key").alias("k1"), F.col("first.mark").alias("m1")).distinct()
    marked = seen.join(first, F.col("key").eqNullSafe(F.col("k1")) & (F.col("mark") == F.col("m1")), "left")
    lost = marked.where("m1 is null").select("key", "mark", F.lit(False).alias("repeated"))
    fate = stage(lost.unionByName(marked.where("m1 is not null and n > 1").select("key", "mark", F.lit(True).alias("repeated"))).distinct(), "simhash-fate")
    fate = fate.select(F.col("key").alias("k1"), F.col("mark").alias("m1"), "repeated")
    out = df.select(own, F.col(key).alias("key"), mark.alias("mark")).join(fate, F.col("key").eqNullSafe(F.col("k1")) & (F.col("mark") == F.col("m1")), "left")
    once = out.where("repeated is null").select(CARRIED)
    twice = out.where("repeated").groupBy("mark", "key").agg(F.first(CARRIED).alias(CARRIED)).select(CARRIED)
    return once.unionByName(twice).select(*kept)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
