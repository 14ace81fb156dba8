"""Repeated byte strings across documents, by blocks of suffixes and a cover sample.

Two suffixes count as tied when their first ``LENGTH`` bytes agree.  All suffixes
to that depth would be one row a byte, so they are classed block by block with
the help of a small cover sample:

1. Cover sample.  The sample position of a suffix is the smallest hash among the
   ``ANCHOR``-byte strings in its first ``LENGTH`` bytes.  It depends on those
   bytes alone, so tied suffixes have their sample at the same distance: the
   property a difference cover has for any two suffixes, held here for the tied
   ones with one position in about 70 instead of one in 11.  The suffixes that
   share a sample position are neighbours and form a unit.
2. Sample ranks.  Units are bucketed by the string at their sample position.  A
   bucket of one is done: its suffixes are tied to none.
3. Long ties.  The units of a bucket whose whole text agrees are tied suffix by
   suffix, which settles nearly all repeats with one row a unit.
4. Of what is left, one representative for each distinct unit of a bucket that
   holds several, the suffixes are taken in blocks of ``BLOCK`` by their distance
   to the sample.  The bytes that all suffixes of a block have in common are its
   core; a block whose core no other unit has is tied to none, a block that is
   the same in another unit is tied as a whole, and only the suffixes of the
   rest are compared by their first ``LENGTH`` bytes, one row each.

All of it is grouping and joining on 64-bit keys, with partial sums for hot
strings; a string counts as equal when its sample string and its own hash both
agree.  The texts themselves are shuffled for step 4 and for the removal only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import carried, chunks, release_shuffles, short_batches, stage, table, utf8

LENGTH = 200
ANCHOR = 64
BLOCK = 16

#: Bytes looked at together; longer texts go through in overlapping parts.
_SPAN = 1 << 19
_POSITION = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Hasher:
    """Hashes of any substring of a buffer from prefix sums modulo 2^64."""

    def __init__(self):
        rng = np.random.default_rng(9)
        self.letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        n = _SPAN + 4 * LENGTH + 1
        self.power = self._powers(_BASE, n)
        self.inverse = self._powers(_INVERSE, n)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letters[data] * self.power[: len(data)], out=out[1:])
        return out

    def hashed(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((prefix[end] - prefix[start]) * self.inverse[start])

    def all_of(self, prefix: np.ndarray, length: int) -> np.ndarray:
        return _mixed((prefix[length:] - prefix[:-length]) * self.inverse[: len(prefix) - length])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def _parts(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about ``_SPAN`` bytes: the bytes; per text in it its index, where
    it starts in the buffer, and which byte of the text that is."""
    short = [i for i, t in enumerate(texts) if length <= len(t) <= _SPAN]
    for a, b in chunks([len(texts[i]) for i in short], _SPAN):
        held = [texts[i] for i in short[a:b]]
        starts = np.cumsum([0] + [len(t) for t in held])
        yield b"".join(held), np.array(short[a:b]), starts, np.zeros(b - a, np.int64)
    for i, t in enumerate(texts):
        if len(t) > _SPAN:
            for at in range(0, len(t) - length + 1, _SPAN):
                part = t[at: at + _SPAN + length - 1]
                yield part, np.array([i]), np.array([0, len(part)]), np.array([at])


def _units_of(data: bytes, starts: np.ndarray, hasher: _Hasher, length: int, anchor: int):
    """Units of a buffer: text number, first suffix, suffixes, hash at the sample, hash of the unit, distance to the sample."""
    raw = np.frombuffer(data, dtype=np.uint8)
    prefix = hasher.prefix(raw)
    at_anchor = hasher.all_of(prefix, anchor)
    ranked = (at_anchor & ~_POSITION) | np.arange(len(at_anchor), dtype=np.uint64)
    sample = (_sliding_min(ranked, length - anchor + 1) & _POSITION).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(sample)]
    inside = np.arange(len(sample)) + length <= starts[1:][text]
    change = (sample[1:] != sample[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
    first = np.concatenate(([0], np.flatnonzero(change) + 1))
    last = np.append(first[1:], len(sample)) - 1
    good = inside[first]
    first, last = first[good], last[good]
    return text[first], first, last - first + 1, at_anchor[sample[first]], hasher.hashed(prefix, first, last + length), sample[first] - first


_hasher: list[_Hasher] = []


def _get_hasher() -> _Hasher:
    if not _hasher:
        _hasher.append(_Hasher())
    return _hasher[0]


_UNITS = "a long, u long, h long, h2 long, s long, n int, o int"


def _units(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _get_hasher()
        for batch in batches:
            h, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = [utf8(t) for t in batch.column(2).to_pylist()]
            for data, which, starts, base in _parts(texts, length):
                text, first, many, a, u, o = _units_of(data, starts, hasher, length, anchor)
                if len(text):
                    own = which[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.view(np.int64)), pa.array(u.view(np.int64)), pa.array(h[own]), pa.array(h2[own]),
                         pa.array(first - starts[text] + base[text]), pa.array(many.astype(np.int32)), pa.array(o.astype(np.int32))], names=["a", "u", "h", "h2", "s", "n", "o"])

    return run


_BLOCKS = "a long, b int, core long, whole long, u long, h long, h2 long, s long, single boolean, w array<long>"


def _blocks(length: int, block: int):
    """The blocks of suffixes of the units listed with each text: the hash of the
    block's core and of its whole text, and for each suffix that of its first ``length`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _get_hasher()
        for batch in batches:
            for row in batch.to_pylist():
                raw = utf8(row["text"])
                units = sorted(row["units"], key=lambda x: x["s"])
                for a, b in chunks([x["n"] for x in units], 1 << 15):
                    part = units[a:b]
                    while part:  # units that lie in one span of the text
                        base = part[0]["s"]
                        near = [x for x in part if x["s"] + x["n"] + length <= base + _SPAN]
                        part = part[len(near):]
                        prefix = hasher.prefix(np.frombuffer(raw[base: base + _SPAN], dtype=np.uint8))
                        many = np.array([x["n"] for x in near])
                        unit = np.repeat(np.arange(len(near)), many)
                        start = np.array([x["s"] - base for x in near])
                        sample = start + np.array([x["o"] for x in near])
                        suffix = np.arange(many.sum()) + (start - np.cumsum(many) + many)[unit]
                        place = (sample[unit] - suffix) // block
                        change = np.concatenate(([True], (unit[1:] != unit[:-1]) | (place[1:] != place[:-1])))
                        first = np.flatnonzero(change)
                        last = np.append(first[1:], len(suffix)) - 1
                        own, at = unit[first], place[first]
                        edge = sample[own] - block * at  # the last suffix a block can have
                        core = hasher.hashed(prefix, edge, edge - (block - 1) + length)
                        whole = hasher.hashed(prefix, suffix[first], suffix[last] + length)
                        w = hasher.hashed(prefix, suffix, suffix + length)
                        of = lambda name, kind: pa.array(np.array([x[name] for x in near])[own].astype(kind))
                        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(suffix)).astype(np.int32)), pa.array(w.view(np.int64)))
                        size = len(first)
                        yield pa.RecordBatch.from_arrays(
                            [of("a", np.int64), pa.array(at.astype(np.int32)), pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), of("u", np.int64),
                             pa.array(np.full(size, row["h"])), pa.array(np.full(size, row["h2"])), pa.array(suffix[first] + base), of("single", bool), lists],
                            names=["a", "b", "core", "whole", "u", "h", "h2", "s", "single", "w"])

    return run


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with the key of their text: equal texts have equal spans, so spans belong to texts, not rows."""
    raw = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(key).alias("k"), raw.alias("text")).select("k", "text", F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("h2"))


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(h, h2, spans)`` for each text with a repeat: its xxhash64 and crc32, and the
    ``(s, e)`` byte ranges of the strings of ``length`` bytes that start elsewhere too.

    The ranges cover all such strings; they may overlap and are in no order.
    """
    if not BLOCK < anchor <= length:
        raise ValueError(f"the anchor must be longer than {BLOCK} bytes, and no longer than the length")
    spark = df.sparkSession
    short_batches(spark)
    keyed = _keyed(df, key, text)
    texts = keyed.where(F.octet_length("text") >= length)
    units = texts.select("h", "h2", "text").mapInArrow(_units(length, anchor), _UNITS)
    buckets = units.groupBy("a").agg(F.count(F.lit(1)).alias("m"), F.min("u").alias("lo"), F.max("u").alias("hi")).where("m > 1")
    buckets = stage(buckets.select(F.col("a").alias("a0"), (F.col("lo") != F.col("hi")).alias("mixed")), "repeat-buckets")
    release_shuffles(spark)
    hits = stage(units.join(buckets, F.col("a") == F.col("a0")).drop("a0"), "repeat-units")
    release_shuffles(spark)
    mixed = hits.where("mixed")
    classes = mixed.groupBy("a", "u").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("h", "h2", "s", "n", "o")).alias("first"))
    classes = stage(classes, "repeat-classes")
    tied = mixed.join(classes.where("m > 1").select("a", "u"), ["a", "u"], "left_semi")
    settled = hits.where("not mixed").unionByName(tied).select("h", "h2", "s", (F.col("s") + F.col("n") - 1 + length).alias("e"))
    listed = classes.select("a", "u", (F.col("m") == 1).alias("single"), "first.*").groupBy("h", "h2").agg(
        F.collect_list(F.struct("a", "u", "s", "n", "o", "single")).alias("units"))  # bounded by the text's length
    holders = keyed.groupBy("h", "h2").agg(F.min("k").alias("k"))  # one row stands for all of a text
    asked = listed.join(holders, ["h", "h2"]).select(F.col("h").alias("h_"), F.col("h2").alias("h2_"), F.col("k").alias("k_"), "units")
    one_each = texts.join(asked, (F.col("h") == F.col("h_")) & (F.col("h2") == F.col("h2_")) & F.col("k").eqNullSafe(F.col("k_")))
    blocks = stage(one_each.select("h", "h2", "text", "units").mapInArrow(_blocks(length, BLOCK), _BLOCKS), "repeat-blocks")
    release_shuffles(spark)
    cores = blocks.groupBy("a", "b", "core").agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.min("whole").alias("one"), F.max("whole").alias("other"))
    cores = cores.where("lo != hi").select("a", "b", "core", (F.col("one") == F.col("other")).alias("equal"))
    shared = stage(blocks.join(cores, ["a", "b", "core"]), "repeat-shared")
    last = shared.where("single and equal").select("h", "h2", "s", (F.col("s") + F.size("w") - 1 + length).alias("e"))
    suffixes = shared.where("not equal").select("a", "u", "h", "h2", "s", "single", F.posexplode("w").alias("i", "x"))
    ties = suffixes.groupBy("a", "x").agg(F.min("u").alias("lo"), F.max("u").alias("hi")).where("lo != hi").select("a", "x")
    found = suffixes.where("single").join(ties, ["a", "x"], "left_semi").select("h", "h2", (F.col("s") + F.col("i")).alias("s"), (F.col("s") + F.col("i") + length).alias("e"))
    release_shuffles(spark)
    found = found.unionByName(last)
    return settled.unionByName(found).groupBy("h", "h2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the union of (start, end) ranges."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs shrunk to whole UTF-8 characters."""
    out = []
    for s, e in runs:
        while s < e and raw[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, characters: bool = False) -> DataFrame:
    """``df`` with ``kept`` (binary), ``n_bytes``, ``n_removed`` and ``removed``, the (s, e) runs taken out.

    Every byte covered by a ``length``-byte string that also starts elsewhere,
    in any row or in the same text, is removed; what is left is not judged
    again.  Matches never cross rows.  With ``characters`` a run is shrunk to
    the whole UTF-8 characters in it.  Null texts are empty; repeated rows of
    enough bytes repeat each other; an empty input gives an empty result.
    Columns of ``df`` with a result's name are replaced, all others are kept.
    """
    spans = repeated_spans(df, key, text, length).select(F.col("h").alias("_h"), F.col("h2").alias("_h2"), F.col("spans").alias("_spans"))
    own, cols = carried(df, ["kept", "n_bytes", "n_removed", "removed"])
    rows = df.select(own, F.coalesce(F.col(text), F.lit("")).alias("_raw"))
    rows = rows.withColumn("_th", F.xxhash64("_raw")).withColumn("_tc", F.crc32(F.col("_raw").cast("binary")))
    joined = rows.join(spans, (F.col("_th") == F.col("_h")) & (F.col("_tc") == F.col("_h2")), "left")

    @F.pandas_udf("kept binary, n_bytes long, n_removed long, removed array<struct<s:long,e:long>>")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for t, ranges in zip(texts.tolist(), found.tolist()):
            raw = utf8(t)
            runs = merged((int(x["s"]), int(x["e"])) for x in ranges) if ranges is not None else []
            runs = _whole_characters(raw, runs) if characters else runs
            ends = [0] + [e for _, e in runs]
            kept = b"".join(raw[a:b] for a, b in zip(ends, [s for s, _ in runs] + [len(raw)]))
            out.append((kept, len(raw), len(raw) - len(kept), [{"s": s, "e": e} for s, e in runs]))
        return pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "removed"])

    return joined.withColumn("_cut", cut(F.col("_raw"), F.col("_spans"))).select(*cols, "_cut.*")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that start elsewhere too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
