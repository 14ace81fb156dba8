"""Best-fit packing of token pieces into sequences by bin completion.

Documents become pieces of at most ``SEQUENCE`` tokens.  Piece lengths are
whole numbers up to that bound, so the packing problem of any number of pieces
is one histogram of at most ``SEQUENCE`` counts: that, and nothing else, is
solved on the driver.  The solver branches over the fillings of a sequence: it
takes the largest length left, enumerates the undominated fillings of the space
beside it, least waste first, uses one for as many sequences as the counts allow
(or for a single one), and goes on with the lengths left; it steps back where the
waste so far, or a lower bound of what is left, allows no fewer sequences than
the incumbent has.  Incumbents are plain best fit decreasing, then the plan that
takes the least waste each time.  A plan is a list of patterns, each for a run of
sequences.  It is ``proven`` where it meets the lower bound or the search ended
by itself; a search that used up its steps says so by ``proven = False``.

The pieces are then numbered within their length by partition counts, and a
piece's number leads to its pattern, sequence and place.  The pieces themselves are
not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import offsets_by_partition, partition_counts, short_batches, stage, table

SEQUENCE = 1024
END = 2
#: Steps of one branch-and-bound search for the filling of least waste.
NODES = 4000
#: Steps of the search over sequences in all, and of the fillings of one of them; a plan says whether they sufficed.
SEARCH, FILLINGS = 400_000, 4000
#: Latin letters, digits, punctuation and signs up to here are split alike by both tokenizer libraries.
_PLAIN_TO = "ɏ"

_BATCH_BYTES = 2 << 20


# Tokens ----------------------------------------------------------------------


class _Encoder:
    """Ids of byte-level BPE: by the faster library over the same vocabulary
    where a text holds only characters up to U+024F, else by ``tokenizers``."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        import re

        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.other = re.compile(f"[^\0-{_PLAIN_TO}]")
        self.fast = None
        if ranks:
            import base64

            import tiktoken
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or self.other.search(text) or any(s in text for s in self.special):
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def public_vocabulary() -> dict[str, str]:
    """The vocabulary files of the installed public tokenizers."""
    import public_tokenizers
    return {"vocabulary": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all of ``most`` tokens, but the first may be shorter."""
    first = n % most or min(n, most)
    return [(0, first)] + [(s, most) for s in range(first, n, most)] if n else []


_PIECES = "key long, piece int, start long, length int, ids binary, part int, nth long"


_encoders: dict[tuple, _Encoder] = {}


def _encoder(files: dict) -> _Encoder:
    """One encoder for each process and vocabulary: its tables are large."""
    name = tuple(sorted(files.items(), key=str))
    if name not in _encoders:
        _encoders[name] = _Encoder(**files)
    return _encoders[name]


def _tokenize(files: dict, most: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        seen = np.zeros(most + 1, dtype=np.int64)
        encoder = _encoder(files)

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "piece", "start", "length", "ids", "part", "nth"])

        rows, size = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, ids = key.as_py(), np.array(encoder(text.as_py() or "") + [end], dtype="<u4")
                for piece, (start, length) in enumerate(cut(len(ids), most)):
                    rows.append((key, piece, start, length, ids[start: start + length].tobytes(), part, int(seen[length])))
                    seen[length] += 1
                    size += 4 * length
                if size > _BATCH_BYTES:
                    yield emit(rows)
                    rows, size = [], 0
        if rows:
            yield emit(rows)

    return run


def token_pieces(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = SEQUENCE, end: int = END, files: dict | None = None) -> DataFrame:
    """Pieces of every row's tokens and end token, as a written table:
    ``key, piece, start, length, ids`` (little-endian unsigned 32-bit), and
    ``part, nth``, the piece's number within its length and writing partition.
    """
    short_batches(df.sparkSession)
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return stage(rows.mapInArrow(_tokenize(files or public_vocabulary(), most, end), _PIECES), "pieces")


# Bin completion over the histogram of lengths ---------------------------------


@dataclass
class Plan:
    """``runs``: (sequences, the lengths in each, largest first); ``proven``: no plan has fewer."""

    runs: list[tuple[int, tuple[int, ...]]] = field(default_factory=list)
    proven: bool = False

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.runs)


def _best_fit(room: int, sizes: list[int], counts: dict[int, int]) -> tuple[int, ...]:
    """The filling that always takes the largest length that still fits."""
    out: list[int] = []
    for size in sizes:
        if size > room:
            continue
        take = min(room // size, counts[size])
        out += [size] * take
        room -= size * take
        if not room:
            break
    return tuple(out)


def _completion(room: int, sizes: list[int], counts: dict[int, int], nodes: int) -> tuple[int, ...]:
    """The undominated filling of least waste.

    Lengths are tried from the largest down.  A branch is cut when what is left
    of the lengths cannot reach below the incumbent's waste, or when no length
    left fits; a filling to which another length would fit is dominated and is
    never a leaf, as the search always goes on to the next length that fits.  The
    incumbent is the best-fit filling, and ties go to fewer, larger lengths.
    """
    best = _best_fit(room, sizes, counts)
    waste = room - sum(best)
    if not waste:
        return best
    present = [s for s in sizes if s <= room]
    total_after = np.cumsum([s * counts[s] for s in reversed(present)])[::-1].tolist() + [0]
    steps = 0
    exact = {s: i for i, s in enumerate(present)}

    def search(at: int, left: int, chosen: list[int]) -> None:
        nonlocal best, waste, steps
        steps += 1
        if steps > nodes or not waste:
            return
        while at < len(present) and present[at] > left:
            at += 1
        if at == len(present):
            if left < waste:
                best, waste = tuple(chosen), left
            return
        if left - total_after[at] >= waste:
            return  # even all that is left wastes no less
        if left in exact and exact[left] >= at:  # one length fills it: nothing can beat that
            best, waste = tuple(chosen + [left]), 0
            return
        for i in range(at, len(present)):
            size = present[i]
            if left - total_after[i] >= waste or steps > nodes or not waste:
                return
            fits = min(counts[size], left // size)
            for take in range(fits, 0, -1):
                search(i + 1, left - size * take, chosen + [size] * take)
                if not waste:
                    return

    search(0, room, [])
    return best


def least_sequences(counts: np.ndarray) -> int:
    """A lower bound for pieces of which ``counts[length]`` have each length up to the capacity.

    For any a: pieces over capacity - a share a sequence with none of length a or
    more; those over half the capacity have one each, which leaves known room for
    the pieces from a to half.
    """
    capacity = len(counts) - 1
    half = capacity // 2
    size = np.arange(capacity + 1)
    upto, room = np.cumsum(counts), np.cumsum(counts * (capacity - size))
    tokens = np.cumsum(counts * size)
    a = np.arange(half + 1)
    over = upto[capacity] - upto[half]
    left = room[capacity - a] - room[half]
    small = tokens[half] - np.where(a > 0, tokens[np.maximum(a, 1) - 1], 0)
    return int(over + np.maximum(0, -((left - small) // capacity)).max())


def _fillings(room: int, sizes: list[int], counts: dict[int, int], waste: int, steps: int) -> tuple[list[tuple[int, ...]], bool]:
    """The undominated fillings of ``room`` that waste no more than ``waste``, least
    waste first; and whether the steps sufficed for all of them.

    A filling is dominated if a length left over fits beside it, or in the place
    of a smaller one of its own.
    """
    present = [s for s in sizes if s <= room]
    total_after = np.cumsum([s * counts[s] for s in reversed(present)])[::-1].tolist() + [0]
    out: list[tuple[int, tuple[int, ...]]] = []
    spent = 0

    def dominated(chosen: list[int], left: int) -> bool:
        used = {s: chosen.count(s) for s in chosen}
        free = [s for s in present if counts[s] > used.get(s, 0)]
        if not free:
            return False
        return free[-1] <= left or any(s < c <= s + left for s in used for c in free)

    def walk(at: int, left: int, chosen: list[int]) -> None:
        nonlocal spent
        spent += 1
        if spent > steps or left - total_after[at] > waste:
            return
        if left <= waste and not dominated(chosen, left):
            out.append((left, tuple(chosen)))
        for i in range(at, len(present)):
            size = present[i]
            if left - total_after[i] > waste or spent > steps:
                return
            for take in range(min(counts[size], left // size), 0, -1):
                walk(i + 1, left - size * take, chosen + [size] * take)

    walk(0, room, [])
    out.sort(key=lambda f: (f[0], len(f[1]), tuple(-s for s in f[1])))
    return [f for _, f in out], spent <= steps


def _branch(histogram: dict[int, int], capacity: int, best: Plan, bound: int, search: int, fillings: int) -> Plan:
    """The best plan of a depth-first search over whole sequences, ``best`` the first incumbent.

    Every step places sequences of one filling around the largest length left.
    A set of lengths that was left before, with as few sequences, is not searched again.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    tokens = int((counts * np.arange(capacity + 1)).sum())
    whole, spent, seen = True, 0, {}
    path: list[tuple[int, tuple[int, ...]]] = []

    def children(counts: np.ndarray, wasted: int) -> Iterator[tuple[int, tuple[int, ...]]]:
        nonlocal whole, spent
        sizes = np.flatnonzero(counts)[::-1].tolist()
        first = sizes[0]
        left = {s: int(counts[s]) for s in sizes}
        left[first] -= 1
        allowed = (best.sequences - 1) * capacity - tokens - wasted
        found, all_found = _fillings(capacity - first, [s for s in sizes if left[s]], left, min(allowed, capacity - first), fillings)
        whole &= all_found
        spent += fillings if not all_found else 1 + len(found)
        if not all_found:  # the filling of least waste is among them in any case
            found = list(dict.fromkeys([_completion(capacity - first, [s for s in sizes if left[s]], left, fillings), *found]))
        for rest in found:
            pattern = (first, *rest)
            waste = capacity - sum(pattern)
            most = min(int(counts[s]) // pattern.count(s) for s in set(pattern))
            if waste:
                most = min(most, ((best.sequences - 1) * capacity - tokens - wasted) // waste)
            for times in dict.fromkeys((most, 1)):
                if 0 < times <= most:
                    yield times, pattern

    frames = [(children(counts, 0), counts, 0, 0)]
    while frames:
        options, counts, used, wasted = frames[-1]
        step = next(options, None)
        if step is None:
            frames.pop()
            if path:
                path.pop()
            continue
        spent += 1
        if spent > search:
            return Plan(best.runs, best.sequences <= bound)
        times, pattern = step
        after = counts.copy()
        for s in pattern:
            after[s] -= times
        now, waste = used + times, wasted + times * (capacity - sum(pattern))
        if not after.any():
            if now < best.sequences:
                best = Plan([*path, step])
                if now <= bound:
                    break
            continue
        if now + least_sequences(after) >= best.sequences:
            continue
        key = hashlib.blake2b(after.tobytes(), digest_size=16).digest()
        if seen.get(key, now + 1) <= now:
            continue
        seen[key] = now
        path.append(step)
        frames.append((children(after, waste), after, now, waste))
    return Plan(best.runs, whole or best.sequences <= bound)


def bin_completion(histogram: dict[int, int], capacity: int, nodes: int = NODES, search: int = SEARCH, fillings: int = FILLINGS) -> Plan:
    """A packing of ``{length: count}`` into as few sequences as the search finds; ``proven`` if there is no smaller one."""
    histogram = {s: n for s, n in histogram.items() if n > 0}
    if any(s < 1 or s > capacity for s in histogram):
        raise ValueError("a length does not fit")
    if not histogram:
        return Plan(proven=True)
    bound = least_sequences(np.array([histogram.get(s, 0) for s in range(capacity + 1)], dtype=np.int64))
    best = _fill(histogram, capacity, lambda room, sizes, counts: _best_fit(room, sizes, counts))
    if best.sequences > bound:
        least = _fill(histogram, capacity, lambda room, sizes, counts: _completion(room, sizes, counts, nodes))
        best = min(least, best, key=lambda p: p.sequences)
    if best.sequences > bound:
        return _branch(histogram, capacity, best, bound, search, fillings)
    return Plan(best.runs, True)


def _fill(histogram: dict[int, int], capacity: int, completion) -> Plan:
    counts = {s: n for s, n in histogram.items() if n > 0}
    plan = Plan()
    while counts:
        sizes = sorted(counts, reverse=True)
        first = sizes[0]
        counts[first] -= 1
        pattern = (first, *completion(capacity - first, [s for s in sizes if counts[s]], counts))
        counts[first] += 1
        used = {s: pattern.count(s) for s in set(pattern)}
        times = min(counts[s] // n for s, n in used.items())
        for s, n in used.items():
            counts[s] -= n * times
            if not counts[s]:
                del counts[s]
        plan.runs.append((times, pattern))
    return plan


def _slots(plan: Plan) -> list[tuple]:
    """(length, first number, numbers, first sequence, sequences, place): the pieces
    of one length from the first number on fill one place in a run of sequences."""
    taken: dict[int, int] = {}
    out, base = [], 0
    for times, pattern in plan.runs:
        place = 0
        for size in pattern:
            start = taken.get(size, 0)
            out.append((size, start, times, base, place))
            taken[size] = start + times
            place += size
        base += times
    return out


def _place(slots: list[tuple]):
    by_size: dict[int, tuple[np.ndarray, ...]] = {}
    for size in {s[0] for s in slots}:
        rows = sorted(s[1:] for s in slots if s[0] == size)
        by_size[size] = tuple(np.array(c, dtype=np.int64) for c in zip(*rows))

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for length, number in batches:
            sequence, place = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            sizes, numbers = length.to_numpy(), number.to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                start, _, base, offset = by_size[int(size)]
                i = np.searchsorted(start, numbers[at], side="right") - 1
                sequence[at] = base[i] + numbers[at] - start[i]
                place[at] = offset[i]
            yield pd.DataFrame({"sequence_id": sequence, "offset": place})

    return run


def pack(pieces: DataFrame, capacity: int = SEQUENCE, nodes: int = NODES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, and on every row ``proven``: whether
    it is proven that no packing has fewer sequences.

    Needs ``length`` (1 to ``capacity``), ``part`` and ``nth`` of a written
    table; other columns are carried along.  The histogram and the patterns are
    bounded by the capacity, not by the number of pieces.
    """
    counts = partition_counts(pieces, "length", "part")
    rows = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most ``capacity`` rows
    plan = bin_completion({int(r["length"]): int(r["n"]) for r in rows}, capacity, nodes)
    placed = F.pandas_udf(_place(_slots(plan)), "sequence_id long, offset long")
    numbered = offsets_by_partition(pieces, counts, "length", "part", "nth")
    return (numbered.withColumn("_at", placed(F.col("length").cast("long"), F.col("position")))
            .withColumn("sequence_id", F.col("_at.sequence_id")).withColumn("offset", F.col("_at.offset"))
            .withColumn("proven", F.lit(plan.proven)).drop("_at", "position", "part", "nth"))


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = SEQUENCE, end: int = END, files: dict | None = None) -> DataFrame:
    """``(key, piece, start, length, ids, sequence_id, offset, proven)`` for every piece of every row.

    Null texts are empty: a piece of the end token alone.  Documents over the
    capacity are cut into full pieces, of which the first may be shorter; no
    other is cut.  Repeated rows and rows with a null key are packed like any
    other, other columns do not take part, and no row gives no piece.
    """
    return pack(token_pieces(df, key, text, capacity, end, files), capacity).withColumnRenamed("key", key)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    pieces = token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(digests).select(F.col("key").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"),
                                "ids_crc32", "sequence_id", "offset", "proven")
