"""Cross-tokenizer alignment by tokenizer spans.

Two tokenizers cut the same bytes in two ways: A, a byte-level BPE of the
``tokenizers`` library, over a space and the text; B, a ``sentencepiece`` model
that puts that space there itself.  The libraries' spans are the coarse cuts:
A's character offsets, and the byte spans that B gives with its pieces (the
installed version has these as an offset mapping and no longer as a proto).  Where a span cannot be
a token's place (several tokens share a multibyte character, or a byte-fallback
piece stands for one byte of it), the decoded bytes of the tokens refine the cuts.

Neither tokenizer merges over a space between two visible characters, so a text
falls apart there into units whose tokens do not depend on what stands around
them; nor do the signs that end a sentence depend on the word before them.
Each new word is tokenized once by a process, many at a time, and a
memo of bounded size holds, for one run, the links and groups of units; a text's are those
of its units, one after the other.

One pass over the documents writes their links and figures, and counts for every
linked pair of ids the documents that hold it: tasks count their own documents
first, and one row for each pair and task is shuffled.  A second pass over the
written links looks their counts up: in a broadcast table while the
number of pairs allows it, else by a join.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ratecraft.llm.common import short_batches, stage, table

#: Pairs of ids whose counts are broadcast (17 bytes each); more are joined.
BROADCAST_PAIRS = 4_000_000
#: Characters that a process's memo of units may hold, and the longest unit in it.
MEMO_CHARACTERS, MEMO_UNIT = 1 << 23, 256
#: Units that go through the tokenizers together.
UNITS = 3000
#: Links that a task holds before it counts them together.
HELD_LINKS = 1 << 20
#: Characters of a text that are aligned at a time.
SLICE = 1 << 18
#: Copies of a pair's count when counts are joined: a hot pair has as many partitions.
SALTS = 32

#: Signs at the end of a unit that are aligned apart from a word before them.
_SIGNS = ".,;:!?"

#: A space between two characters that are white space to neither tokenizer.
_BETWEEN = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_OPEN_EDGE = re.compile(r"[^!-~\w]")

_OWN = ["n_a", "n_b", "n_groups", "n_links"]


def refined_ends(lengths: np.ndarray, span_ends: np.ndarray, span_sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: a coarse cut where the token's span has as many bytes
    as the token, else the end before it and the token's decoded length."""
    decoded = np.cumsum(lengths)
    fits = span_sizes == lengths
    drift = np.where(fits, span_ends - decoded, 0)
    last = np.maximum.accumulate(np.where(fits, np.arange(len(lengths)), -1))
    return decoded + np.where(last >= 0, drift[last], 0)


#: Flags of a segment beside its ids (a << 32 | b): where the A token ends, and where the B token does.
_END_A, _END_B = np.int64(1 << 31), np.int64(1 << 62)
_PAIR = np.int64(~(int(_END_A) | int(_END_B)))


def segments(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two tilings of the same bytes by tokens: their linked pairs with flags, and
    the byte ends of these.  Between two neighbouring cuts of either kind lies
    one token of each: a segment for every linked pair."""
    mark = np.zeros(int(ends_a[-1]) + 1, dtype=np.uint8)
    mark[ends_a] = 1
    mark[ends_b] += 2
    cuts = np.flatnonzero(mark)
    is_a, is_b = (mark[cuts] & 1).astype(np.int64), (mark[cuts] >> 1).astype(np.int64)
    return (a[np.cumsum(is_a) - is_a] << 32) | b[np.cumsum(is_b) - is_b] | is_a * _END_A | is_b * _END_B, cuts


class Aligner:
    """Both tokenizers and the memo of units of one process."""

    def __init__(self, vocabulary: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.last_words: list[str] = []
        self.a_bytes = self._byte_level(self.a)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_lengths = np.array([len(b) for b in self.a_bytes], dtype=np.int64)
        self.b_lengths = np.array([len(b) for b in self.b_bytes], dtype=np.int64)
        numbers = [(str(i), "|") for i in range(len(self.a_bytes))] + [(str(i), ";") for i in range(len(self.b_bytes))]
        self.signs = [number + sign for number, last in numbers for sign in (",", last)]
        self.links: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.broken: set[str] = set()
        self.held = 0
        self.run = ""
        self.tails: dict[str, tuple[bytes, str]] = {}
        # a sign that some piece of B holds behind a letter may be merged with the word before it
        decoded = [b.decode("utf-8", "replace") for b in self.b_bytes]
        merged = {y for piece in decoded for x, y in zip(piece, piece[1:]) if y in _SIGNS and x.isalpha()}
        self.apart = "".join(c for c in _SIGNS if c not in merged)

    def forget(self, run: str) -> None:
        """Start with an empty memo in every run."""
        if run != self.run:
            self.run, self.held = run, 0
            self.links, self.texts, self.broken, self.tails = {}, {}, set(), {}

    @staticmethod
    def _byte_level(tokenizer) -> list[bytes]:
        """Bytes of each id.  A visible Latin-1 character stands for its own byte,
        the other bytes for the characters from U+0100 on, in order."""
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in own}
        byte_of |= {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
        out = [b""] * tokenizer.get_vocab_size()
        special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
        for token, i in tokenizer.get_vocab().items():
            out[i] = special[i] if i in special else bytes(byte_of[c] for c in token)
        return out

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """A's ids, their byte ends, B's ids and theirs over space and ``text``; None
        where the joined bytes of A or of B are others."""
        spaced = " " + text
        raw = spaced.encode("utf-8", "surrogatepass")
        coarse = self.a.encode(spaced, add_special_tokens=False)
        pieces = self.b.encode(text, return_type="offset_mapping", return_bytes=True)
        ids_a, ids_b = coarse.ids, pieces["ids"]
        if b"".join(map(self.a_bytes.__getitem__, ids_a)) != raw or b"".join(map(self.b_bytes.__getitem__, ids_b)) != raw:
            return None
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        chars = np.array(coarse.offsets, dtype=np.int64).reshape(-1, 2)
        if len(raw) > len(spaced):  # characters to bytes
            width = np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            chars = np.concatenate(([0], np.cumsum(1 + (width > 0x7F) + (width > 0x7FF) + (width > 0xFFFF))))[chars]
        spans = np.array(pieces["offsets"], dtype=np.int64).reshape(-1, 2) + 1  # B's own space
        spans[0, 0] = 0  # belongs to the first piece
        return (a, refined_ends(self.a_lengths[a], chars[:, 1], chars[:, 1] - chars[:, 0]),
                b, refined_ends(self.b_lengths[b], spans[:, 1], spans[:, 1] - spans[:, 0]))

    def align_units(self, units: list[str]) -> None:
        """Put the units' segments and groups into the memo; broken are those whose tokens have other bytes."""
        joinable, parts = [], []
        for unit in units:  # the first and last of a text may have other edges
            if _OPEN_EDGE.match(unit[0]) or _OPEN_EDGE.match(unit[-1]):
                parts.append([unit])
            else:
                joinable.append(unit)
        parts += [joinable[at: at + UNITS] for at in range(0, len(joinable), UNITS)]
        for part in parts:
            found = self.spans(" ".join(part))
            if found is None and len(part) > 1:
                for unit in part:
                    self.align_units([unit])
                continue
            if found is None:
                self.broken.add(part[0])
                self.links[part[0]], self.texts[part[0]] = b"", ""
                continue
            a, ends_a, b, ends_b = found
            pairs, cuts = segments(a, ends_a, b, ends_b)
            ends = np.cumsum([1 + len(u.encode("utf-8", "surrogatepass")) for u in part])
            packed, words, count = pairs.tobytes(), self._words(a, ends_a, b, ends_b), np.searchsorted(ends_a, ends) + np.searchsorted(ends_b, ends) + 2
            i = j = 0
            for unit, x, y in zip(part, (8 * (np.searchsorted(cuts, ends) + 1)).tolist(), count.tolist()):
                self.links[unit], self.texts[unit] = packed[i:x], "".join(words[j:y])[:-1]
                i, j = x, y

    def _tail(self, signs: str) -> tuple[bytes, str] | None:
        """Links and groups of signs behind a letter; None where their tokens have other bytes."""
        if signs not in self.tails:
            found = self.spans("a" + signs)
            if found is None:
                return None
            a, ends_a, b, ends_b = found
            pairs, cuts = segments(a, ends_a, b, ends_b)
            tokens = int(np.searchsorted(ends_a, 2) + np.searchsorted(ends_b, 2)) + 2  # those of space and letter
            self.tails[signs] = pairs[np.searchsorted(cuts, 2) + 1:].tobytes(), "".join(self._words(a, ends_a, b, ends_b)[tokens:])[:-1]
        return self.tails[signs]

    def add(self, units: list[str]) -> None:
        """Align units that the memo lacks.  Signs behind a word that ends in a letter are tokens of
        their own, so that only the word need be new."""
        later, fresh = [], []
        for unit in units:
            word = unit.rstrip(self.apart)
            if len(word) < len(unit) and word and word[-1].isalpha() and self._tail(unit[len(word):]):
                later.append((unit, word))
            else:
                fresh.append(unit)
        known = set(fresh)
        words = list(dict.fromkeys(w for _, w in later if w not in self.links and w not in known))
        self.align_units(fresh + words)
        for unit, word in later:
            links, groups = self._tail(unit[len(word):])
            if word in self.broken:
                self.broken.add(unit)
            self.links[unit], self.texts[unit] = self.links[word] + links, f"{self.texts[word]};{groups}"
        self.last_words = words

    def _words(self, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> list[str]:
        """``a1,``, ``a2|``, ``b1;``, ...: the tokens group by group, each with the sign that follows it."""
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        to_a, to_b = np.searchsorted(ends_a, both) + 1, np.searchsorted(ends_b, both) + 1
        size_a, size_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        last_a[to_a - 1] = 1
        last_b[to_b - 1] = 1
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        codes[np.arange(len(a)) + np.repeat(to_b - size_b, size_a)] = 2 * a + last_a
        codes[np.arange(len(b)) + np.repeat(to_a, size_b)] = 2 * (len(self.a_bytes) + b) + last_b
        return list(map(self.signs.__getitem__, codes.tolist()))

    def slices(self, text: str) -> Iterator[tuple[np.ndarray, str] | None]:
        """Slice after slice of a text as its segments and groups; None where it is not whole."""
        for names in _slices(text):
            known, extra = self.links, []
            new = [n for n in set(names) if n not in known]
            if new:
                self.add(new)
                for n in new + self.last_words:
                    if len(n) > MEMO_UNIT or self.held > MEMO_CHARACTERS:
                        extra.append(n)
                    else:
                        self.held += len(n)
            whole = self.broken.isdisjoint(names) if self.broken else True
            found = (np.frombuffer(b"".join(map(known.__getitem__, names)), dtype=np.int64), ";".join(map(self.texts.__getitem__, names))) if whole else None
            for n in extra:
                self.links.pop(n, None)
                self.texts.pop(n, None)
                self.broken.discard(n)
            yield found
            if not whole:
                return


def _slices(text: str) -> Iterator[list[str]]:
    """The units of a text, some at a time; a unit lacks the space before it."""
    start = 0
    while start < len(text):
        cut = _BETWEEN.search(text, start + SLICE) if len(text) - start > SLICE else None
        end = cut.start() if cut else len(text)
        yield _BETWEEN.split(text[start:end])
        start = end + 1 if cut else end


def public_files() -> dict[str, str]:
    """The vocabulary files of the installed public tokenizers."""
    import public_tokenizers
    return {"vocabulary": public_tokenizers.path("byte_bpe_50k.json"), "pieces": public_tokenizers.path("piece_bpe_32k.model")}


_aligners: dict[tuple, Aligner] = {}


def _aligner(files: dict) -> Aligner:
    """One for each process and pair of vocabularies."""
    name = tuple(sorted(files.items()))
    if name not in _aligners:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _aligners[name] = Aligner(**files)
    return _aligners[name]


# Pass one: documents, and documents of each linked pair ----------------------------


class _Counts:
    """Documents of each pair so far: whole arrays held, counted together now and then."""

    def __init__(self):
        self.held, self.size = [], 0
        self.pairs, self.n = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, pairs: np.ndarray) -> None:
        self.held.append(pairs)
        self.size += len(pairs)
        if self.size > HELD_LINKS:
            self.together()

    def together(self) -> None:
        if self.held:
            pairs, n = np.unique(np.concatenate(self.held), return_counts=True)
            every, at = np.unique(np.concatenate((self.pairs, pairs)), return_inverse=True)
            self.n = np.bincount(at, weights=np.concatenate((self.n, n))).astype(np.int64)
            self.pairs, self.held, self.size = every, [], 0


def _aligned(aligner: Aligner, text: str | None, squeeze) -> tuple[list[int], str, list[bytes], np.ndarray]:
    """A text's own figures, digest, packed links by slice, and distinct pairs."""
    own, digest, packed, pairs, sign = np.zeros(4, dtype=np.int64), hashlib.sha256(), [], [], ""
    for found in aligner.slices(text or ""):
        if found is None:
            return [0] * 4, "", [], np.empty(0, np.int64)
        links, groups = found
        is_a, is_b = (links & _END_A) != 0, (links & _END_B) != 0
        own += (np.count_nonzero(is_a), np.count_nonzero(is_b), np.count_nonzero(is_a & is_b), len(links))
        digest.update((sign + groups).encode())
        sign = ";"
        links = links & _PAIR
        packed.append(squeeze(np.concatenate((links >> 32, links & 0xFFFFFFFF)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))
        pairs.append(np.unique(links))
    if not pairs:
        return [0] * 4, "", [], np.empty(0, np.int64)
    return own.tolist(), digest.hexdigest(), packed, pairs[0] if len(pairs) == 1 else np.unique(np.concatenate(pairs))


_FIRST = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
          ("links", pa.list_(pa.binary())), ("pair", pa.int64()), ("n", pa.int64())]
_FIRST_DDL = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<binary>, pair long, n long"


def _documents_and_pairs(files: dict, key_type: pa.DataType, run_id: str):
    """Rows of documents (``pair`` null), and at the end rows of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counts = _aligner(files), _Counts()
        aligner.forget(run_id)
        squeeze = zstandard.ZstdCompressor(level=1).compress

        def emit(keys: list, columns: list[list]) -> pa.RecordBatch:
            arrays = [pa.array(keys, key_type), *[pa.array(c, kind) for c, (_, kind) in zip(columns, _FIRST)]]
            return pa.RecordBatch.from_arrays(arrays, names=["key", *[name for name, _ in _FIRST]])

        for batch in batches:
            rows = []
            for text in batch.column("text"):
                own, digest, packed, pairs = _aligned(aligner, text.as_py(), squeeze)
                rows.append((*own, digest, packed, None, None))
                if len(pairs):
                    counts.add(pairs)
            yield emit(batch.column("key").to_pylist(), list(zip(*rows)) if rows else [[]] * 8)
        counts.together()
        for at in range(0, len(counts.pairs), 1 << 16):
            n = len(counts.pairs[at: at + (1 << 16)])
            yield emit([None] * n, [[None] * n] * 6 + [counts.pairs[at: at + n], counts.n[at: at + n]])

    return run


def _first_pass(rows: DataFrame, files: dict) -> tuple[DataFrame, DataFrame]:
    """Documents (``key``, their figures and links) and pairs (``a, b, n, best``), both as written tables."""
    kind = rows.schema["key"].dataType
    found = stage(rows.mapInArrow(_documents_and_pairs(files, to_arrow_type(kind), uuid.uuid4().hex), f"key {kind.simpleString()}, {_FIRST_DDL}"), "aligned")
    summed = found.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stage(summed.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n"), "pairs")
    most = pairs.groupBy("a").agg(F.max("n").alias("most"))
    counts = stage(pairs.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")
    return found.where("pair is null"), counts


# Pass two: counts of a document's links ---------------------------------------------


def _links_of(packed: list[bytes], spread) -> Iterator[np.ndarray]:
    for part in packed:
        flat = np.frombuffer(spread(part), dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
        half = len(flat) // 2
        yield (flat[:half] << 32) | flat[half:]


def _looked_up(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor().decompress
        pairs, n, best = sent.value
        for batch in batches:
            sums = np.zeros((batch.num_rows, 2), dtype=np.int64)
            for i, packed in enumerate(batch.column("links")):
                for links in _links_of(packed.as_py(), spread):
                    at = np.searchsorted(pairs, links)
                    sums[i] += (np.count_nonzero(best[at]), n[at].sum())
            kept = [batch.column(c) for c in ("key", *_OWN)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums[:, 0]), pa.array(sums[:, 1]), batch.column("groups_sha256")],
                                             names=["key", *_OWN, "n_best", "count_sum", "groups_sha256"])

    return run


def _exploded():
    """A row of each document's own figures (``head``), and one for each distinct link with its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        spread = zstandard.ZstdDecompressor().decompress
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            heads = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            none = pa.array(np.zeros(batch.num_rows, dtype=np.int64))
            kept = [batch.column(c) for c in ("key", *_OWN, "groups_sha256")]
            names = ["key", *_OWN, "groups_sha256", "row", "head", "a", "b", "times"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(heads), pa.array(np.ones(batch.num_rows, dtype=bool)), none, none, none], names=names)
            for head, packed in zip(heads, batch.column("links")):
                for links in _links_of(packed.as_py(), spread):
                    pairs, times = np.unique(links, return_counts=True)
                    n = len(pairs)
                    empty = [pa.nulls(n, c.type) for c in kept]
                    yield pa.RecordBatch.from_arrays([*empty, pa.array(np.full(n, head)), pa.array(np.zeros(n, dtype=bool)),
                                                      pa.array(pairs >> 32), pa.array(pairs & 0xFFFFFFFF), pa.array(times)], names=names)

    return run


def _joined(documents: DataFrame, counts: DataFrame) -> DataFrame:
    kind = documents.schema["key"].dataType.simpleString()
    shape = f"key {kind}, {', '.join(f'{c} long' for c in _OWN)}, groups_sha256 string, row long, head boolean, a long, b long, times long"
    found = stage(documents.mapInArrow(_exploded(), shape), "links")
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    links = found.where("not head").select("row", "a", "b", "times", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
    sums = links.join(salted, ["a", "b", "salt"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return found.where("head").join(sums, "row", "left").select(
        "key", *_OWN, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def align(df: DataFrame, key: str = "doc_id", text: str = "text", files: dict | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``df``: ``key``, the numbers of A and B tokens, groups and
    links, the links whose pair is among the most frequent of its A id, the sum of
    the links' counts, and the SHA-256 of the groups.

    A count is the number of rows that hold the pair linked, repeated rows
    each for itself; pairs that tie for an A id's highest count are all its best.
    Null and empty texts, and those whose tokens do not join to space and text, give
    zeros and ''.  An empty input gives no rows; null keys are kept, and other
    columns do not take part.  A long text is aligned by slices; a stretch
    without a plain space between visible characters is one unit, which the
    libraries get whole.
    """
    short_batches(df.sparkSession)
    files = files or public_files()
    documents, counts = _first_pass(df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), files)
    kind = documents.schema["key"].dataType
    if counts.count() > broadcast_pairs:
        return _joined(documents, counts).withColumnRenamed("key", key)
    found = counts.select(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("pair"), "n", "best").toArrow()  # at most broadcast_pairs rows
    pairs = found.column("pair").to_numpy()
    order = np.argsort(pairs)
    sent = df.sparkSession.sparkContext.broadcast((pairs[order], found.column("n").to_numpy()[order], found.column("best").to_numpy()[order]))
    shape = f"key {kind.simpleString()}, {', '.join(f'{c} long' for c in [*_OWN, 'n_best', 'count_sum'])}, groups_sha256 string"
    return documents.mapInArrow(_looked_up(sent), shape).withColumnRenamed("key", key)


def linked_pairs(df: DataFrame, text: str = "text", files: dict | None = None) -> DataFrame:
    """``(a, b, n, best)``: every pair of ids that tokens of some row link, with the rows that hold it."""
    short_batches(df.sparkSession)
    rows = df.select(F.lit(0).alias("key"), F.col(text).cast("string").alias("text"))
    return _first_pass(rows, files or public_files())[1]


def translation(df: DataFrame, text: str = "text", files: dict | None = None) -> DataFrame:
    """``(a, b, n)``: for each A id its most frequent B id, ties to the smaller."""
    first = Window.partitionBy("a").orderBy("b")
    best = linked_pairs(df, text, files).where("best")
    return best.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("a", "b", "n")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of every document's two token sequences."""
    return align(table(spark, sf_dir, "documents").select("doc_id", "text"))
