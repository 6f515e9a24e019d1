"""Best-fit packing of token pieces by exact-complement hashing.

Piece lengths lie in 1..capacity, so the packing plan is made on the histogram
of lengths (``capacity`` numbers whatever the corpus holds).  Single, pair and
triple length sums are indexed; each combination that fills a gap exactly is
consumed as often as its lengths are available, and what no exact combination
takes is packed best-fit (the longest length that still fits the gap).  Every
step uses up a length, so the plan has O(capacity) patterns; pieces then take
their places by their rank among the pieces of equal length.
"""

from __future__ import annotations

import base64
import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasol.llm.common import Scratch, batches, released

CAPACITY = 1024
END_ID = 2


#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class WordMemo(dict):
    """Memo word -> ids of ``" " + word``; holds at most ``limit`` words."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        ids = self[word] = self.encode(" " + word)
        return ids


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    A single space between two characters that are no white space always begins
    a new pre-token of the byte-level pattern, so such a text is encoded word by
    word through a memo of bounded size; any other text, and one that holds the
    string of a special token, is encoded whole.  With
    ``ranks`` (the same vocabulary as a rank file) the words go through the
    faster rank encoder, after a check that both give the same ids.
    """

    def __init__(self, path: str, ranks: str | None = None, limit: int = 250_000):
        import re
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.gaps = re.compile("|".join([r"\s\s", *special]))
        self.word = lambda w: self._encode([w])[0]
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
            probe = [" Zürich", " naïve12's", " a\nb", " ###+-"]
            if [fast(w) for w in probe] != [e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]:
                raise ValueError("the rank file is not the tokenizer's vocabulary")
            self.word = lambda w: array("I", fast(w)).tobytes()
        self.memo = WordMemo(self.word, limit)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        gap, word, ids_of = self.gaps.search, self.word, self.memo.__getitem__
        odd = [gap(t) is not None for t in texts]
        done = iter(self._encode([t for t, o in zip(texts, odd) if o]))
        out = []
        for t, o in zip(texts, odd):
            if o:
                out.append(next(done))
            else:
                first, *rest = t.split(" ")
                out.append(word(first) + b"".join(map(ids_of, rest)))
        return out


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, ranks: str | None = None) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` (and ``ids`` on request).

    A document's ids end with id 2.  Only a document longer than ``capacity`` is
    cut; its first piece takes the remainder, all others are full.  Null text is
    the empty text (one piece holding the end id); null ids and repeated rows are
    kept as rows of their own.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tokenizer, ranks)
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches(it, 500):
            rows: dict[str, list] = defaultdict(list)
            texts = [t or "" for t in b.column("text").to_pylist()]
            for doc, ids in zip(b.column("doc_id").to_pylist(), enc.encode(texts)):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * lo:4 * hi]
                    for name, x in (("doc_id", doc), ("piece", k), ("start", lo), ("length", hi - lo), ("ids_crc32", zlib.crc32(part)), ("ids", part)):
                        rows[name].append(x)
            types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
            names = [n for n in types if with_ids or n != "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], types[n]) for n in names], names=names)

    return docs.select("doc_id", "text").mapInArrow(released(run), schema)


class SumIndex:
    """Which available lengths make up a sum: single lengths, pairs and triples, looked up by their sum.

    Counts only fall, so for every sum the index remembers where its next pair and its
    next triple may begin and never goes back over lengths that were used up: all
    lookups of a plan together cost about ``capacity`` squared steps.
    """

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.left = {n: c for n, c in histogram.items() if c}
        top = max(capacity, *self.left) if self.left else capacity
        #: For each sum, the largest smaller part of a pair, and the largest part of a triple, not ruled out yet.
        self.pair_at = [s // 2 for s in range(top + 1)]
        self.triple_at = list(range(top + 1))

    def has(self, *lengths: int) -> bool:
        return all(self.left.get(n, 0) >= lengths.count(n) for n in lengths)

    def pair(self, total: int) -> tuple[int, int] | None:
        """The most even available pair of a sum."""
        a = self.pair_at[total]
        while a > 0 and not self.has(a, total - a):
            a -= 1
        self.pair_at[total] = a
        return (total - a, a) if a > 0 else None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """The available triple of a sum with the largest greatest part."""
        a = self.triple_at[total]
        while a > 0:
            rest = self.pair(total - a) if a in self.left and a < total else None
            if rest is not None:
                if self.has(a, *rest):
                    self.triple_at[total] = a
                    return (a, *rest)
                # a itself is in the pair and too rare for both: pairs further apart may do
                b = next((b for b in range(rest[1] - 1, 0, -1) if self.has(a, b, total - a - b)), None)
                if b is not None:
                    self.triple_at[total] = a
                    return a, total - a - b, b
            a -= 1
        self.triple_at[total] = 0
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """A single, pair or triple of available lengths that sums to the gap."""
        return (gap,) if gap in self.left else self.pair(gap) or self.triple(gap)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for n in lengths:
            self.left[n] -= times
            if not self.left[n]:
                del self.left[n]


def complement(index: SumIndex, gap: int, n: int) -> tuple[int, ...] | None:
    """An exact complement of a length n that must stay available besides it."""
    options = [(gap,)] + [(gap - a, a) for a in range(gap // 2, 0, -1)]
    found = next((f for f in options if index.has(n, *f)), None)
    if found is None:
        for a in range(gap - 2, 0, -1):
            if a in index.left:
                found = next(((a, gap - a - b, b) for b in range((gap - a) // 2, 0, -1) if index.has(n, a, b, gap - a - b)), None)
                if found:
                    break
    return found


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, times)`` that use every length exactly as often as the histogram says."""
    index = SumIndex(dict(sorted(histogram.items())), capacity)
    left = index.left
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...]) -> None:
        times = min(left[n] // lengths.count(n) for n in lengths)
        plan.append((lengths, times))
        index.take(lengths, times)

    # longest lengths first: each exact complement is consumed under the counts
    for n in sorted(left, reverse=True):
        while n in left:
            if n == capacity:
                take((n,))
                continue
            found = index.exact(capacity - n)
            # the complement may hold n itself
            if found is None or not index.has(n, *found):
                found = None if found is None else complement(index, capacity - n, n)
            if found is None:
                break
            take((n, *found))
    # residuals: best fit, the longest length that fits the gap, until nothing fits
    while left:
        lengths: tuple[int, ...] = (max(left),)
        while True:
            gap = capacity - sum(lengths)
            fits = next((m for m in sorted(left, reverse=True) if m <= gap and left[m] > lengths.count(m)), None)
            if fits is None:
                break
            lengths += (fits,)
        take(lengths)
    return plan


def places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows ``(first rank, slots, pattern's first sequence, copies in the pattern, first offset)``."""
    out: dict[int, list] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, times in plan:
        offset = 0
        for n in dict.fromkeys(lengths):
            k = lengths.count(n)
            out[n].append((ranks[n], sequence, k, offset))
            ranks[n] += k * times
            offset += n * k
        sequence += times
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id, offset`` to materialised pieces with a ``length`` in 1..capacity.

    Only the histogram (at most ``capacity`` rows) reaches the driver.  Ranks
    within a length are counted in two levels (salted by the piece's identity),
    so a length that a third of the pieces have is dealt over many tasks.  Empty
    input gives an empty result; repeated rows take places of their own.
    """
    spark = pieces.sparkSession
    rows = pieces.groupBy("length").count().collect()
    histogram = {r["length"]: r["count"] for r in rows}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    table = places(packing_plan(histogram, capacity))
    salts = max(1, sum(histogram.values()) // 50_000)
    # a stored row number deals even pieces that are alike in everything; else their identity does
    key = F.pmod(F.xxhash64(*(["_row"] if "_row" in pieces.columns else ["doc_id", "piece"])), F.lit(salts)).cast("int")
    salted = pieces.withColumn("_salt", key)
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(
        Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    w = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_at", F.row_number().over(w) - 1)
              .join(before.select("length", "_salt", F.coalesce("_before", F.lit(0)).alias("_before")), ["length", "_salt"])
              .withColumn("_rank", F.col("_before") + F.col("_at")).drop("_salt", "_before", "_at"))

    names = [c for c in pieces.columns if c != "_row"]
    schema = ranked.select(*names).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def assign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            length = np.asarray(b.column("length").to_numpy(zero_copy_only=False))
            rank = np.asarray(b.column("_rank").to_numpy(zero_copy_only=False))
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                t = table[int(n)]
                row = t[np.searchsorted(t[:, 0], rank[at], "right") - 1]
                inside = rank[at] - row[:, 0]
                seq[at] = row[:, 1] + inside // row[:, 2]
                off[at] = row[:, 3] + inside % row[:, 2] * n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    out = ranked.select(*names, "_rank").mapInArrow(assign, schema)
    return out if rows else spark.createDataFrame([], schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ranks: str | None = None) -> DataFrame:
    """Tokenize, cut and pack a documents table (see :func:`token_pieces`, :func:`pack`)."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = token_pieces(docs, tokenizer, capacity, ranks=ranks).withColumn("_row", F.monotonically_increasing_id())
    return pack(scratch.save(pieces, "pieces"), capacity)
