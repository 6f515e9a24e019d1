"""Document fingerprints: a Merkle tree over paragraphs and sections.

Leaves are paragraphs (lines); runs of paragraphs that end at a paragraph whose
digest has three zero bits form a section, so that an edit moves few section
bounds; the root is the digest of the sections.  Equal roots mean equal texts;
where roots differ, only differing sections and then differing paragraphs are
looked at, which locates edits and weighs them.  Below the paragraphs a fixed-size
sketch of word runs (the least hashes) tells how much of the differing ones is alike.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasol.llm.common import batches, mix, text_bytes

#: Least hashes of word runs kept in a fingerprint.
SKETCH = 128
#: Code points of text in one task.
PART_CHARS = 8_000_000
#: Most parts (their bounds are all that the driver holds).
MAX_PARTS = 100_000
LOWEST = -(2**63)


@dataclass(frozen=True)
class Tree:
    root: bytes
    #: (digest, [(first byte, end byte, digest), ...]) per section
    sections: list[tuple[bytes, list[tuple[int, int, bytes]]]]


def tree(text: bytes) -> Tree:
    """Merkle tree of a UTF-8 text; spans are byte offsets of paragraphs."""
    sections, run, at = [], [], 0
    paragraphs = text.split(b"\n")
    for k, p in enumerate(paragraphs):
        d = hashlib.blake2b(p, digest_size=16).digest()
        run.append((at, at + len(p), d))
        at += len(p) + 1
        if d[0] & 7 == 0 or k == len(paragraphs) - 1:
            sections.append((hashlib.blake2b(b"".join(x[2] for x in run), digest_size=16).digest(), run))
            run = []
    return Tree(hashlib.blake2b(b"".join(s[0] for s in sections), digest_size=16).digest(), sections)


def edits(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Byte spans of a's paragraphs that b lacks; branches with equal digests are not entered."""
    if a.root == b.root:
        return []
    theirs = {d for d, _ in b.sections}
    ours = {d for d, _ in a.sections}
    paragraphs = {p[2] for d, ps in b.sections if d not in ours for p in ps}
    return [p[:2] for d, ps in a.sections if d not in theirs for p in ps if p[2] not in paragraphs]


class Sketcher:
    """Least hashes of the word runs of a text; a run ends where its last word's hash is even, or with the paragraph."""

    def __init__(self, size: int = SKETCH):
        self.size = size
        rng = np.random.default_rng(7)
        self.byte = rng.integers(0, 2**64, 256, np.uint64)
        self.odd = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.odd)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.inverse)]), dtype=np.uint64)

    def __call__(self, text: bytes) -> np.ndarray:
        raw = np.frombuffer(text, np.uint8)
        word = ~self.space[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        if not len(begin):
            return np.empty(0, np.uint32)
        with np.errstate(over="ignore"):
            self._powers(len(raw) + 1)
            total = np.concatenate([[np.uint64(0)], np.cumsum(self.byte[raw] * self.up[:len(raw)], dtype=np.uint64)])

            def spans(lo, hi):
                return mix((total[hi] - total[lo]) * self.down[lo])

            lines = np.concatenate([[0], np.cumsum(raw == 10)])
            last = (spans(begin, end) & np.uint64(1) == 0) | np.append(lines[begin[1:]] != lines[end[:-1]], True)
            stop = np.flatnonzero(last)
            first = np.concatenate([[0], stop[:-1] + 1])
            runs = np.unique((spans(begin[first], end[stop]) >> np.uint64(32)).astype(np.uint32))
        return runs[:self.size]


def weigh(t: Tree) -> int:
    """Bytes of a text and one per paragraph."""
    return sum(p[1] - p[0] + 1 for _, ps in t.sections for p in ps)


def fingerprint(t: Tree, runs: np.ndarray) -> str:
    """Root digest and sketch as text."""
    return f"{t.root.hex()}:{base64.b64encode(runs.astype('<u4').tobytes()).decode()}"


def run_share(x: np.ndarray, y: np.ndarray, size: int = SKETCH) -> float:
    """Estimated share of common word runs (Dice) from two sketches."""
    both = np.union1d(x, y)[:size]
    if not len(both):
        return 0.0
    share = float(np.isin(both, np.intersect1d(x, y, assume_unique=True)).sum()) / len(both)
    return 2 * share / (1 + share)


def likeness(a: tuple[Tree, np.ndarray], b: tuple[Tree, np.ndarray]) -> float:
    """0 to 1 from the trees and sketches of two texts; 1 for equal roots only.

    The trees' differing branches tell which share of the texts, by bytes, stands in
    paragraphs that both have; where paragraphs differ in part only, the sketches'
    share of word runs is the higher one and counts.  Common paragraphs that stand in
    differing sections (moved or beside an edit) cost a quarter of the cost of others.
    """
    (s, x), (t, y) = a, b
    if s.root == t.root:
        return 1.0
    total = weigh(s) + weigh(t)
    changed = sum(hi - lo + 1 for lo, hi in (*edits(s, t), *edits(t, s)))
    ours, theirs = ({d for d, _ in u.sections} for u in (s, t))
    branches = sum(p[1] - p[0] + 1 for u, other in ((s, theirs), (t, ours)) for d, ps in u.sections if d not in other for p in ps)
    near = max(1 - changed / total, run_share(x, y) if changed else 1.0)
    near -= (branches - changed) / total * (1 - near if changed else 1.0) / 4
    return float(min(max(near, 0.0), 1 - 1 / (1 + total)))  # different roots: below 1 however little differs


def merkle_trees(docs: DataFrame) -> DataFrame:
    """``doc_id, root, sections`` (digest and paragraphs with byte spans) of every text; null text is the empty text."""
    schema = "doc_id long, root string, sections array<struct<digest:string,paragraphs:array<struct<first:long,end:long,digest:string>>>>"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            trees = [tree((t or "").encode()) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "root": [t.root.hex() for t in trees],
                                "sections": [[{"digest": d.hex(), "paragraphs": [{"first": p[0], "end": p[1], "digest": p[2].hex()} for p in ps]}
                                              for d, ps in t.sections] for t in trees]})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, schema)


def with_next(docs: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Rows dealt into parts by ascending doc_id, sorted, each part followed by the row after it: ``part, guest, _k, doc_id, text``.

    Bounds are approximate quantiles of the ids, at most ``MAX_PARTS`` numbers
    whatever the table holds; the first row of a part goes to the part before it
    as well (as a guest), the very first row to the last part.  Null ids come
    first, ties go by text.  A part is read as a stream, so it may be of any size.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("_k"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    n, chars = text_bytes(docs)
    parts = max(1, min(n, -(-chars // part_chars), MAX_PARTS))
    quantiles = [k / parts for k in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("_k", quantiles, min(100 * parts, 1_000_000)).alias("b")).first().b if quantiles else None
    bounds = np.unique(np.array(bounds or [], np.int64))

    def first_ids(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            k = b.column("_k").to_numpy(zero_copy_only=False)
            own, at = np.unique(np.searchsorted(bounds, k, "left"), return_inverse=True)
            low = np.full(len(own), np.iinfo(np.int64).max)
            np.minimum.at(low, at, k)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(low)], names=["part", "low"])

    firsts = rows.select("_k").mapInArrow(first_ids, "part long, low long").groupBy("part").agg(F.min("low").alias("low")).collect()
    firsts = sorted((r.part, r.low) for r in firsts)
    before = {low: firsts[i - 1][0] for i, (_, low) in enumerate(firsts)}
    lows = np.array(sorted(before), np.int64)

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            k = b.column("_k").to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, k, "left")
            guests = np.flatnonzero(np.isin(k, lows))
            take = np.concatenate([np.arange(len(k)), guests])
            to = np.concatenate([part, [before[int(x)] for x in k[guests]]]).astype(np.int64)
            own = b.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.arange(len(take)) >= len(k)), *own.columns],
                                             names=["part", "guest", "_k", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "part long, guest boolean, _k long, doc_id long, text string")
    return dealt.repartition("part").sortWithinPartitions("part", "guest", "_k", "text")


def fingerprint_edits(docs: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text replaces the last floor(n_chars / 4) code points by the first
    as many (or all) of the next document by doc_id (after the last: the first).
    Null text is the empty text; a single row is its own next document; repeated
    rows follow each other; an empty table gives an empty result.  ``edited_spans`` are
    the byte spans of the edited text's paragraphs that the text lacks.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, edited_spans array<struct<first:long,end:long>>")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_spans"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher()
        last = None  # (part, guest, doc_id, text, tree and sketch) of the row before

        def result(row, text: str, mark: tuple) -> tuple:
            """Of a row, by the text, tree and sketch of the row after it."""
            cut = len(row[3]) // 4
            edited = (row[3][:len(row[3]) - cut] + text[:cut]).encode()
            own = (tree(edited), sketch(edited)) if cut else row[4]
            spans = [{"first": lo, "end": hi} for lo, hi in edits(own[0], row[4][0])]
            return (row[2], len(row[3]), hashlib.sha256(edited).hexdigest(), fingerprint(*row[4]), fingerprint(*own),
                    likeness(row[4], own), likeness(row[4], mark), spans)

        for b in batches(it, 1000):
            out = []
            for part, guest, doc, text in zip(*(b.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))):
                follows = last is not None and last[0] == part and not last[1]
                if guest and not follows:
                    continue  # one guest ends a part
                raw = text.encode()
                mark = tree(raw), sketch(raw)
                if follows:
                    out.append(result(last, text, mark))
                last = (part, guest, doc, text, mark)
            cols = list(zip(*out)) or [()] * len(names)
            types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return with_next(docs, part_chars).mapInArrow(run, schema)
