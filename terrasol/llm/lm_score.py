"""Language-model scores by a weighted backoff automaton.

Smoothed n-grams of the training texts become states with weighted arcs; a state
that has no arc for the next word takes its failure arc to the state of its
suffix and pays the arc's weight.  One left-to-right traversal carries the state
and adds up log10 probabilities.

    P(w | h) = (c(h w) + B(h) * P(w | suffix of h)) / (c(h) + B(h)),   B(h) = K + A * c(h)^E
    P(w)     = (c(w) + 1) / (N + V + 1)

The whole model never meets in one place.  Documents are dealt into blocks.  A
block sends the distinct n-grams it holds, with their counts in its training
texts, to the buckets that own them; a bucket adds the counts up and answers each
block with the totals of just the n-grams it asked for; the block builds its part
of the automaton from them and scores its texts.  N-grams travel as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.llm.common import Scratch, WordIds, mix, release, text_bytes, utf8

ORDER = 3
#: Weight of the shorter context in the smoothed estimate: a constant, and a share of the context's count.
K, A = 3.0, 6.0
#: The same with an exponent below 1, so that the share falls as a context is seen more often (fitted on training rows of sf0.1).
FALLING = (3.0, 6.0, 0.8)
#: Code points of text in a block.
BLOCK_CHARS = 10_000_000
#: Tokens a lane of the traversal takes at a time.
LANE = 256
#: Pseudo words (no word holds white space): a text's end, and the state before its first word.
END, START = b"\n", b" "
ODD = np.uint64(0x9E3779B97F4A7C15)


def pack_blocks(docs: DataFrame, blocks: int, train: Column) -> DataFrame:
    """``block, ids, train, blob``: texts of a scan batch by block, compressed, so that the shuffle moves few bytes."""
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")  # rows without an id are dealt by their texts
    rows = docs.select("doc_id", "text", train.alias("_train"), block.alias("_block"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        pack = zstandard.ZstdCompressor(level=3)
        for b in it:
            texts, where = utf8(b, "text"), b.column("_block").to_numpy(zero_copy_only=False)
            ids, flags = b.column("doc_id").to_pylist(), b.column("_train").to_pylist()
            out: list[tuple] = []
            for k in np.unique(where).tolist():
                at = np.flatnonzero(where == k).tolist()
                own = [texts[i] for i in at]
                lens = np.array([len(t) for t in own], "<u4")
                out.append((k, [ids[i] for i in at], [flags[i] for i in at], pack.compress(lens.tobytes() + b"".join(own))))
            cols = list(zip(*out)) or [()] * 4
            types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["block", "ids", "train", "blob"])

    return rows.mapInArrow(run, "block int, ids array<long>, train array<boolean>, blob binary")


def unpack(pdf: pd.DataFrame) -> tuple[list, np.ndarray, list[bytes]]:
    """(doc ids, training flags, texts) of a block."""
    import zstandard
    ids, train, texts = [], [], []
    for own, flags, blob in zip(pdf["ids"], pdf["train"], pdf["blob"]):
        raw = zstandard.ZstdDecompressor().decompress(blob)
        ends = 4 * len(own) + np.cumsum(np.frombuffer(raw, "<u4", len(own)), dtype=np.int64)
        texts += [raw[lo:hi] for lo, hi in zip([4 * len(own), *ends[:-1].tolist()], ends.tolist())]
        ids += [None if i is None or i != i else int(i) for i in own]
        train += [bool(x) for x in flags]
    return ids, np.array(train, bool), texts


class Grams:
    """The distinct n-grams of a block: ``key[k]`` sorted, ``at[k]`` a position that ends each, ``of[k]`` per position."""

    def __init__(self, texts: list[bytes], order: int = ORDER):
        words = WordIds()
        start, end = words.array([START]), words.array([END])
        lists = [words.array(t.lower().split()) for t in texts]
        self.n = np.array([len(x) for x in lists], np.int64)
        self.first = np.cumsum(self.n + 2) - (self.n + 2)  # of each text's START
        self.seq = np.concatenate([np.empty(0, np.uint64), *(y for x in lists for y in (start, x, end))])
        self.doc = np.repeat(np.arange(len(texts)), self.n + 2)
        place = np.arange(len(self.seq)) - self.first[self.doc]
        self.key, self.at, self.of = {}, {}, {}
        with np.errstate(over="ignore"):
            gram = mix(self.seq)
            for k in range(1, order + 1):
                if k > 1:
                    gram = np.concatenate([gram[:1], mix(gram[:-1] * ODD + self.seq[1:])])
                fits = np.flatnonzero(place >= k - 1)  # n-grams lie within one text
                key, at, of = np.unique(gram[fits], return_index=True, return_inverse=True)
                self.key[k], self.at[k] = key, fits[at].astype(np.int32)  # a block has far fewer positions
                self.of[k] = np.full(len(self.seq), -1, np.int32)
                self.of[k][fits] = of


def requests(pdf: pd.DataFrame, buckets: int, order: int) -> pd.DataFrame:
    """The n-grams of a block and their counts in its training texts, by owning bucket."""
    _, train, texts = unpack(pdf)
    g = Grams(texts, order)
    rows = []
    for k in range(1, order + 1):
        of = g.of[k][train[g.doc]]
        count = np.bincount(of[of >= 0], minlength=len(g.key[k]))
        ends = np.searchsorted(bucket_of(g.key[k], buckets), np.arange(buckets + 1))
        for b in range(buckets):
            lo, hi = ends[b], ends[b + 1]
            if lo < hi:
                rows.append((b, int(pdf["block"].iloc[0]), k, squeeze(g.key[k][lo:hi]), shrink(count[lo:hi])))
    return pd.DataFrame(rows, columns=["bucket", "block", "k", "keys", "counts"])


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Owner of a key by its high bits, so that sorted keys stand in the order of their buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def shrink(x: np.ndarray) -> bytes:
    """Counts as compressed bytes of the narrowest type, the type's width first."""
    import zstandard
    kind = next(t for t in ("<u1", "<u2", "<u4", "<u8") if len(x) == 0 or x.max() <= np.iinfo(t).max)
    return kind[2:].encode() + zstandard.ZstdCompressor(level=3).compress(x.astype(kind).tobytes())


def widen(x: bytes) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x[1:]), f"<u{x[:1].decode()}").astype(np.int64)


def squeeze(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed gaps, byte by byte of their places (the high bytes of a gap are mostly 0)."""
    import zstandard
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes())


def expand(x: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def mass(c: np.ndarray, weights: tuple[float, ...]) -> np.ndarray:
    """Weight B(h) of the shorter context, for contexts seen c times; without an exponent it is linear."""
    k, a, e = (*weights, 1.0)[:3]
    return k + a * c ** e


def answers(pdf: pd.DataFrame) -> pd.DataFrame:
    """Totals of a bucket's n-grams, for each block in the order of its request; block -1: tokens and types of the bucket."""
    import xxhash
    rows = []
    for k, part in pdf.groupby("k", sort=True):
        keys = [expand(x) for x in part["keys"]]
        key, of = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(of, np.concatenate([widen(x) for x in part["counts"]]), minlength=len(key)).astype(np.int64)
        ends = np.cumsum([len(x) for x in keys])
        for block, lo, hi in zip(part["block"], [0, *ends[:-1]], ends):
            rows.append((int(block), int(pdf["bucket"].iloc[0]), int(k), shrink(total[of[lo:hi]]), 0, 0))
        if k == 1:  # the start state is a context, no token
            token = key != mix(np.array([xxhash.xxh3_64_intdigest(START)], np.uint64))[0]
            rows.append((-1, int(pdf["bucket"].iloc[0]), 1, b"", int(total[token].sum()), int((total[token] > 0).sum())))
    return pd.DataFrame(rows, columns=["block", "bucket", "k", "counts", "tokens", "types"])


class Automaton:
    """States are the known contexts of a block; arcs are its known n-grams; failure arcs lead to the suffix."""

    def __init__(self, g: Grams, count: dict[int, np.ndarray], tokens: int, types: int, order: int = ORDER, weights: tuple[float, ...] = (K, A)):
        self.order, self.key, self.known = order, g.key, {k: c > 0 for k, c in count.items()}
        self.arc, self.back, self.fail = {}, {}, {}
        p = (count[1] + 1) / (tokens + types + 1)
        self.unknown = float(np.log10(1 / (tokens + types + 1)))
        self.arc[1] = np.log10(p)
        for k in range(1, order + 1):
            if k > 1:
                lower = g.of[k - 1][g.at[k]]
                context = count[k - 1][g.of[k - 1][g.at[k] - 1]]
                b = mass(context, weights)
                p = (count[k] + b * p[lower]) / (context + b)
                self.arc[k], self.fail[k] = np.log10(p), lower
            if k < order:
                b = mass(count[k], weights)
                self.back[k] = np.log10(b / (count[k] + b))

    def find(self, k: int, key: np.ndarray) -> np.ndarray:
        """Index of the known k-gram with this key, none: -1."""
        if not len(self.key[k]):
            return np.full(len(key), -1)
        at = np.searchsorted(self.key[k], key).clip(max=len(self.key[k]) - 1)
        return np.where((self.key[k][at] == key) & self.known[k][at], at, -1)

    def step(self, depth: np.ndarray, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Log10 probability of one word per lane; depth and state (words of the context, its index) move on in place."""
        out = np.zeros(len(word))
        todo = np.ones(len(word), bool)
        with np.errstate(over="ignore"):
            for k in range(self.order, 0, -1):
                at = np.flatnonzero(todo & (depth == k - 1))
                if not len(at):
                    continue
                key = mix(word[at]) if k == 1 else mix(self.key[k - 1][state[at]] * ODD + word[at])
                got = self.find(k, key)
                hit, miss = at[got >= 0], at[got < 0]
                found = got[got >= 0]
                out[hit] += self.arc[k][found]
                todo[hit] = False
                if k < self.order:
                    depth[hit], state[hit] = k, found
                elif k > 1:
                    depth[hit], state[hit] = k - 1, self.fail[k][found]
                if k == 1:
                    out[miss] += self.unknown
                else:
                    out[miss] += self.back[k - 1][state[miss]]
                    depth[miss] = k - 2
                    if k > 2:
                        state[miss] = self.fail[k - 1][state[miss]]
        return out

    def scores(self, g: Grams, lane: int = LANE) -> np.ndarray:
        """One left-to-right traversal of every text, many lanes side by side.

        The state depends on the last ``order - 1`` words alone, so a lane that
        first runs over those words carries the state of the whole traversal.
        """
        out = np.zeros(len(g.n))
        warm = self.order - 1
        cuts = -(-(g.n + 1) // lane)
        doc = np.repeat(np.arange(len(g.n)), cuts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        lo = g.first[doc] + 1 + nth * lane
        hi = np.minimum(lo + lane, g.first[doc] + g.n[doc] + 2)
        begin = np.maximum(lo - warm, g.first[doc])
        order = np.argsort(begin - hi, kind="stable")  # the longest first: the lanes still running stand in front
        doc, lo, hi, begin = doc[order], lo[order], hi[order], begin[order]
        length = hi - begin
        depth, state, total = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64), np.zeros(len(doc))
        for t in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -t, "left"))
            at = begin[:live] + t
            d, s = depth[:live], state[:live]
            got = self.step(d, s, g.seq[at])
            total[:live] += np.where(at >= lo[:live], got, 0.0)
        np.add.at(out, doc, total)
        return out


def score_block(pdf: pd.DataFrame, told: pd.DataFrame, tokens: int, types: int, order: int = ORDER, weights: tuple[float, ...] = (K, A)) -> pd.DataFrame:
    ids, train, texts = unpack(pdf)
    g = Grams(texts, order)
    count = {}
    for k in range(1, order + 1):
        own = told[told["k"] == k].sort_values("bucket")
        count[k] = np.concatenate([np.empty(0, np.int64), *map(widen, own["counts"])])
    real = np.ones(len(g.seq), bool)
    real[g.first] = False
    c, doc = count[1][g.of[1][real]], g.doc[real]
    base = np.bincount(doc, np.log10((c + 1) / (tokens + types + 1)), minlength=len(ids))
    return pd.DataFrame({
        "doc_id": pd.array(ids, "Int64"), "train": train, "n_tokens": g.n + 1, "n_known": np.bincount(doc, c > 0, minlength=len(ids)).astype(np.int64),
        "train_tokens": tokens, "base_score": base, "score": Automaton(g, count, tokens, types, order, weights).scores(g)})


def _one(run):
    """A group's function that gives its memory back when it ends: a worker handles one group after the other."""
    def wrapped(pdf: pd.DataFrame) -> pd.DataFrame:
        out = run(pdf)
        release()
        return out
    return wrapped


def _two(run):
    """The same for a function of two groups."""
    def wrapped(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = run(a, b)
        release()
        return out
    return wrapped


def score_texts(docs: DataFrame, train: Column, order: int = 2, weights: tuple[float, ...] = (K, A), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` for every row of docs.

    ``score`` is what the traversal of the automaton of the given order adds up
    (weights: K, A and, if not 1, the exponent E); ``base_score`` that of single words.

    The model learns from the rows where ``train`` holds.  Null and empty texts
    consist of the end token; rows without an id and repeated rows are scored (and
    counted) like others; without any training row every token is unknown; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm-score")
    _, chars = text_bytes(docs)
    blocks = max(1, -(-chars // block_chars))
    packed = pack_blocks(docs, blocks, F.coalesce(train, F.lit(False)))
    asked = packed.groupBy("block").applyInPandas(
        _one(lambda pdf: requests(pdf, blocks, order)), "bucket int, block int, k int, keys binary, counts binary")
    told = scratch.save(asked.groupBy("bucket").applyInPandas(
        _one(answers), "block int, bucket int, k int, counts binary, tokens long, types long"), "totals")
    r = told.where("block = -1").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    tokens, types = r.n or 0, r.v or 0
    schema = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return packed.groupBy("block").cogroup(told.where("block >= 0").groupBy("block")).applyInPandas(
        _two(lambda a, b: score_block(a, b, tokens, types, order, weights)), schema)
