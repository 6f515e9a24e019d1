"""Runs of periodic words by longest common extensions over a difference cover.

A run of period p and a length of at least 2p holds a multiple of p whose word occurs
again p words later, so the harmonic grid of all multiples of all periods meets every
run.  Where two words of the grid agree, the run's ends are their longest common
extensions (LCE) to the right and to the left.

An LCE is found from suffixes sorted by rank, of which only those that start in a
difference cover are sorted: any two positions, moved on by the same few words, both
lie in the cover.  So those few words are compared one by one, and the rest is the
least common prefix between two places of the sorted suffixes (a sparse table).
Texts are handled many at a time as one array, parted by numbers that occur once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from terrasol.llm.common import utf8

#: Shortest run, in words.
LEAST = 12
#: Two elements of the cover differ by any number modulo its period.
PERIOD, COVER = 7, (1, 2, 4)
#: Texts are gathered until they hold so many words (a longer text stands alone).
BATCH = 1_000_000


def shift_table(period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """[i, d]: the fewest words after which i and i + d both lie in the cover (all modulo the period)."""
    out = np.zeros((period, period), np.int64)
    for i in range(period):
        for d in range(period):
            out[i, d] = next(t for t in range(period) if (i + t) % period in cover and (i + d + t) % period in cover)
    return out


class CommonExtensions:
    """Longest common extensions between positions of an integer array that ends in a number of its own."""

    def __init__(self, x: np.ndarray, period: int = PERIOD, cover: tuple[int, ...] = COVER):
        self.period, self.shift = period, shift_table(period, cover)
        # numbers that occur nowhere else stop every comparison at the end
        tail = np.arange(1, 2 * period + 1, dtype=np.int64) + (int(x.max(initial=0)) if len(x) else 0)
        self.x = np.concatenate([x.astype(np.int64), tail])
        self._sort(len(x), period, cover)

    def _sort(self, n: int, period: int, cover: tuple[int, ...]) -> None:
        """Ranks of the cover's suffixes by doubling, then common prefixes of neighbours and their sparse table."""
        x, inside = self.x, np.isin(np.arange(n + period) % period, cover)
        self.number = np.cumsum(inside) - 1  # position -> number of the sampled suffix (where there is one)
        at = np.flatnonzero(inside)
        block = np.unique(x, return_inverse=True)[1].astype(np.int64)
        names = int(block.max(initial=0)) + 1
        rank = block[at]
        for k in range(1, period):
            after = np.minimum(at + k, len(x) - 1)
            rank = np.unique(rank * names + block[after], return_inverse=True)[1]
        ranks, step = [rank], period
        while len(at) and int(rank.max()) + 1 < len(at):  # a step is a multiple of the period: its end is sampled as well
            nxt = at + step
            far = np.where(nxt < len(self.number), self.number[np.minimum(nxt, len(self.number) - 1)], -1)
            second = np.where(far >= 0, rank[far] + 1, 0)
            rank = np.unique(rank * (len(at) + 1) + second, return_inverse=True)[1]
            ranks.append(rank)
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.place = np.empty(len(at), np.int64)
        self.place[order] = np.arange(len(at))
        a, b = at[order[:-1]].copy(), at[order[1:]].copy()
        common = np.zeros(max(0, len(at) - 1), np.int64)
        for level in reversed(range(len(ranks))):
            step, ok = period << level, np.flatnonzero(np.maximum(a, b) < len(self.number))
            na, nb = self.number[a[ok]], self.number[b[ok]]
            same = ok[ranks[level][na] == ranks[level][nb]]
            a[same] += step
            b[same] += step
            common[same] += step
        live = np.arange(len(common))
        for _ in range(period):  # fewer words than a block are left
            live = live[np.maximum(a[live], b[live]) < len(x)]
            live = live[x[a[live]] == x[b[live]]]
            if not len(live):
                break
            a[live] += 1
            b[live] += 1
            common[live] += 1
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            t, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(t[:-half], t[half:]))

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j > i on."""
        shift = self.shift[i % self.period, (j - i) % self.period]
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for t in range(self.period):
            live = live[self.x[i[live] + t] == self.x[j[live] + t]] if t else live[self.x[i[live]] == self.x[j[live]]]
            reached = shift[live] == t
            go = live[reached]
            if len(go):
                out[go] = t + self._sampled(i[go] + t, j[go] + t)
            live = live[~reached]
            out[live] = t + 1
        return out

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.place[self.number[i]], self.place[self.number[j]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)  # the least of common[lo:hi]
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            here = level == k
            out[here] = np.minimum(self.table[k][lo[here]], self.table[k][hi[here] - (1 << k)])
        return out


def grid(x: np.ndarray, text: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Places i and periods p of the harmonic grid whose word occurs again p words later in the same text.

    A period is only looked for up to the end of the last text that is long enough for it.
    """
    places, periods = [], []
    sizes = np.bincount(text)
    by_size = np.argsort(-sizes, kind="stable")
    reach = np.maximum.accumulate(np.cumsum(sizes)[by_size])
    for p in range(1, int(sizes.max()) // 2 + 1):
        step = max(p, least - p)  # a run of period p holds such a multiple and the word p after it
        end = reach[np.searchsorted(-sizes[by_size], -2 * p, "right") - 1]
        i = np.flatnonzero(x[:end - p:step] == x[p:end:step]) * step
        if len(i):
            i = i[text[i] == text[i + p]]
            places.append(i)
            periods.append(np.full(len(i), p))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *periods])


def near_agreement(x: np.ndarray, i: np.ndarray, p: np.ndarray, least: int = LEAST, words: int = 8) -> np.ndarray:
    """Grid hits that a comparison of a few words to both sides does not rule out."""
    need = np.maximum(p, least - p)
    got, live = np.zeros(len(i), np.int64), []
    for sign, first in ((1, 0), (-1, 1)):
        open_ = np.arange(len(i))
        for t in range(first, first + words):
            a = i[open_] + sign * t
            ok = (a >= 0) & (a + p[open_] < len(x))
            open_, a = open_[ok], a[ok]
            open_ = open_[x[a] == x[a + p[open_]]]
            got[open_] += 1
        live.append(open_)
    keep = got >= need
    for open_ in live:
        keep[open_] = True
    return keep


def runs(x: np.ndarray, text: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs of ``least`` words or more, by start and period.

    ``x`` holds the texts' words as numbers from 0 on, a negative number of its own after
    each text; ``text`` numbers the text of every word.
    """
    none = (np.empty(0, np.int64),) * 3
    if not len(x):
        return none
    i, p = grid(x, text, least)
    keep = near_agreement(x, i, p, least)
    i, p = i[keep], p[keep]
    if not len(i):
        return none
    # only texts with hits are sorted
    hit = np.zeros(int(text.max()) + 1, bool)
    hit[text[i]] = True
    inside = hit[text]
    old, new = np.flatnonzero(inside), np.cumsum(inside) - 1
    part, i = x[old], new[i]
    right = CommonExtensions(part - part.min()).lce(i, i + p)
    back = part[::-1]
    j = len(part) - i  # the word before i, read backwards
    left = np.zeros(len(i), np.int64)
    some = np.flatnonzero(i > 0)
    left[some] = CommonExtensions(back - back.min()).lce(j[some] - p[some], j[some])
    long = left + right >= np.maximum(p, least - p)
    s, e, p = (i - left)[long], (i + p + right)[long], p[long]
    order = np.lexsort((p, e, s))
    s, e, p = s[order], e[order], p[order]
    first = np.ones(len(s), bool)  # the same stretch is met again at multiples of its period
    first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, p = s[first], e[first], p[first]
    order = np.lexsort((p, s))
    s, e, p = s[order], e[order], p[order]
    return old[s], e - s, p


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words as every tenth id has them: from one place on, the first p words over and over."""
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a:a + p] * times)[:n - a]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """False for the words that a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:n]) == 0


SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, n_runs long, start long, length long, period long, "
          "exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def periodic_runs(docs: DataFrame, change=None, least: int = LEAST, batch: int = BATCH) -> DataFrame:
    """All runs of every text, the longest of them, and the text without its repetitions (as digests).

    ``change(words, doc_id)`` may give other words in place of a text's own.  Null and
    empty texts have no runs; rows that repeat an id or a text are judged each by
    itself; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
    A text is handled whole in one task; memory grows with the longest text.
    """
    def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))  # long texts first: see grid
        ids, texts = [ids[k] for k in order], [texts[k] for k in order]
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + 1)
        x = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        for t, hi, n in zip(texts, ends, sizes):
            x[hi - 1 - n:hi - 1] = [number.setdefault(w, len(number)) for w in t]
        x[ends - 1] = -1 - np.arange(len(texts))
        text = np.repeat(np.arange(len(texts)), sizes + 1)
        s, length, p = runs(x, text, least)
        first = ends - 1 - sizes
        bounds = np.searchsorted(text[s], np.arange(len(texts) + 1))
        s = s - first[text[s]]
        rows = []
        for k, words in enumerate(texts):
            a, b = bounds[k], bounds[k + 1]
            rs, rl, rp = s[a:b], length[a:b], p[a:b]
            listed = "".join(f"{u},{v},{w}\n" for u, v, w in zip(rs.tolist(), rl.tolist(), rp.tolist()))
            best = (None,) * 4
            if b > a:
                at = np.lexsort((rp, rs, -rl))[0]
                best = int(rs[at]), int(rl[at]), int(rp[at]), int(1000 * rl[at] // rp[at])
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), rs, rl, rp))]
            rows.append((ids[k], int(sizes[k]), [{"start": u, "length": v, "period": w} for u, v, w in zip(rs.tolist(), rl.tolist(), rp.tolist())], int(b - a),
                         *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
        cols = list(zip(*rows)) or [[]] * len(TYPES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, TYPES.values())], names=list(TYPES))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for b in it:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), utf8(b, "text")):
                words = text.split()
                texts.append(change(words, doc_id) if change else words)
                ids.append(doc_id)
                size += len(words) + 1
                if size >= batch:
                    yield done(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield done(ids, texts)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


TYPES = {"doc_id": pa.int64(), "n_words": pa.int64(),
         "runs": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
         "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(),
         "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}
