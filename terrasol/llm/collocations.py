"""Phrase collocations by marginalising the longest windows.

Every word opens one window of ``order`` words: itself and its lead columns, padded
where its piece of text ends.  Only these longest windows are counted; the count of
a shorter phrase is the sum over all windows that it begins, and ``ROLLUP`` over
(lang, w1 .. wN) adds those sums up, so no n-gram is exploded by itself.

Before the roll-up, rows that no frequent phrase needs give up their last words (a
window below the threshold its last one, a group of windows below it one more): they
then only add to the prefix sums, which stay exact, and the roll-up shuffles little
more than the frequent phrases and the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasol.llm.common import Scratch, released, utf8

ORDER, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Windows that a task combines before it hands them on, and windows of an Arrow batch.
CHUNK, ROWS = 4_000_000, 100_000
#: Words and heads (all words of a window but the last) are hot from a 1/``HOT_SHARE`` of the windows of a sample of
#: about ``HOT_DOCS`` documents; they are split over ``SALTS`` parts.  This only decides which task counts what, never a count.
HOT_SHARE, HOT_DOCS, SALTS = 500, 2000, 64
#: Lists of one language are cut in this many parts before the last one.
PARTS = 32
#: Bytes that end a piece, as "."; the tab parts words as a space does.
PIECES = bytes.maketrans(b",;:!?\n\v\f\r\t", b".........\x20")


class Words(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def piece_words(text: bytes) -> list[bytes]:
    """Lower-case words of a UTF-8 text, with a ``.`` wherever a piece ends."""
    return text.lower().translate(PIECES).replace(b".", b" . ").split()


def padded_windows(x: np.ndarray, order: int) -> np.ndarray:
    """One column per word of the windows that the words of x open (0: past the end of the piece)."""
    ends = np.concatenate([x, np.zeros(order, x.dtype)])
    lead = [ends[k:k + len(x)] for k in range(order)]
    for k in range(1, order):
        lead[k] = np.where(lead[k - 1] == 0, 0, lead[k])
    return np.stack(lead)[:, x != 0]


def counted_windows(windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows (one column each) and how often they occur; words are numbered below ``size``."""
    bits = max(1, int(size - 1).bit_length())
    key = windows[0].astype(np.int64)
    if bits * len(windows) <= 63:
        for w in windows[1:]:
            key = key << bits | w
        key, n = np.unique(key, return_counts=True)
        mask = (1 << bits) - 1
        return np.stack([key >> bits * k & mask for k in reversed(range(len(windows)))]), n
    for w in windows[1:]:  # so many words that only numbers of distinct prefixes fit
        key = np.unique(key, return_inverse=True)[1] << bits | w
    _, at, n = np.unique(key, return_index=True, return_counts=True)
    return windows[:, at], n


def spread_salts(windows: np.ndarray, names: list[bytes], lang: str, hot: frozenset[str]) -> np.ndarray:
    """Per window the part of its first word's group: 0, or of a hot word by its second word, of a hot head by its last one."""
    import xxhash
    salt = np.zeros(windows.shape[1], np.int64)
    part = lambda i: 1 + xxhash.xxh3_64_intdigest(names[i]) % SALTS
    tag = b" " + lang.encode()
    first = [i for i in np.unique(windows[0]).tolist() if (names[i] + tag).decode() in hot]
    for i in first:
        at = np.flatnonzero(windows[0] == i)
        if len(windows) > 2:
            second, where = np.unique(windows[1, at], return_inverse=True)
            salt[at] = np.array([part(j) for j in second.tolist()])[where]
        else:
            second, where = np.empty(0, np.int64), None
        heads = second.tolist() if len(windows) > 2 else [None]
        for k, j in enumerate(heads):
            if len(windows) == 2 or (names[i] + b" " + names[j] + tag).decode() in hot:
                own = at if where is None else at[where == k]
                last, back = np.unique(windows[-1, own], return_inverse=True)
                salt[own] += (SALTS + 1) * np.array([part(m) for m in last.tolist()])[back]
    return salt


def window_counts(docs: DataFrame, order: int = ORDER, hot: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """``first, salt, rest``: windows counted within chunks of a task's texts.

    ``first`` holds the first word and the language, parted by a space; ``rest`` has a
    line per distinct window: its other words (empty past the end) and its count.  A
    hot word has several rows by ``salt``; from ``SALTS`` + 1 on a salt is that of a hot head.
    """
    split = frozenset(hot or ())

    def rows(acc: dict[str, list[np.ndarray]], words: Words) -> Iterator[pa.RecordBatch]:
        names = list(words)
        names[0] = b""
        strings = pa.array(names, pa.binary()).cast(pa.string())
        for lang, parts in acc.items():
            windows, n = counted_windows(padded_windows(np.concatenate(parts), order), len(words))
            salt = spread_salts(windows, names, lang, split) if split else np.zeros(len(n), np.int64)
            if salt.any():
                by = np.lexsort((salt, windows[0]))
                windows, n, salt = windows[:, by], n[by], salt[by]
            starts = np.flatnonzero(np.diff(windows[0], prepend=-1) | np.diff(salt, prepend=-1))
            ends = np.append(starts[1:], len(n))
            k = 0
            while k < len(starts):  # whole groups, about ROWS windows at a time
                m = max(k + 1, int(np.searchsorted(ends, starts[k] + ROWS, "right")))
                lo, hi = starts[k], ends[m - 1]
                lines = pc.binary_join_element_wise(*(strings.take(pa.array(x[lo:hi])) for x in windows[1:]), pa.array(n[lo:hi]).cast(pa.string()), " ")
                groups = pa.ListArray.from_arrays(pa.array(np.append(starts[k:m], hi) - lo, pa.int32()), lines)
                first = pc.binary_join_element_wise(strings.take(pa.array(windows[0, starts[k:m]])), pa.scalar(lang), " ")
                yield pa.RecordBatch.from_arrays([first, pa.array(salt[starts[k:m]], pa.int32()), pc.binary_join(groups, "\n")], names=["first", "salt", "rest"])
                k = m

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, acc, size = Words(), {}, 0
        for b in it:
            for lang, text in zip(b.column("lang").to_pylist(), utf8(b, "text")):
                x = np.array([*map(words.__getitem__, piece_words(text)), 0], np.int32)
                acc.setdefault("und" if lang is None else lang, []).append(x)
                size += len(x)
                if size >= chunk:
                    yield from rows(acc, words)
                    words, acc, size = Words(), {}, 0
        yield from rows(acc, words)

    return docs.select("lang", "text").mapInArrow(released(run), "first string, salt int, rest string")


def opened(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``first, salt, w2 .. wN, c``: one row per window again."""
    entry = F.split("line", " ")
    words = [F.get(entry, k - 2).alias(f"w{k}") for k in range(2, order + 1)]
    lines = counts.select("first", "salt", F.explode(F.split("rest", "\n")).alias("line"))
    return lines.select("first", "salt", *words, F.get(entry, order - 1).cast("long").alias("c"))


def hot_heads(docs: DataFrame, order: int = ORDER, sample: int = HOT_DOCS) -> list[str]:
    """First words and heads, each with its language, that hold over a ``HOT_SHARE``-th of a sample's windows.

    At most ``order`` times ``HOT_SHARE`` of them, whatever the sample holds.
    """
    n = docs.count()
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, sample / max(1, n)) * (1 << 30))
    some = opened(window_counts(docs.where(draw), order), order)
    head = F.concat_ws(" ", F.substring_index("first", " ", 1), *(f"w{k}" for k in range(2, order)), F.expr("substring(first, length(substring_index(first, ' ', 1)) + 2)"))
    both = some.select(F.explode(F.array_distinct(F.array(F.col("first"), head))).alias("head"), "c").groupBy("head").agg(F.sum("c").alias("c"))
    total = some.agg(F.sum("c")).first()[0] or 0
    return [r["head"] for r in both.where(F.col("c") * HOT_SHARE >= max(total, HOT_SHARE * LEAST)).select("head").collect()]


def phrase_counts(docs: DataFrame, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """``lang, words, f``: occurrences of every phrase of 1 to ``order`` words from ``least`` on.

    ``words`` is the array of its words; the empty array stands for all words of the
    language, however few.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    texts = docs.select("lang", "text")
    counts = window_counts(texts, order, hot_heads(texts, order)).repartition("first", "salt")
    *inner, last = [f"w{k}" for k in range(2, order + 1)]
    head = ["first", "salt", *inner]
    whole = opened(counts, order).groupBy(*head, last).agg(F.sum("c").alias("c"))
    # a window below the threshold gives up its last word; a frequent one leaves a mark on its head
    frequent = (F.col("c") >= least) & (F.col(last) != "")
    row = lambda w, c, mark: F.struct(w.alias(last), c.alias("c"), F.lit(mark).alias("mark"))
    none = F.lit("")
    kept = whole.select(*head, F.inline(
        F.when(frequent, F.array(row(F.col(last), F.col("c"), 1), row(none, F.lit(0).cast("long"), 1)))
        .otherwise(F.array(row(none, F.col("c"), 0)))))
    kept = kept.groupBy(*head, last).agg(F.sum("c").alias("c"), F.max("mark").alias("mark"))
    # a head below the threshold gives up its last word as well (that of a salted head is in several rows: it is frequent)
    rare = (F.col("mark") == 0) & (F.col("salt") <= SALTS) & (F.col("c") < least) if inner else F.lit(False)
    part = F.split("first", " ", 2)  # the language stands last and may hold spaces
    w = [F.get(part, 0), *map(F.col, inner)]
    w[-1] = F.when(rare, "").otherwise(w[-1])
    names = [f"w{k + 1}" for k in range(order)]
    kept = kept.select(F.get(part, 1).alias("lang"), *(x.alias(n) for x, n in zip(w, names)), F.col(last).alias(names[-1]), "c")
    kept = kept.groupBy("lang", *names).agg(F.sum("c").alias("c"))
    rolled = kept.rollup("lang", *names).agg(F.sum("c").alias("f"), F.grouping_id().alias("g"))
    whole_phrases = F.lit(False)
    words = F.array().cast("array<string>")
    for k in range(order + 1):  # g has one bit per column that the sum runs over
        here = F.col("g") == (1 << (order - k)) - 1
        whole_phrases = whole_phrases | (here & (F.col(names[k - 1]) != "" if k else F.lit(True)) & ((F.col("f") >= least) if k else F.lit(True)))
        words = F.when(here, F.array(*names[:k]).cast("array<string>")).otherwise(words) if k else words
    return rolled.where(whole_phrases).select("lang", words.alias("words"), "f")


def exact_score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in 38 digits."""
    wide = lambda x: x.cast("decimal(19,0)")
    top = (F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)).cast("decimal(30,0)")).cast("decimal(38,0)")
    below = (wide(l) * wide(r)).cast("decimal(38,0)")
    return F.call_function("div", top, below)


def collocations(docs: DataFrame, order: int = ORDER, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The best phrases of 2 to ``order`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is scored by floor(1000000 a a / (l r)) at its lowest-scoring cut (ties:
    the leftmost) and dropped when a longer candidate around it has ``share`` percent
    of its occurrences.  A null language is ``und``; null and empty texts hold no
    words; repeated rows count each; an empty table gives an empty result; of docs
    only ``lang`` and ``text`` are read.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    counts = scratch.save(phrase_counts(docs, order, least), "counts")
    phrase = F.array_join("words", " ")
    known = counts.where(F.size("words") > 0).select("lang", phrase.alias("phrase"), "words", "f")
    cands = known.where(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = cands.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    joined = lambda *s: F.array_join(F.slice("words", *s), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"),
                       joined(F.col("k") + 1, F.size("words")).alias("right"))
    left, right = (known.select("lang", F.col("phrase").alias(side), F.col("f").alias(c)) for side, c in (("left", "l"), ("right", "r")))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    best = F.min(F.struct(exact_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), best.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    # shorter phrases inside the candidates, and the most that a candidate around them occurs
    inner = cands.where(F.size("words") > 2).select("a", "lang", F.explode(F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))")).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a")))
    order_by = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # two levels, so that the last one sees at most PARTS lists of a language
    kept = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order_by))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
