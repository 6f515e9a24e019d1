"""Quality classifier: hashed n-gram logistic regression trained with FTRL.

Features are hashed 1- and 2-grams of words and 1- to 3-grams of word shapes
(lower, title or upper case, digits, the punctuation itself, a repeat of the word
before).  A text's value of a feature is its share of the n-grams, so the score
of a text is a sparse dot product.  Training reads a bounded sample of labelled
rows, in shards that run follow-the-regularised-leader one row after the other;
the model is the mean of the shards' weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.llm.common import id_crc, mix, release, small_batches

BITS = 18
#: Bound of the training sample (labelled rows) and the shards it is dealt over.
MAX_TRAIN, SHARDS, EPOCHS = 20_000, 8, 3
SCALE = 20.0
TOKEN = r"\w+|[^\w\s]+"


class Features:
    """Hashed n-gram indices of a text."""

    def __init__(self, bits: int = BITS, limit: int = 120_000):
        import xxhash
        self.hash, self.mask, self.limit = xxhash.xxh3_64_intdigest, np.uint64((1 << bits) - 1), limit
        self.find = re.compile(TOKEN).findall
        self.memo: dict[str, tuple[int, int]] = {}

    def _word(self, w: str) -> tuple[int, int]:
        if len(self.memo) >= self.limit:
            self.memo.clear()
        if not w[0].isalnum():
            shape = w[:2]
        elif w.isdigit():
            shape = "9"
        else:
            shape = "u" if len(w) > 1 and w.isupper() else "t" if w[0].isupper() else "l"
        got = self.memo[w] = (self.hash(w.lower().encode()), self.hash(b"\0" + shape.encode()))
        return got

    def __call__(self, text: str) -> np.ndarray:
        """Feature indices, one per n-gram occurrence."""
        tokens, memo = self.find(text), self.memo
        if not tokens:
            return np.empty(0, np.int64)
        pairs = [memo.get(w) or self._word(w) for w in tokens]
        both = np.array(pairs, np.uint64)
        word, shape = both[:, 0], both[:, 1].copy()
        shape[1:][word[1:] == word[:-1]] ^= np.uint64(0x5555)
        with np.errstate(over="ignore"):
            grams = [word, word[:-1] * np.uint64(3) + word[1:], shape, shape[:-1] * np.uint64(5) + shape[1:],
                     shape[:-2] * np.uint64(7) + shape[1:-1] * np.uint64(11) + shape[2:]]
            return (mix(np.concatenate(grams)) & self.mask).astype(np.int64)


def ftrl(texts: list[str], labels: list[int], bits: int = BITS, epochs: int = EPOCHS,
         alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights (the last one is the bias) after FTRL-proximal passes in the given order."""
    features = Features(bits)
    rows = []
    for t in texts:
        idx, n = np.unique(features(t), return_counts=True)
        # kept small: a shard holds a bounded number of rows, but long texts have many features
        rows.append((np.append(idx, 1 << bits).astype(np.int32), np.append(n * (SCALE / max(1, n.sum())), 1.0).astype(np.float32)))
    z, s = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(s[i])) / alpha + l2))

    for _ in range(epochs):
        for (i, x), y in zip(rows, labels):
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            sigma = (np.sqrt(s[i] + g * g) - np.sqrt(s[i])) / alpha
            z[i] += g - sigma * w
            s[i] += g * g
    return weights(slice(None))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, bits: int = BITS) -> np.ndarray:
    """Weights learned from labelled rows whose crc32(doc_id) mod 3 is not 1.

    At most about ``max_train`` rows (chosen by a hash of the id, all if there
    are fewer) take part; rows with a null id or label do not.  Without any
    labelled row all weights are 0.
    """
    fit = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (id_crc() % 3 != 1)).groupBy("doc_id").agg(F.max("quality").alias("_y"))
    n = fit.count()
    share = min(1.0, max_train / max(1, n))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(8)), F.lit(1 << 30))
    chosen = fit.where(draw < int(share * (1 << 30)))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .withColumn("_shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)))
            .withColumn("_draw", F.xxhash64("doc_id", F.lit(1))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(text=pdf["text"].fillna("")).sort_values(["_draw", "doc_id", "text"])
        w = ftrl(pdf["text"].tolist(), pdf["_y"].tolist(), bits)
        release()
        return pd.DataFrame({"n": [len(pdf)], "w": [w.astype(np.float32).tobytes()]})

    # at most SHARDS weight vectors of fixed size
    got = sorted((r.n, bytes(r.w)) for r in rows.groupBy("_shard").applyInPandas(run, "n long, w binary").collect())
    if not got:
        return np.zeros((1 << bits) + 1)
    return sum(n * np.frombuffer(w, np.float32).astype(float) for n, w in got) / sum(n for n, _ in got)


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, text: Column | str = "text") -> DataFrame:
    """All columns of docs and ``score`` (0 to 1), replacing a column of that name.

    Null and empty texts get the bias alone; rows that repeat one another get one
    score; an empty table stays empty.  Only the texts travel to Python.
    """
    small_batches(docs.sparkSession)
    weights = weights.astype(np.float32)

    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features, w, bias = Features(bits), weights[:-1], float(weights[-1])
        for column in it:
            out = []
            for i in range(0, len(column), 1000):  # few texts at a time as Python strings
                for t in column.slice(i, 1000).to_pylist():
                    idx = features(t or "")
                    z = bias + (float(w[idx].sum(dtype=np.float64)) * SCALE / len(idx) if len(idx) else 0.0)
                    out.append(1 / (1 + np.exp(-min(max(z, -35.0), 35.0))))
            yield pa.array(out, pa.float64())

    def ending(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(it)
        release()

    return docs.withColumn("score", F.arrow_udf(ending, "double")(text))
