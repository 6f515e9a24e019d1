"""Pluggable scorers for document classification (M2).

A scorer sets up its state once per Python worker and scores batches of texts; the
job around it (:func:`score_documents`) fits each text to the token budget first
(X27, inside the JVM), streams Arrow batches through the scorer, and turns a text that
fails into a row with nulls and the reason instead of a failed job.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from terrasol.functions import text as tx
from terrasol.operators.scoring import RULE_PHRASES, phrase_pattern

#: Texts that a scorer gets at a time.
BATCH = 256


class Scorer(Protocol):
    """What a model has to offer: its labels, its state and scores (0 to 1) per label."""

    labels: Sequence[str]

    def setup(self) -> Any:
        """Whatever scoring needs, made once per worker."""

    def score(self, state: Any, texts: list[str]) -> list[dict[str, float]]:
        """Scores of each text; an exception for a batch of one fails that text alone."""


class RuleScorer:
    """The land-type rules as a plug-in: the share of ``hits`` phrases of a label that a text has."""

    labels = tuple(RULE_PHRASES)

    def __init__(self, hits: int = 2):
        self.hits = hits

    def setup(self):
        phrases = sorted((p for ps in RULE_PHRASES.values() for p in ps), key=lambda p: (-len(p.split()), -len(p), p))
        find = re.compile(" (" + "|".join(map(phrase_pattern, phrases)) + ") ").findall
        return find, {k: [re.compile(phrase_pattern(p)).fullmatch for p in ps] for k, ps in RULE_PHRASES.items()}

    def score(self, state, texts):
        find, phrases = state
        out = []
        for t in texts:
            found = set(find("  " + re.sub(r"[\W_]+", "  ", t.lower()) + "  "))
            out.append({k: min(1.0, sum(any(map(is_, found)) for is_ in ps) / self.hits) for k, ps in phrases.items()})
        return out


def murmur3(data: bytes, seed: int = 42) -> int:
    """Signed 32-bit MurmurHash3, as the hashed term frequencies use it."""
    h, mask = seed, 0xFFFFFFFF
    rotl = lambda x, r: ((x << r) | (x >> (32 - r))) & mask
    for i in range(0, len(data) // 4 * 4, 4):
        k = rotl(int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h = (rotl(h ^ k, 13) * 5 + 0xE6546B64) & mask
    rest = data[len(data) // 4 * 4:]
    if rest:
        h ^= rotl(int.from_bytes(rest, "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & mask
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


class LinearScorer:
    """Trained text classifiers (hashed terms, IDF, logistic regression) as a plug-in, one per label.

    ``models``: label → (weight of each hashed term, its IDF folded in, and intercept),
    see :func:`terrasol.operators.ml.linear_weights`.
    """

    def __init__(self, models: dict[str, tuple[Any, float]], pattern: str = r"[^a-zA-Z_0-9]+"):
        self.labels, self.models, self.pattern = tuple(models), models, pattern

    def setup(self):
        return re.compile(self.pattern), {}, {k: (w.tolist(), b) for k, (w, b) in self.models.items()}

    def score(self, state, texts):
        split, memo, models = state
        out = []
        for t in texts:
            if len(memo) > 200_000:
                memo.clear()
            at = []
            for word in split.split(t.lower()):
                if word:
                    if word not in memo:
                        memo[word] = murmur3(word.encode())
                    at.append(memo[word])
            row = {}
            for label, (w, b) in models.items():
                z = b + math.fsum(w[h % len(w)] for h in at)
                row[label] = 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))
            out.append(row)
        return out


def score_documents(docs: DataFrame, scorer: Scorer, text: str = "pdf_text", context: int | None = None, reserve: int = 1000,
                    batch: int = BATCH) -> DataFrame:
    """All columns of docs with ``{label}_score``, ``scored_chars`` and ``error``.

    With ``context`` a text is cut to the budget first (the longest halving that fits);
    a text that does not fit even so, a null text and one that the scorer fails on have
    null scores and an ``error``.  A batch that fails is scored again text by text, so
    one bad text costs no other its scores.  Columns of the result's names are replaced.
    """
    names = [f"{label}_score" for label in scorer.labels]
    rest = docs.drop(*names, "scored_chars", "error", "_fit")
    fitted = F.col(text)
    if context is not None:
        fitted = tx.fit_budget(text, context, reserve)["text"]
    rows = rest.withColumn("_fit", fitted)
    more = [StructField(n, DoubleType()) for n in names] + [StructField("scored_chars", IntegerType()), StructField("error", StringType())]
    schema = StructType([*rest.schema.fields, *more])
    given, out_names = rest.columns, schema.names

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = scorer.setup()
        for b in it:
            for i in range(0, b.num_rows, batch):
                part = b.slice(i, batch)
                texts = part.column("_fit").to_pylist()
                scores: list[dict | None] = [None] * len(texts)
                errors: list[str | None] = ["no text within the budget" if t is None else None for t in texts]
                todo = [k for k, t in enumerate(texts) if t is not None]
                try:
                    for k, s in zip(todo, scorer.score(state, [texts[k] for k in todo])):
                        scores[k] = s
                except Exception:  # noqa: BLE001  a model may fail in any way: find the texts it fails on
                    for k in todo:
                        try:
                            scores[k] = scorer.score(state, [texts[k]])[0]
                        except Exception as e:  # noqa: BLE001
                            errors[k] = f"{type(e).__name__}: {e}"
                chars = [None if s is None else len(t) for s, t in zip(scores, texts)]
                cols = [pa.array([float(s[label]) if s else None for s in scores], pa.float64()) for label in scorer.labels]
                kept = [part.column(c) for c in given]
                yield pa.RecordBatch.from_arrays([*kept, *cols, pa.array(chars, pa.int32()), pa.array(errors, pa.string())], names=out_names)

    return rows.mapInArrow(run, schema)
