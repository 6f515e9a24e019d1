"""Text cleaning, context spans, chunking, budgets and highlighting.

All functions are Column expressions (Java regex + array higher-order
functions), evaluated inside whole-stage codegen, one row at a time in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrasol.functions.common import WS, col, strip

# Placeholder written by the PDF-to-markdown step, context separator.
IMAGE_PLACEHOLDER = r"==> picture \[[0-9]{0,4} x [0-9]{0,4}\] intentionally omitted <=="
CONTEXT_SEP = "[SEP]"


def clean_text(c) -> Column:
    """Drop image placeholders, collapse runs of 2+ spaces, drop NUL."""
    t = F.regexp_replace(col(c), IMAGE_PLACEHOLDER, "")
    t = F.regexp_replace(t, " {2,}", " ")
    return F.replace(t, F.lit("\x00"), F.lit(""))


def split_contexts(c) -> Column:
    """Cleaned context string split on the literal ``[SEP]``."""
    return F.split(clean_text(c), r"\Q[SEP]\E")


def context_locations(text, contexts) -> Column:
    """struct(start, length) per context: 0-based start of the stripped context,
    un-stripped length; start = -1 when absent (X24, bad rows kept visible)."""
    return F.transform(col(contexts), lambda x: F.struct(
        (F.position(strip(x), col(text)) - 1).alias("start"), F.length(x).alias("length")))


def sorted_labels(c, sep: str = ", ") -> Column:
    """``land_type`` string to a code-point-sorted label array."""
    return F.array_sort(F.split(col(c), sep))


def tokens(c) -> Column:
    """Whitespace tokens (the deterministic default token counter)."""
    return F.filter(F.split(col(c), f"{WS}+"), lambda t: t != "")


def chunk_starts(n_tokens, max_tokens: int, stride: int) -> Column:
    step = max_tokens - stride
    if step <= 0:
        raise ValueError("max_tokens - stride must be positive")
    n = col(n_tokens)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))


def chunks(c, max_tokens: int = 256, stride: int = 10) -> Column:
    """Token windows of ``max_tokens`` starting every ``max_tokens - stride`` tokens."""
    # the tokens as a variable of an outer lambda: written into the inner one, every window would split the text anew
    cut = lambda toks: F.transform(chunk_starts(F.size(toks), max_tokens, stride),
                                   lambda s: F.slice(toks, s + 1, max_tokens))
    return F.get(F.transform(F.array(tokens(c)), cut), 0)


def fit_budget(c, context: int, reserve: int = 1000, max_halvings: int = 40) -> Column:
    """Longest prefix ``text[:floor(len/2^k)]`` whose token count + reserve fits."""
    t = col(c)
    cands = F.transform(F.sequence(F.lit(0), F.lit(max_halvings)), lambda k: F.struct(
        F.floor(F.length(t) / F.pow(F.lit(2.0), k)).cast("int").alias("n")))
    cands = F.transform(cands, lambda s: F.struct(
        s["n"].alias("n"), F.size(tokens(F.substring(t, 1, s["n"]))).alias("tokens")))
    first = F.get(F.filter(cands, lambda s: s["tokens"] + reserve <= context), 0)
    return F.struct(F.substring(t, 1, first["n"]).alias("text"), first["n"].alias("n_chars"),
                    first["tokens"].alias("n_tokens"))


def highlight(text, contexts, tag: str = "mark") -> Column:
    """Wrap every case-insensitive occurrence of each stripped context in a tag."""
    def step(acc, ctx):
        c = strip(ctx)
        return F.when(c == "", acc).otherwise(
            F.regexp_replace(acc, F.concat(F.lit("(?iu)(\\Q"), c, F.lit("\\E)")),
                             F.lit(f"<{tag}>$1</{tag}>")))
    return F.aggregate(col(contexts), col(text), step)


def fold_keywords(c) -> Column:
    """lower case and ``ï`` → ``i``."""
    return F.translate(F.lower(col(c)), "ï", "i")
