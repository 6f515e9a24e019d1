"""Chat formatting: typed content parts flattened into one training text.

A message is an ordered list of typed parts.  A visitor turns each part into
text: a text part into itself with control strings escaped, an image, audio or
document part into a placeholder whose attachment reference and expanded token
count are recorded in order.  Everything is Column code.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasol.llm.common import running

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


@dataclass(frozen=True)
class Template:
    """Marks of a turn, ``<|turn|>role<|text|>body<|end|>``, and what an attachment expands to."""

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    #: Control strings of other formats that texts may not smuggle in either.
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    patch: int = 14
    tokens_per_second: float = 25.0
    tokens_per_page: int = 512
    loss_roles: tuple[str, ...] = ("assistant",)

    def placeholder(self, kind: str) -> str:
        return f"<|{kind}|>"

    @property
    def controls(self) -> list[str]:
        return [self.turn, self.text, self.end, *(self.placeholder(k) for k in ("image", "audio", "document")), *self.foreign]

    def _tails(self) -> str:
        """What may follow the first character of a control string, longest first."""
        plain = {c[1:] for c in self.controls}
        quote = lambda s: "".join("\\" + c if not c.isalnum() else c for c in s)
        return "|".join(quote(t) for t in sorted(plain, key=lambda t: (-len(t), t)))

    def _heads(self) -> str:
        return "[" + "".join("\\" + c for c in sorted({c[0] for c in self.controls})) + "]"

    def escape(self, text) -> Column:
        """Put one more backslash after the first character of a control string (however many stand there already)."""
        text = F.col(text) if isinstance(text, str) else text
        done = F.regexp_replace(text, F.lit(rf"({self._heads()})(\\*)(?={self._tails()})"), F.lit(r"$1\\$2"))
        return F.when(self._any(text, {c[0] for c in self.controls}), done).otherwise(text)

    def unescape(self, text) -> Column:
        text = F.col(text) if isinstance(text, str) else text
        done = F.regexp_replace(text, F.lit(rf"({self._heads()})\\(\\*)(?={self._tails()})"), F.lit("$1$2"))
        return F.when(text.contains("\\"), done).otherwise(text)

    @staticmethod
    def _any(text: Column, characters) -> Column:
        """A cheap test that most texts fail, before the pattern is tried."""
        out = F.lit(False)
        for c in sorted(characters):
            out = out | text.contains(c)
        return out


def expanded_tokens(part: Column, t: Template) -> Column:
    """Tokens that an attachment stands for: patches of an image, seconds of audio, pages of a document."""
    patches = lambda side: F.ceil(F.coalesce(part[side], F.lit(0)) / t.patch)
    return (F.when(part["type"] == "image", patches("width") * patches("height"))
            .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * t.tokens_per_second))
            .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * t.tokens_per_page)
            .otherwise(0).cast("long"))


def visited(parts: Column, t: Template) -> Column:
    """The parts of a message as one text: texts (and parts of unknown type) escaped, attachments as placeholders.

    Texts that stand side by side are escaped as the one text they become, so no control
    string arises where two of them meet; a placeholder parts them.
    """
    kinds = ("image", "audio", "document")
    mark = lambda p: reduce(lambda out, k: F.when(p["type"] == k, F.lit(t.placeholder(k))).otherwise(out), kinds, F.lit(None).cast("string"))
    text = lambda p: F.coalesce(p["text"], F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("run"))

    def step(acc, p):
        put = F.struct(F.concat(acc["out"], t.escape(acc["run"]), mark(p)).alias("out"), F.lit("").alias("run"))
        return F.when(mark(p).isNotNull(), put).otherwise(F.struct(acc["out"].alias("out"), F.concat(acc["run"], text(p)).alias("run")))

    mixed = F.aggregate(parts, start, step, lambda acc: F.concat(acc["out"], t.escape(acc["run"])))
    plain = t.escape(F.array_join(F.transform(parts, text), ""))
    return F.when(F.exists(parts, lambda p: F.coalesce(p["type"].isin(*kinds), F.lit(False))), mixed).otherwise(plain)


def format_turns(messages: DataFrame, t: Template = Template()) -> DataFrame:
    """``conv_id, turn, role, formatted, start, loss, attachments`` per message.

    ``messages`` holds ``conv_id, turn, role, parts`` (see :data:`PARTS`; null:
    no parts).  ``start`` is the offset of the formatted turn in its conversation
    and ``loss`` the span of the body in it, both in code points; ``loss`` is null
    for roles that are not trained on.  Turns go by turn (null first), then role
    and text; a null role is the empty role; repeated rows are turns of their own.
    """
    body = visited(F.coalesce("parts", F.array().cast(PARTS)), t)
    role = F.coalesce("role", F.lit(""))
    kept = F.filter("parts", lambda p: p["type"].isin("image", "audio", "document"))
    rows = (messages.withColumn("_body", body).withColumn("_role", role)
            .withColumn("_head", F.concat(F.lit(t.turn), t.escape(F.col("_role")), F.lit(t.text)))
            .withColumn("formatted", F.concat("_head", "_body", F.lit(t.end)))
            .withColumn("attachments", F.coalesce(F.transform(kept, lambda p: F.struct(
                p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p, t).alias("tokens"))),
                F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>"))))
    before = Window.partitionBy("conv_id").orderBy("turn", "_role", "_body").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("formatted")).over(before), F.lit(0)).cast("long")
    first = F.col("start") + F.length("_head")
    return rows.withColumn("start", start).select(
        "conv_id", "turn", F.col("_role").alias("role"), "formatted", "start",
        F.when(F.col("_role").isin(*t.loss_roles), F.struct(first.alias("first"), (first + F.length("_body")).alias("end"))).alias("loss"),
        "attachments")


def format_conversations(messages: DataFrame, t: Template = Template()) -> DataFrame:
    """``conv_id, formatted, loss_spans, attachments`` per conversation.

    A conversation is one text, so its turns meet in one row; they are shuffled
    once, by conversation.  Rows with a null conv_id form one conversation.  An
    empty table gives an empty result.
    """
    turns = format_turns(messages, t)
    ordered = F.array_sort(F.collect_list(F.struct("start", "formatted", "loss", "attachments")))
    return (turns.groupBy("conv_id").agg(ordered.alias("_t"))
            .select("conv_id", F.array_join("_t.formatted", "").alias("formatted"),
                    F.filter("_t.loss", lambda s: s.isNotNull()).alias("loss_spans"),
                    F.flatten("_t.attachments").alias("attachments")))


def read_back(df: DataFrame, t: Template = Template()) -> DataFrame:
    """Add ``turns`` to rows with ``formatted``: ``role, text`` unescaped, and the body's span ``first, end`` in code points."""
    quote = lambda s: "".join("\\" + c if not c.isalnum() else c for c in s)
    mark = lambda p: F.instr(p, t.text)
    head = lambda p: mark(p) - 1 + len(t.text)
    body = lambda p: F.length(p) - head(p) - len(t.end)
    # text before the first turn mark is empty; every other piece is a turn without its mark
    df = df.withColumn("_pieces", F.split("formatted", quote(t.turn))).withColumn("_pieces", F.slice("_pieces", F.lit(2), F.size("_pieces")))
    df = df.withColumn("_before", running(F.transform("_pieces", lambda p: F.length(p) + len(t.turn))))
    first = lambda p, i: (F.get("_before", i) + len(t.turn) + head(p)).cast("long")
    return df.withColumn("turns", F.transform("_pieces", lambda p, i: F.struct(
        t.unescape(F.substring(p, F.lit(1), mark(p) - 1)).alias("role"),
        t.unescape(F.substring(p, head(p) + 1, body(p))).alias("text"),
        first(p, i).alias("first"), (first(p, i) + body(p)).alias("end")))).drop("_pieces", "_before")


def masked(turns, loss_spans) -> Column:
    """The turns whose body stands under the loss mask."""
    spans = F.transform(loss_spans, lambda s: F.struct(s["first"], s["end"]))
    return F.filter(turns, lambda x: F.array_contains(spans, F.struct(x["first"], x["end"])))
