"""Chat formatting of typed content parts.

A message is a row (conversation, turn, role, parts); a part has a kind and what that kind needs.  A visitor
(``visit``: one rule per kind) flattens each part: text is escaped, an image, audio or document part becomes an ordered
placeholder, and its reference is recorded with the tokens that the placeholder expands to.  A conversation is one
string::

    <|turn|>role<|says|>part<|next|>part<|end|><|turn|>...

Control strings begin with ``<|``; inside texts and roles every ``<``, backslashes, ``|`` gets one more backslash, so
``<|`` occurs only where the template puts it and the escape is undone exactly.  The loss mask is a list of spans
(code points, and bytes of UTF-8) over the bodies of the trained roles.  ``read_back`` takes a formatted string
apart again and ``masked_texts`` reads the mask; both use the output alone.

All of it is DataFrame functions: one shuffle by conversation, offsets by running sums over a conversation's turns.  A
conversation is one row of output, so the longest one must fit a row.

Defined results: rows are ordered by turn (null last), then role and text, equal rows being turns of their own; a null
text or role is empty; a null id is a conversation of its own; a null or empty list of parts is an empty body; an
unknown or null kind counts as text; an empty table gives no rows.  Columns that are not named take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, SAYS, NEXT, CLOSE = "<|turn|>", "<|says|>", "<|next|>", "<|end|>"
KINDS = ("image", "audio", "document")
#: width and height in pixels, seconds, pages: what a kind's token count is taken from.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens: an image has one per tile of 28 x 28 pixels and two ends, audio 25 a second, a document 256 a page.
TILE, PER_SECOND, PER_PAGE = 28, 25.0, 256


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_part(text: Column) -> Column:
    """A list of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[
        F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def tokens_of(part: Column) -> Column:
    """Tokens that the placeholder of a part expands to; 0 where its size is not known, and for text."""
    def tiles(c):
        return F.ceil(F.greatest(c, F.lit(0)) / TILE)
    sized = part["width"].isNotNull() & part["height"].isNotNull()
    n = (F.when((part["kind"] == "image") & sized, tiles(part["width"]) * tiles(part["height"]) + 2).when(part["kind"] == "audio", F.ceil(F.greatest(part["seconds"], F.lit(0.0)) * PER_SECOND))
         .when(part["kind"] == "document", F.greatest(part["pages"], F.lit(0)).cast("long") * PER_PAGE))
    return F.coalesce(n.cast("long"), F.lit(0).cast("long"))


def visit(part: Column) -> Column:
    """What a part is flattened to."""
    out = escape(part["text"])
    for kind in KINDS:
        out = F.when(part["kind"] == kind, F.lit(f"<|{kind}|>")).otherwise(out)
    return out


def format_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts",
                         trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, loss_spans, attachments, n_tokens_attached): a row for each conversation.  ``loss_spans``:
    (start, length, byte_start, byte_length) of the trained bodies; ``attachments``: (at, turn, part, kind, ref, tokens) in
    the order of their placeholders, turns and parts counted from 0."""
    parts = F.coalesce(F.col(parts_col), F.array().cast(messages.schema[parts_col].dataType))
    parts = F.transform(parts, lambda p, i: F.struct(i.alias("i"), p["kind"].alias("kind"), p["text"].alias("text"), p["ref"].alias("ref"),
                                                     p["width"].alias("width"), p["height"].alias("height"), p["seconds"].alias("seconds"), p["pages"].alias("pages")))
    found = F.transform(F.filter("p", lambda p: p["kind"].isin(*KINDS)), lambda p: F.struct(
        p["i"].cast("int").alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), tokens_of(p).alias("tokens")))
    rows = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("t"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), parts.alias("p"))
    rows = rows.select("conv_id", "t", "role", F.array_join(F.transform("p", visit), NEXT).alias("body"), found.alias("found"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAYS))
    rows = rows.withColumn("head", head).withColumn("segment", F.concat("head", "body", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy(F.col("t").asc_nulls_last(), "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def start(size):
        return F.coalesce(F.sum(size(F.col("segment"))).over(before), F.lit(0)) + size(F.col("head"))
    rows = rows.select("conv_id", (F.row_number().over(order) - 1).alias("n"), "segment", "found", F.when(F.col("role").isin(*trained), F.struct(
        start(F.char_length).alias("start"), F.char_length("body").cast("long").alias("length"),
        start(F.octet_length).alias("byte_start"), F.octet_length("body").cast("long").alias("byte_length"))).alias("span"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "segment", "span", "found"))).alias("turns"))
    attached = F.flatten(F.transform("turns", lambda t: F.transform(t["found"], lambda a: F.struct(
        t["n"].alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    numbered = F.transform(attached, lambda a, i: F.struct(i.cast("int").alias("at"), a["turn"].alias("turn"), a["part"].alias("part"),
                                                           a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"),
                        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"), numbered.alias("attachments"),
                        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.aggregate(t["found"], F.lit(0).cast("long"), lambda m, a: m + a["tokens"]))
                        .alias("n_tokens_attached"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: list of (role, parts), a part being (kind, text); placeholders have no text."""
    segments = F.filter(F.split(formatted, r"<\|turn\|>"), lambda _, i: i > 0)

    def part(p):
        kind = F.lit("text")
        for k in KINDS:
            kind = F.when(p == f"<|{k}|>", k).otherwise(kind)
        return F.struct(kind.alias("kind"), F.when(~p.isin(*[f"<|{k}|>" for k in KINDS]), unescape(p)).alias("text"))

    def turn(s):
        fields = F.split(s, r"<\|says\|>|<\|end\|>")
        return F.struct(unescape(fields[0]).alias("role"), F.transform(F.split(fields[1], r"<\|next\|>"), part).alias("parts"))
    return F.transform(segments, turn)


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The text parts under each span of the loss mask, unescaped and joined (placeholders carry no text)."""
    def text(body):
        parts = F.filter(F.split(body, r"<\|next\|>"), lambda p: ~p.isin(*[f"<|{k}|>" for k in KINDS]))
        return unescape(F.array_join(parts, ""))
    cut = F.transform(F.array(formatted.cast("binary")), lambda b: F.transform(
        spans, lambda s: text(F.substring(b, (s["byte_start"] + 1).cast("int"), s["byte_length"].cast("int")).cast("string"))))
    return cut[0]


def query(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = (F.lit(-7), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said))
    more = spark.range(2).select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(extra, rows.schema)])
    out = format_conversations(rows.unionByName(more).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    read = out.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
                      F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    def body(t):
        return F.array_join(F.transform(t["parts"], lambda p: F.coalesce(p["text"], F.lit(""))), "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), body(t), F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, 8 + 8 + 7 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS n FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
