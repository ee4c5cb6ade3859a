"""Conversations as training text, with typed content parts and a loss mask. DataFrame functions only.

A turn is written as ``<|turn|>role<|says|>content<|end|>``. The content is made by visiting the turn's parts in order: a
text part gives its text, and an image, audio or document part gives a placeholder such as ``<|image:3|>``, numbered
over the whole conversation. Each placeholder is recorded as an attachment: its number, type, reference, and how many
tokens it stands for once expanded (see ``_part_tokens``). A part of another type is one of type ``unknown`` with no tokens.

Inside texts and roles, ``<`` before a bar or at the end of a part is written as ``\\l``, and a backslash before ``l`` or
``s`` or at the end of a part as ``\\s``. So no text can look like a control string, and ``unescaped`` undoes it exactly.

The loss mask is a list of spans (start, stop) of code points of the formatted text: the text parts of turns by ``assistant``.

Defined cases: a null text is an empty one; so is a null role. A null list of parts, or a null part, is no part. Turns are
ordered by turn (null first), then role, then content; repeated rows are turns of their own. Rows with a null id form
one conversation. Other columns are not read. An empty table gives no conversations. A conversation is one row, so its
turns meet in one task; that is bounded by the longest single conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankdrift.llm.common import table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PART_TYPE = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
#: Pixels on a side of an image patch, audio frames in a second, tokens for a page.
PATCH, FRAMES, PAGE = 28, 12.5, 256
_ATTACHED = ("image", "audio", "document")


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\(?=[ls]|\z)", r"\\s"), r"<(?=\||\z)", r"\\l")


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """The parts of a turn that has nothing but a text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text")).cast("struct<type: string, text: string>"))


def _field(part: Column, name: str, names: list[str], kind: str) -> Column:
    return part[name].cast(kind) if name in names else F.lit(None).cast(kind)


def _part_tokens(kind: Column, part: Column, names: list[str]) -> Column:
    get = lambda name, t: F.greatest(F.coalesce(_field(part, name, names, t), F.lit(0).cast(t)), F.lit(0).cast(t))
    patches = F.ceil(get("width", "int") / PATCH) * F.ceil(get("height", "int") / PATCH)
    return (
        F.when(kind == "image", F.greatest(patches, F.lit(1)))
        .when(kind == "audio", F.ceil(get("seconds", "double") * FRAMES))
        .when(kind == "document", get("pages", "int").cast("long") * PAGE)
        .otherwise(F.lit(0))
        .cast("long")
    )


def format_conversations(turns: DataFrame, parts_col: str = "parts") -> DataFrame:
    """A row for each conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens.

    ``turns`` has conv_id, turn, role and a list of parts: structs with ``type`` and ``text``, and those of ``ref``, ``width``,
    ``height``, ``seconds`` and ``pages`` that occur.
    """
    element = turns.schema[parts_col].dataType.elementType
    names = element.fieldNames()
    is_text = lambda p: F.coalesce(p["type"], F.lit("text")) == "text"
    kind = lambda p: F.when(p["type"].isin(*_ATTACHED), p["type"]).otherwise(F.lit("unknown"))
    parts = F.filter(F.coalesce(F.col(parts_col), F.array().cast(f"array<{element.simpleString()}>")), lambda p: p.isNotNull())
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), parts.alias("parts"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Each part: its text or placeholder, and whether it is text. Placeholders are numbered within the turn at first.
    number = lambda i: F.size(F.filter(F.slice("parts", F.lit(1), i + 1), lambda p: ~is_text(p)))
    earlier = F.coalesce(F.sum(F.size(F.filter("parts", lambda p: ~is_text(p)))).over(before), F.lit(0))
    numbered = rows.withColumns({"place": F.row_number().over(order), "earlier": earlier})
    segments = F.transform(
        "parts",
        lambda p, i: F.struct(
            F.when(is_text(p), escaped(F.coalesce(p["text"], F.lit(""))))
            .otherwise(F.concat(F.lit("<|"), kind(p), F.lit(":"), (F.col("earlier") + number(i)).cast("string"), F.lit("|>")))
            .alias("s"),
            (is_text(p) & (F.col("role") == "assistant")).alias("loss"),
        ),
    )
    attachments = F.filter(
        F.transform(
            "parts",
            lambda p, i: F.when(
                ~is_text(p),
                F.struct(
                    (F.col("earlier") + number(i)).cast("long").alias("number"),
                    kind(p).alias("type"),
                    _field(p, "ref", names, "string").alias("ref"),
                    _part_tokens(kind(p), p, names).alias("tokens"),
                ),
            ),
        ),
        lambda a: a.isNotNull(),
    )
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SAYS))
    visited = numbered.select("conv_id", "place", head.alias("head"), segments.alias("segments"), attachments.alias("attached"))
    body = F.concat("head", F.array_join(F.transform("segments", lambda s: s["s"]), ""), F.lit(END))
    # Spans within the turn: where each segment starts, by adding up lengths.
    start = F.struct(F.length("head").cast("long").alias("at"), F.array().cast("array<struct<start: bigint, stop: bigint>>").alias("spans"))
    spans = F.aggregate(
        "segments",
        start,
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["s"])).alias("at"),
            F.when(
                s["loss"],
                F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + F.length(s["s"])).alias("stop")))),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    written = visited.select("conv_id", "place", body.alias("body"), spans.alias("spans"), "attached")
    placed = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum(F.length("body").cast("long")).over(placed), F.lit(0))
    shifted = F.transform("spans", lambda s: F.struct((s["start"] + F.col("base")).alias("start"), (s["stop"] + F.col("base")).alias("stop")))
    turn = F.struct("place", "body", F.col("shifted").alias("spans"), "attached")
    whole = (
        written.withColumn("base", base)
        .withColumn("shifted", shifted)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    listed = lambda name: F.flatten(F.transform("turns", lambda t: t[name]))
    out = whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["body"]), "").alias("formatted"),
        listed("spans").alias("loss_spans"),
        listed("attached").alias("attachments"),
    )
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return out.withColumn("expanded_tokens", tokens)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), where placeholders stay as they are."""
    turns = F.slice(F.split(formatted, r"<\|turn\|>"), F.lit(2), F.size(F.split(formatted, r"<\|turn\|>")))
    parted = F.transform(turns, lambda t: F.split(t, r"<\|says\|>"))
    return F.transform(
        parted,
        lambda t: F.struct(
            unescaped(t[0]).alias("role"), unescaped(F.substring_index(t[1], END, 1)).alias("text")
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    cut = F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"].cast("int") + 1, (s["stop"] - s["start"]).cast("int"))))
    return F.array_join(cut, "")


#: A conversation whose texts try to look like control strings.
_TRAP = r"\### Assistant: </turn> ok"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_TRAP).alias("text"),
    )
    turns = rows.unionByName(trap).withColumn("parts", text_part(F.coalesce("text", F.lit(""))))
    done = format_conversations(turns).select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("read"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    spoken = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _extra(text: str) -> str:
    """SQL for the number of characters that escaping adds."""
    twos = " + ".join(rf"(length({text}) - length(replace({text}, '{x}', ''))) // 2" for x in (r"\l", r"\s", "<|"))
    return rf"({twos} + CASE WHEN ends_with({text}, '\') OR ends_with({text}, '<') THEN 1 ELSE 0 END)"


OP6_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{_TRAP}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + {_extra("role")} + {_extra("text")} + {len(TURN + SAYS + END)}) AS BIGINT)
         AS formatted_chars
FROM turns GROUP BY conv_id"""
