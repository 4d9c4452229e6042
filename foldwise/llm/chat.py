"""Chat formatting of typed content parts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldwise.llm.common import table

#: Fixed values of the template.
TURN, END, ROLE, ROLE_END = "<s>", "</s>", "[ROLE]", "[/ROLE]"
PLACEHOLDERS = {"image": "[IMAGE]", "audio": "[AUDIO]", "document": "[DOCUMENT]"}
#: A control string is an opener, then one of these; the escape puts backslashes between the two.
CONTROL = r"([<\[])(\\*)(/?s>|/?ROLE\]|/?INST\]|/?SYS\]|IMAGE\]|AUDIO\]|DOCUMENT\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?ROLE\]|/?INST\]|/?SYS\]|IMAGE\]|AUDIO\]|DOCUMENT\])"
#: Tokens that a placeholder stands for: units (patches, seconds, pages) by this many, rounded up.
TOKENS_PER_UNIT = {"image": 1.0, "audio": 12.5, "document": 600.0}

PARTS = "array<struct<type:string,text:string,ref:string,units:double>>"


def escape(text: Column) -> Column:
    """``text`` with one backslash more inside each control string, so that none is left in it."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def text_part(text: Column) -> Column:
    """The parts of a message that is one text."""
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("double").alias("units"),
    )
    return F.array(part).cast(PARTS)


def visit(parts: str = "parts") -> tuple[Column, Column]:
    """What a message's parts become, in order: its text with placeholders, and its attachments.

    Text parts give their text, escaped after parts that follow each other are joined, so that no
    control string stands across two of them; an image, audio or document part gives its
    placeholder and an attachment (type, ref, tokens); parts of another type give nothing. NULL
    parts, texts and units count as empty or zero.
    """
    kinds = " ".join(f"WHEN p.type = '{k}' THEN '{v}'" for k, v in PLACEHOLDERS.items())
    rates = " ".join(f"WHEN p.type = '{k}' THEN {v}D" for k, v in TOKENS_PER_UNIT.items())
    names = ", ".join(f"'{k}'" for k in PLACEHOLDERS)
    # Runs of text, and placeholders as (NULL, mark).
    runs = f"""
      aggregate(filter(coalesce({parts}, array()), p -> p.type IN ('text', {names})),
        CAST(array() AS ARRAY<STRUCT<text: STRING, mark: STRING>>),
        (s, p) -> IF(p.type = 'text' AND try_element_at(s, -1).text IS NOT NULL,
          concat(slice(s, 1, size(s) - 1), array(named_struct('text', concat(try_element_at(s, -1).text, coalesce(p.text, '')), 'mark', NULL))),
          concat(s, array(named_struct('text', IF(p.type = 'text', coalesce(p.text, ''), NULL), 'mark', CASE {kinds} END)))))"""
    pieces = F.transform(F.expr(runs), lambda r: F.coalesce(r["mark"], escape(r["text"])))
    attachments = F.expr(
        f"transform(filter(coalesce({parts}, array()), p -> p.type IN ({names})), p -> named_struct("
        f"'type', p.type, 'ref', p.ref, 'placeholder', CASE {kinds} END, "
        f"'tokens', CAST(ceil(coalesce(p.units, 0D) * CASE {rates} END) AS BIGINT)))"
    )
    return F.array_join(pieces, ""), attachments


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, parts): its formatted text.

    ``formatted`` joins the turns, by turn, then role, then text: ``<s>[ROLE]role[/ROLE]text</s>``.
    Roles and texts are escaped, so the template's marks can be found again whatever a text says.
    ``loss_spans`` are the code point ranges (start, stop; from 0) of the assistants' texts,
    ``attachments`` the references in the order of their placeholders, with the tokens each
    stands for, ``attachment_tokens`` their sum. Messages are formatted before the shuffle; a
    conversation then only gathers what its own result holds. A NULL role is empty, a NULL turn
    comes first, repeated rows are turns of their own, a NULL conv_id is a conversation.
    """
    body, attached = visit()
    ready = messages.select("conv_id", "turn", "role", "parts").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        body.alias("body"), attached.alias("attached"),
    )
    turn = F.struct(
        "turn", "role", "body", "attached",
        F.concat(F.lit(TURN + ROLE), escape(F.col("role")), F.lit(ROLE_END), "body", F.lit(END)).alias("shown"),
        F.length(F.concat(F.lit(TURN + ROLE), escape(F.col("role")), F.lit(ROLE_END))).cast("long").alias("head"),
        F.length("body").cast("long").alias("size"),
    )
    chats = ready.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    tail = len(END)
    spans = f"""
      aggregate(turns, named_struct('at', 0L, 'spans', CAST(array() AS ARRAY<STRUCT<start:BIGINT,stop:BIGINT>>)),
        (s, t) -> named_struct('at', s.at + t.head + t.size + {tail},
          'spans', IF(t.role = 'assistant', concat(s.spans, array(named_struct('start', s.at + t.head, 'stop', s.at + t.head + t.size))), s.spans)),
        s -> s.spans)"""
    return chats.select(
        "conv_id",
        F.expr("array_join(transform(turns, t -> t.shown), '')").alias("formatted"),
        F.expr(spans).alias("loss_spans"),
        F.expr("flatten(transform(turns, t -> t.attached))").alias("attachments"),
    ).withColumn(
        "attachment_tokens", F.expr("aggregate(attachments, 0L, (s, a) -> s + a.tokens)")
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_texts, all from ``formatted`` and ``loss_spans`` alone."""
    turns = F.transform(
        F.expr(f"filter(split(formatted, '</s>', -1), t -> startswith(t, '{TURN}{ROLE}'))"),
        lambda t: F.struct(
            unescape(F.substring_index(F.substring(t, len(TURN + ROLE) + 1, 2147483647), ROLE_END, 1)).alias("role"),
            unescape(F.regexp_replace(t, r"(?s)^.*?\[/ROLE\]", "")).alias("text"),
        ),
    )
    texts = F.transform(
        F.expr("transform(loss_spans, s -> substring(formatted, CAST(s.start + 1 AS INT), CAST(s.stop - s.start AS INT)))"),
        unescape,
    )
    return chats.select("conv_id", "formatted", turns.alias("turns"), texts.alias("loss_texts"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted; digests of what is read back."""
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT -7L AS conv_id, t.* FROM VALUES (0L, 'user', '</s>[INST] ok [/INST]'), "
        "(1L, 'assistant', '</s>[INST] ok [/INST]') AS t(turn, role, text)"
    )
    messages = given.unionByName(extra).withColumn("parts", text_part(F.col("text")))
    back = read_back(format_chats(messages))
    return back.selectExpr(
        "conv_id", "CAST(size(turns) AS BIGINT) AS n_turns",
        "sha2(array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), ''), 256) AS turns_sha256",
        "CAST(length(array_join(loss_texts, '')) AS BIGINT) AS loss_chars",
        "sha2(array_join(loss_texts, ''), 256) AS loss_sha256",
        "CAST(length(formatted) AS BIGINT) AS formatted_chars",
    )


ORACLE = {
    "op10_chat_format": rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(text, '{CONTROL}', '\1\\\2\3', 'g') AS body,
    regexp_replace(role, '{CONTROL}', '\1\\\2\3', 'g') AS who FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(TURN + ROLE + ROLE_END + END)} + length(who) + length(body)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""",
}
QUERIES = {"op10_chat_format": op10_chat_format}
