"""Chat formatting with DataFrame expressions only.

``format_chat`` sorts the collected turn structs of a conversation, merges
adjacent turns of one role into one block by aggregating slices of the array
and concatenates the blocks; each turn is touched a fixed number of times.
``read_chat`` splits the formatted text again.

Template, with the escape character written ``\\``::

    <|role|>ROLE\\nTEXT<|and|>TEXT<|end|>

Inside roles and texts the escape ``\\`` becomes ``\\b`` and ``<|`` becomes
``\\o``, in roles a line end becomes ``\\n``, so no text can hold a control string
and every role and text is recovered exactly.

Edge cases: a null text is empty; a null role is the role ``""`` and a null
conversation id is a conversation of its own; turns with equal numbers are
ordered by role and text, null turn numbers first; repeated rows are kept as
turns; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.tables import table

OPEN, NEXT, END = "<|role|>", "<|and|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\o"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\o"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\n"), F.lit("\n")))


def format_chat(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted) from rows (conv_id, turn, role, text)."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    one = turns.select(F.col("conv_id").cast("long"), turn.alias("t"))
    talks = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    role = lambda k: F.get("turns", k)["role"]
    new = lambda k: F.coalesce(role(k) != role(k - 1), F.lit(True))
    starts = talks.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), new))

    def block(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("turns"))
        body = F.array_join(F.transform(F.slice("turns", start + 1, end - start), lambda t: escape(t["text"])), NEXT)
        return F.concat(F.lit(OPEN), escape_role(role(start)), F.lit("\n"), body, F.lit(END))

    return starts.select("conv_id", F.array_join(F.transform("starts", block), "").alias("formatted"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<role,text>>, formatted_chars): the inverse of ``format_chat``.

    A turn is under the loss mask when its role is ``LOSS_ROLE``.
    """
    blocks = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        at = F.locate("\n", block)
        role = unescape_role(F.substring(block, F.lit(len(OPEN) + 1), at - F.lit(len(OPEN) + 1)))
        body = F.substring(block, at + 1, F.length(block))
        return F.transform(F.split(body, r"<\|and\|>", -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return formatted.select(
        "conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"), F.length("formatted").cast("long").alias("formatted_chars")
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], talk.schema)
    back = read_chat(format_chat(talk.unionByName(extra)))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == LOSS_ROLE), lambda t: t["text"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: The whole result except the length of the template, which is the template's own.
OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(role, '\', '\b'), '<|', '\o'), chr(10), '\n') AS er, replace(replace(text, '\', '\b'), '<|', '\o') AS et,
    lag(role) OVER w IS NOT DISTINCT FROM role AND row_number() OVER w > 1 AS same
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(length(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(et) + CASE WHEN same THEN 7 ELSE length(er) + 16 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
