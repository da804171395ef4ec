"""Chat formatting with a grammar that is read back: what does not survive is escaped until it does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template.  A user turn, an assistant turn, a turn of any other role.
USER = ("<s>[INST] ", " [/INST]")
ASSISTANT = (" ", "</s>")
ROLE = ("<s>[ROLE] ", " [/ROLE]")

# a bracket, any backslashes, and the rest of a control string; escaping adds a backslash, reading removes one
_CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]|ROLE\]))"
_TURN = r"(?s)<s>\[INST\] .*? \[/INST\]|<s>\[ROLE\] .*? \[/ROLE\]| .*?</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def render(role: Column, text: Column) -> Column:
    """One turn; other roles are written percent-encoded on a line of their own."""
    return (
        F.when(role == "user", F.concat(F.lit(USER[0]), text, F.lit(USER[1])))
        .when(role == "assistant", F.concat(F.lit(ASSISTANT[0]), text, F.lit(ASSISTANT[1])))
        .otherwise(F.concat(F.lit(ROLE[0]), F.url_encode(role), F.lit("\n"), text, F.lit(ROLE[1])))
    )


def _inside(turn: Column, ends: tuple[str, str]) -> Column:
    return F.substring(turn, F.lit(len(ends[0]) + 1), F.length(turn) - len(ends[0]) - len(ends[1]))


def parse(formatted: Column) -> Column:
    """The turns, (role, text) each, that a deterministic parser reads from the formatted text."""

    def read(turn: Column) -> Column:
        body = _inside(turn, ROLE)
        role = F.substring_index(body, "\n", 1)
        other = F.struct(F.url_decode(role).alias("role"), unescape(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"))
        user = F.struct(F.lit("user").alias("role"), unescape(_inside(turn, USER)).alias("text"))
        assistant = F.struct(F.lit("assistant").alias("role"), unescape(_inside(turn, ASSISTANT)).alias("text"))
        return F.when(F.startswith(turn, F.lit(USER[0])), user).when(F.startswith(turn, F.lit(ROLE[0])), other).otherwise(assistant)

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), read)


def format_conversations(turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """``conv_id, formatted, turns, same``: the text of each conversation and the turns read back from it.

    A turn is first written plain and read back alone; if role or text come back changed, it is
    escaped.  If the whole conversation then still reads differently, all its turns are escaped.
    ``same`` tells that the turns read back are those of the source.

    Null texts and roles count as empty.  Turns are ordered by turn (null first), ties by role and
    text; repeated rows are turns of their own.  Rows without a conversation form one, with a null id.
    """
    rows = turns.select(
        F.col(conv_column).alias("conv_id"),
        F.struct(
            F.col(turn_column).alias("turn"), F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("source"))
    told = gathered.withColumn("source", F.transform("source", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))))

    def written(x: Column) -> Column:
        plain = render(x["role"], x["text"])
        return F.when(parse(plain) == F.array(x), plain).otherwise(render(x["role"], escape(x["text"])))

    def joined(write) -> Column:
        return F.array_join(F.transform("source", write), "")

    first = told.withColumn("formatted", joined(written)).withColumn("turns", parse(F.col("formatted")))
    again = first.withColumn("formatted", F.when(F.col("turns") == F.col("source"), F.col("formatted")).otherwise(joined(lambda x: render(x["role"], escape(x["text"])))))
    return again.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), (parse(F.col("formatted")) == F.col("source")).alias("same"))


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from the formatted texts: turns, and the text under the loss mask (the assistant's)."""
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda x: x["role"] == "assistant"), lambda x: x["text"]), "")
    return formatted.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
