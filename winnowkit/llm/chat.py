"""Chat formatting with a checked grammar round trip, with DataFrame operations only.

Grammar of a formatted conversation, for the default template::

    conversation := turn*
    turn         := "<s>" role "[INST]" body "[/INST]</s>"

The parser splits at the closing marker, takes the role up to the first ``[INST]`` and the
body behind it, and undoes the escapes ``&l;``, ``&b;`` and ``&a;`` (for ``<``, ``[``, ``&``).
A control string (``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) inside a role or body is a syntax
error: the parser returns null for that part, which equals no source. Formatting starts from the raw text. Each turn is reparsed; one that doesn't come back as it
was is escaped. The whole conversation is then reparsed and compared with its source, and
where it still differs every turn is escaped, which leaves no control string in any text. A
conversation that would differ even then fails the query instead of being written.

Defined results: a null text or role counts as empty. Turns are ordered by turn (nulls
first), then role, then text, so ties and repeated rows stay, in a stable order. Rows with a
null conversation id belong to no other row: each is a conversation of one turn. No rows give no
conversations. Other columns are not read. A conversation is one string value, so a single one
must fit Spark's 2 GB limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    turn_open: str = "<s>"
    body_open: str = "[INST]"
    turn_close: str = "[/INST]</s>"
    loss_roles: tuple[str, ...] = ("assistant",)

    def render(self, role: Column, body: Column) -> Column:
        return F.concat(F.lit(self.turn_open), role, F.lit(self.body_open), body, F.lit(self.turn_close))

    def parse(self, formatted: Column) -> Column:
        """array<struct<role, text>> of what the grammar finds in the string."""
        turns = F.filter(F.split(formatted, _quote(self.turn_close), -1), lambda t: t != "")
        return F.transform(turns, self._parse_turn)

    def _parse_turn(self, turn: Column) -> Column:
        at = F.instr(turn, self.body_open)
        n, m = len(self.turn_open), len(self.body_open)
        role = F.substring(turn, F.lit(n + 1), at - F.lit(n + 1))
        body = F.substring(turn, at + F.lit(m), F.length(turn))
        return F.struct(_plain(role).alias("role"), _plain(body).alias("text"))


#: The control strings of the default template.
CONTROL = r"</?s>|\[/?INST\]"


def _plain(part: Column) -> Column:
    return F.when(~F.rlike(part, F.lit(CONTROL)), unescape(part))


def _quote(literal: str) -> str:
    return r"\Q" + literal + r"\E"


def escape(text: Column) -> Column:
    """Make sure that no control string is left; undone by ``unescape``."""
    text = F.replace(text, F.lit("&"), F.lit("&a;"))
    text = F.regexp_replace(text, r"<(?=/?s>)", "&l;")
    return F.regexp_replace(text, r"\[(?=/?INST\])", "&b;")


def unescape(text: Column) -> Column:
    for code, char in (("&l;", "<"), ("&b;", "["), ("&a;", "&")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def format_chats(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, source, loss_spans) for each conversation.

    ``source`` is array<struct<role, text>>; ``loss_spans`` is array<struct<at, n>>, the 1-based
    place and length in code points of each body that training takes its loss from.
    """
    t = template
    turns = rows.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    one = F.element_at(t.parse(t.render(F.col("role"), F.col("text"))), 1)
    alone = F.size(t.parse(t.render(F.col("role"), F.col("text")))) == 1
    returns = alone & (one["role"] == F.col("role")) & (one["text"] == F.col("text"))
    turns = turns.withColumn("ok", F.coalesce(returns, F.lit(False)))
    turns = turns.select(
        "conv_id", "alone", "turn", "role", "text",
        F.when(F.col("ok"), F.col("role")).otherwise(escape(F.col("role"))).alias("r1"),
        F.when(F.col("ok"), F.col("text")).otherwise(escape(F.col("text"))).alias("b1"),
        escape(F.col("role")).alias("r2"),
        escape(F.col("text")).alias("b2"),
    )
    order = Window.partitionBy("conv_id", "alone").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = len(t.turn_open) + len(t.body_open) + len(t.turn_close)
    to_body = len(t.turn_open) + len(t.body_open)

    def place(r: str, b: str) -> Column:
        past = F.coalesce(F.sum(F.length(r) + F.length(b) + F.lit(fixed)).over(before), F.lit(0).cast("bigint"))
        return past + F.length(r) + F.lit(to_body + 1)

    turns = turns.withColumns({"n": F.row_number().over(order), "at1": place("r1", "b1"), "at2": place("r2", "b2")})
    whole = turns.groupBy("conv_id", "alone").agg(
        F.array_sort(F.collect_list(F.struct("n", "role", "text", "r1", "b1", "at1", "r2", "b2", "at2"))).alias("t")
    )

    def joined(r: str, b: str) -> Column:
        return F.array_join(F.transform("t", lambda x: t.render(x[r], x[b])), "")

    def spans(b: str, at: str) -> Column:
        lossy = F.filter("t", lambda x: x["role"].isin(*t.loss_roles))
        return F.transform(lossy, lambda x: F.struct(x[at].alias("at"), F.length(x[b]).cast("bigint").alias("n")))

    whole = whole.select(
        "conv_id",
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("source"),
        joined("r1", "b1").alias("f1"), joined("r2", "b2").alias("f2"),
        spans("b1", "at1").alias("s1"), spans("b2", "at2").alias("s2"),
    )
    whole = whole.withColumn("ok", t.parse(F.col("f1")) == F.col("source"))
    whole = whole.select(
        "conv_id", "source",
        F.when(F.col("ok"), F.col("f1")).otherwise(F.col("f2")).alias("formatted"),
        F.when(F.col("ok"), F.col("s1")).otherwise(F.col("s2")).alias("loss_spans"),
    )
    checked = F.when(t.parse(F.col("formatted")) == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a formatted conversation doesn't parse back to its source")).cast("string")
    )
    return whole.select("conv_id", checked.alias("formatted"), "source", "loss_spans")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What a consumer finds in the formatted strings: turns by the parser, text under the loss mask by the spans."""
    under = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["at"].cast("int"), s["n"].cast("int")))), ""
    )
    return formatted.select("conv_id", "formatted", template.parse(F.col("formatted")).alias("turns"), under.alias("loss_text"))
