"""Chat formatting with DataFrame functions alone.

A finite-state machine over roles checks the order of turns, and a declarative
template gives the text segments with a loss flag each. A conversation is
emitted in pieces of at most PIECE turn numbers, each one row; the formatted
text of a conversation is its pieces' texts in order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import query, table

#: Turn numbers a piece covers: it bounds what one row and one group hold,
#: however long the conversation.
PIECE = 256


@dataclass(frozen=True)
class Template:
    """``open`` role ``after_role`` text ``close`` for every turn; texts of
    the roles in ``loss_roles`` are trained on. ``transitions`` maps a state
    and role to the next state (state 0 begins; what is not listed is an
    error), ``final`` holds the states a conversation may end in."""
    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Strings that may not stand in a text as they are. Their first
    #: character is escaped; ``<|`` covers the template's own marks.
    control: tuple[str, ...] = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    transitions: dict = field(default_factory=lambda: {
        (0, "system"): 1, (0, "user"): 2, (1, "user"): 2, (2, "assistant"): 3,
        (3, "user"): 2, (3, "tool"): 4, (4, "tool"): 4, (4, "assistant"): 3})
    final: tuple[int, ...] = (3,)

    @property
    def error(self) -> int:
        return 1 + max([0, *(s for s, _ in self.transitions), *self.transitions.values()])


DEFAULT = Template()
#: Escapes of a control string's first character; & itself comes first.
_MARKS = (("<", "&lt;"), ("[", "&lb;"))


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """``text`` without control strings: their first character becomes an
    entity, and every & becomes &amp; so that ``unescape`` is exact."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for c in template.control:
        out = F.replace(out, F.lit(c), F.lit(dict(_MARKS)[c[0]] + c[1:]))
    return out


def unescape(text: Column) -> Column:
    for raw, mark in _MARKS:
        text = F.replace(text, F.lit(mark), F.lit(raw))
    return F.replace(F.replace(text, F.lit("&nl;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def _next_state(state: Column, role: Column, template: Template) -> Column:
    out = F.lit(template.error)
    for (s, r), to in template.transitions.items():
        out = F.when((state == s) & (role == r), F.lit(to)).otherwise(out)
    return out


def format_pieces(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) -> one row per piece: conv_id,
    piece, n_turns, segments (array of text, loss), moves (state after the
    piece for every state before it).

    Turns come in the order (turn, role, text), nulls first; rows with the
    same turn are turns of their own, repeated ones too. Null text and null
    role are empty; roles outside the template are formatted as they are and
    make the conversation invalid. A null conv_id is a conversation. Further
    columns are ignored; an empty table gives no rows.
    """
    pieces = turns.select("conv_id", F.floor(F.col("turn") / PIECE).alias("piece"), "turn",
                          F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")) \
        .groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def segments(t: Column) -> Column:
        role = F.replace(escape(t.role, template), F.lit("\n"), F.lit("&nl;"))
        head = F.concat(F.lit(template.open), role, F.lit(template.after_role))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t.text, template).alias("text"), t.role.isin(*template.loss_roles).alias("loss")),
                       F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")))
    moves = F.transform(F.sequence(F.lit(0), F.lit(template.error)), lambda s: F.aggregate(
        "turns", s, lambda state, t: _next_state(state, t.role, template)))
    return pieces.select("conv_id", "piece", F.size("turns").alias("n_turns"),
                         F.flatten(F.transform("turns", segments)).alias("segments"), moves.alias("moves"))


def formatted(pieces: DataFrame) -> DataFrame:
    """Pieces as training text: conv_id, piece, n_turns, text, spans (start
    and length in code points of the text under the loss), moves."""
    walk = F.aggregate(
        "segments", F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans")),
        lambda acc, s: F.struct(
            (acc.at + F.length(s.text)).alias("at"),
            F.when(s.loss, F.concat(acc.spans, F.array(F.struct(acc.at.alias("start"), F.length(s.text).alias("length")))))
            .otherwise(acc.spans).alias("spans")))
    return pieces.select("conv_id", "piece", "n_turns", "moves", walk.spans.alias("spans"),
                         F.array_join(F.transform("segments", lambda s: s.text), "").alias("text"))


def read_back(texts: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What ``formatted`` rows say, from their text and spans alone: conv_id,
    piece, moves, turns (array of role, text), loss_texts (unescaped), chars."""
    quoted = "\\Q" + template.open + "\\E"
    bodies = F.filter(F.split("text", quoted), lambda x, i: i > 0)

    def turn(body: Column) -> Column:
        role_end = F.instr(body, template.after_role)
        text_at = role_end + len(template.after_role)
        length = F.length(body) - text_at - len(template.close) + 1
        return F.struct(unescape(F.substr(body, F.lit(1), role_end - 1)).alias("role"),
                        unescape(F.substr(body, text_at, length)).alias("text"))
    lossy = F.transform("spans", lambda s: unescape(F.substr(F.col("text"), s.start + 1, s.length)))
    return texts.select("conv_id", "piece", "moves", F.transform(bodies, turn).alias("turns"), lossy.alias("loss_texts"),
                        F.length("text").cast("long").alias("chars"))


def digests(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation, read back from its formatted text: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, valid."""
    texts = formatted(format_pieces(turns, template))
    # A digest of a whole conversation needs its pieces in one place, in order.
    told = read_back(texts, template).select(
        "conv_id", F.struct(
            "piece", F.size("turns").alias("n"), "moves", "chars", F.array_join("loss_texts", "").alias("loss"),
            F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("said"))
        .alias("p"))
    whole = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    loss = F.array_join(F.transform("p", lambda p: p.loss), "")
    state = F.aggregate("p", F.lit(0), lambda s, p: F.element_at(p.moves, s + 1))
    return whole.select(
        "conv_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, p: a + p.n).alias("n_turns"),
        F.sha2(F.array_join(F.transform("p", lambda p: p.said), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("p", F.lit(0).cast("long"), lambda a, p: a + p.chars).alias("formatted_chars"),
        state.isin(*template.final).alias("valid"))


def _escape_sql(text: str, template: Template = DEFAULT) -> str:
    out = f"replace({text}, '&', '&amp;')"
    for c in template.control:
        out = f"replace({out}, '{c}', '{dict(_MARKS)[c[0]] + c[1:]}')"
    return out


_SQL = f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum({len(DEFAULT.open) + len(DEFAULT.after_role) + len(DEFAULT.close)} + length(replace({_escape_sql("role")}, chr(10), '&nl;'))
       + length({_escape_sql("text")})) as bigint) as formatted_chars,
  regexp_matches(string_agg(case role when 'system' then 's' when 'user' then 'u' when 'assistant' then 'a' when 'tool' then 't'
       else 'x' end, '' order by turn nulls first, role, text), '^s?ua((u|t+)a)*$') as valid
from t group by conv_id
"""


@query("op7_chat_format", _SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(probe).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(turns)
