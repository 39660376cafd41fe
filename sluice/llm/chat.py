"""Chat formatting in budgeted windows: spans of whole turns chosen by prefix sums, with the system turn and some history before them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common

#: A token: up to 8 letters, digits or characters that aren't ASCII; one other sign; 16 blanks. So a token has 16 characters at most.
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{1,8}|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]|[\x00-\x20\x7F]{16}"
#: Tokens of a turn's marks and role.
MARKS = 5
MASK = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Template:
    """A turn is open, role, head, text, close. Control strings, which have no backslash, are parted in roles and texts by one after their first character."""

    open: str = "<s>[INST]"
    head: str = "[/INST]"
    close: str = "</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")

    def escaped(self, text: Column) -> Column:
        """text with backslashes doubled and one in each control string, so none is left."""
        first = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls)
        return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), first, "$0\\\\")

    @staticmethod
    def unescaped(text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("long") + MARKS


def turn_spans(turns: DataFrame, budget: int, history: int, stretch: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, start, before, n, fresh, _file, _row of every turn in every window; the turns).

    turns: conv_id, turn, role, tie, n (tokens), _file, _row. `before` is the sum of the tokens before a turn, which is its place
    too; it comes from ranges of the order, so a conversation of any length spreads over tasks. Spans are filled with turns
    until the next would go over the budget, less the system turn and, but for the first, the history. This goes on within
    `stretch` budgets of a conversation, whose turns, at most stretch * budget / MARKS, are narrow and meet in one task; the next
    stretch begins a span. A turn longer than what is left is a span by itself. History is the turns that end where the span
    starts and begin at most `history` tokens before; they are found by cells of that width, so no turn meets all spans.
    """
    order = ["turn", "role", "tie", "_file", "_row"]
    ranges = common.staged(turns.repartitionByRange("conv_id", *order).withColumn("_part", F.spark_partition_id()), "chat-turns")
    placed = common.staged(common.bucketed_sums(ranges, ["conv_id"], ["_part"], order, F.col("n"), "before").select("conv_id", "role", "n", "before", "_file", "_row"), "chat-places")
    is_head = (F.col("before") == 0) & (F.col("role") == "system")
    heads = placed.filter(is_head).select(F.col("conv_id").alias("_conv"), F.col("n").alias("_head"), F.col("_file").alias("_hf"), F.col("_row").alias("_hr"))
    of = lambda rows: rows["conv_id"].eqNullSafe(heads["_conv"])
    rest = placed.filter(~is_head)
    rest = rest.join(heads.select("_conv", "_head"), of(rest), "left").withColumn("_head", F.coalesce("_head", F.lit(0)))

    turn = F.struct("before", "n", "_file", "_row")
    parts = rest.groupBy("conv_id", F.floor(F.col("before") / (stretch * budget)).alias("_stretch")).agg(F.max("_head").alias("_head"), F.sort_array(F.collect_list(turn)).alias("_turns"))
    state = "struct<starts:array<bigint>,at:bigint>"
    room = lambda at: F.greatest(F.lit(1), budget - F.col("_head") - F.when(at > F.col("_head"), history).otherwise(0))
    begins = lambda s, t: (s["at"] < 0) | (t["before"] + t["n"] - s["at"] > room(s["at"]))
    start = F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(-1).cast("bigint").alias("at")).cast(state)
    step = lambda s, t: F.when(begins(s, t), F.struct(F.concat(s["starts"], F.array(t["before"])).alias("starts"), t["before"].alias("at")).cast(state)).otherwise(s)
    parts = parts.withColumn("_starts", F.aggregate("_turns", start, step)["starts"])
    own = F.transform("_turns", lambda t: F.struct(t.alias("t"), F.array_max(F.filter("_starts", lambda s: s <= t["before"])).alias("start")))
    spans = parts.select("conv_id", "_head", F.explode(own).alias("o")).select("conv_id", "_head", "o.start", "o.t.*")
    spans = common.staged(spans, "chat-spans")

    columns = ["conv_id", "start", "before", "n", "_file", "_row"]
    starts = spans.filter("before = start").select(F.col("conv_id").alias("_of"), F.col("start").alias("_start"), (F.col("start") == F.col("_head")).alias("_first"))
    led = starts.join(heads, starts["_of"].eqNullSafe(heads["_conv"])).select(F.col("_of").alias("conv_id"), F.col("_start").alias("start"), F.lit(-1).cast("long").alias("before"), F.col("_head").alias("n"), F.col("_hf").alias("_file"), F.col("_hr").alias("_row"), F.col("_first").alias("fresh"))
    alone = heads.join(starts, heads["_conv"].eqNullSafe(starts["_of"]), "left_anti")
    alone = alone.select(F.col("_conv").alias("conv_id"), F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("before"), F.col("_head").alias("n"), F.col("_hf").alias("_file"), F.col("_hr").alias("_row"), F.lit(True).alias("fresh"))
    members = spans.select(*columns, F.lit(True).alias("fresh")).unionByName(led).unionByName(alone)
    if history:
        cell = F.floor(F.col("before") / history)
        dealt = spans.select("conv_id", "before", "n", "_file", "_row", F.explode(F.array(cell, cell + 1)).alias("_cell"))
        later = starts.filter("NOT _first").withColumn("_at", F.floor(F.col("_start") / history))
        near = (F.col("_start") > F.col("before")) & (F.col("_start") - F.col("before") <= history)
        repeated = dealt.join(later, dealt["conv_id"].eqNullSafe(later["_of"]) & (dealt["_cell"] == later["_at"]) & near)
        members = members.unionByName(repeated.withColumn("start", F.col("_start")).select(*columns, F.lit(False).alias("fresh")))
    return members, placed


def chat_windows(chats: DataFrame, *, budget: int = 512, history: int = 128, stretch: int = 32, template: Template = Template()) -> DataFrame:
    """A row for each window: conv_id, start (tokens before its span), tokens, repeated, mask, formatted.

    A conversation's turns, in the order of turn, null first, then of role and of the text's md5, are parted into spans of whole
    turns (turn_spans); a window is the conversation's system turn, if it begins with one, limited history and a span, as one
    string by the template. Its first `repeated` turns are in an earlier window too. `mask` has the places, in characters, of
    the texts of the span's assistant turns: every assistant text is under exactly one mask, a repeated one isn't. Tokens are
    what TOKEN finds, and MARKS for a turn; a window is over the budget only if one turn, with the system turn, is.

    The plan is made on narrow rows; texts move twice, to their windows and into them, and a window holds what its budget allows
    or one long turn. Null texts and roles are empty ones, a null conv_id is a conversation, rows that repeat are turns one by
    one, a system turn by itself is a window, an empty table gives no rows. Columns besides conv_id, turn, role and text are not read.
    """
    placed = common.with_locator(chats, "conv_id", "turn", "role", "text")
    role, text = F.coalesce("role", F.lit("")), common.text_of(placed)
    turns = placed.select("conv_id", "turn", role.alias("role"), F.md5(text).alias("tie"), turn_tokens(text).alias("n"), "_file", "_row")
    members, _ = turn_spans(turns, budget, history, stretch)
    lead = F.concat(F.lit(template.open), template.escaped(role), F.lit(template.head))
    texts = placed.select(F.col("_file").alias("_f"), F.col("_row").alias("_r"), (role == "assistant").alias("target"), lead.alias("lead"), template.escaped(text).alias("body"))
    joined = members.join(texts, (members["_file"] == texts["_f"]) & (members["_row"] == texts["_r"]))
    turn = F.struct("before", "fresh", "n", "target", "lead", "body")
    windows = joined.groupBy("conv_id", "start").agg(F.sum("n").alias("tokens"), F.sort_array(F.collect_list(turn)).alias("_turns"))

    state = f"struct<at:int,spans:{MASK}>"
    none = F.struct(F.lit(0).alias("at"), F.array().cast(MASK).alias("spans")).cast(state)

    def step(s: Column, t: Column) -> Column:
        begin = s["at"] + F.length(t["lead"])
        end = begin + F.length(t["body"])
        spans = F.when(t["fresh"] & t["target"], F.concat(s["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(s["spans"])
        return F.struct((end + len(template.close)).alias("at"), spans.alias("spans")).cast(state)

    formatted = F.array_join(F.transform("_turns", lambda t: F.concat(t["lead"], t["body"], F.lit(template.close))), "")
    repeated = F.size(F.filter("_turns", lambda t: ~t["fresh"]))
    return windows.select("conv_id", "start", "tokens", repeated.alias("repeated"), F.aggregate("_turns", none, step)["spans"].alias("mask"), formatted.alias("formatted"))


def read_windows(windows: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, start, turns (array of role and text), loss: what a window's string says, without the turns that it repeats, and the texts under its mask."""
    parts = F.split("formatted", re.escape(template.close))
    own = F.slice(parts, F.col("repeated") + 1, F.size(parts) - 1 - F.col("repeated"))
    at = lambda p: F.position(F.lit(template.head), p)
    role = lambda p: F.substr(p, F.lit(len(template.open) + 1), at(p) - len(template.open) - 1)
    text = lambda p: F.substr(p, at(p) + len(template.head))
    turns = F.transform(own, lambda p: F.struct(template.unescaped(role(p)).alias("role"), template.unescaped(text(p)).alias("text")))
    loss = F.array_join(F.transform("mask", lambda m: template.unescaped(F.substr("formatted", m["start"] + 1, m["end"] - m["start"]))), "")
    return windows.select("conv_id", "start", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))


def conversation_digests(windows: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: each conversation as its windows say it.

    A SHA-256 has no partial sums, so the windows of one conversation are put in one string, of 2 GB at most.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = read_windows(windows, template).select("conv_id", "start", F.size("turns").cast("long").alias("n"), said.alias("said"), "loss", "formatted_chars")
    all_ = F.sort_array(F.collect_list(F.struct("start", "said", "loss")))
    found = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum(F.length("loss").cast("long")).alias("loss_chars"), F.sum("formatted_chars").alias("formatted_chars"), all_.alias("_w"))
    digest = lambda c: F.sha2(F.array_join(F.transform("_w", lambda w: w[c]), ""), 256)
    return found.select("conv_id", "n_turns", digest("said").alias("turns_sha256"), "loss_chars", digest("loss").alias("loss_sha256"), "formatted_chars")


#: A conversation of control strings, which the query adds.
PROBE = "</s>[INST] ok [/INST]"


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    with common.scratch(spark):
        windows = common.staged(chat_windows(chats.unionByName(probe)), "chat-windows", keep=True)
    return conversation_digests(windows)


def _sql(budget: int = 512, history: int = 128, stretch: int = 32, t: Template = Template()) -> str:
    controls = "|".join(re.escape(c) for c in t.controls)
    length = lambda x: f"length({x}) + length({x}) - length(replace({x}, '\\', '')) + len(regexp_extract_all({x}, '{controls}'))"
    marks = len(t.open + t.head + t.close)
    room = f"greatest(1, {budget} - x.head - CASE WHEN w.start > x.head THEN {history} ELSE 0 END)"
    return rf"""
WITH RECURSIVE c AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -k, -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '{PROBE}' FROM range(2) q(k)
), z AS (SELECT *, {MARKS} + len(regexp_extract_all(text, '{TOKEN}')) AS n, {marks} + {length("role")} + {length("text")} AS chars FROM c),
t AS (SELECT *, row_number() OVER o AS i, sum(n) OVER o - n AS before FROM z WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), r ROWS UNBOUNDED PRECEDING)),
h AS (SELECT conv_id, n, chars FROM t WHERE i = 1 AND role = 'system'),
b AS (SELECT t.*, coalesce(h.n, 0) AS head, before // {stretch * budget} AS stretch FROM t LEFT JOIN h ON t.conv_id IS NOT DISTINCT FROM h.conv_id WHERE NOT (i = 1 AND role = 'system')),
w AS (
  SELECT conv_id, i, stretch, before AS start FROM (SELECT *, lag(stretch) OVER (PARTITION BY conv_id ORDER BY i) AS last FROM b) WHERE last IS NULL OR last <> stretch
  UNION ALL
  SELECT x.conv_id, x.i, x.stretch, CASE WHEN x.before + x.n - w.start > {room} THEN x.before ELSE w.start END FROM w JOIN b x ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND x.i = w.i + 1 AND x.stretch = w.stretch
), s AS (SELECT b.conv_id, b.before AS start, b.head FROM b JOIN w ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = w.i AND b.before = w.start),
m AS (
  SELECT conv_id, sum(chars) AS chars FROM b GROUP BY conv_id
  UNION ALL SELECT b.conv_id, sum(b.chars) FROM b JOIN s ON b.conv_id IS NOT DISTINCT FROM s.conv_id AND s.start > s.head AND b.before < s.start AND s.start - b.before <= {history} GROUP BY b.conv_id
  UNION ALL SELECT h.conv_id, any_value(h.chars) * greatest(1, count(s.start)) FROM h LEFT JOIN s ON h.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY h.conv_id
), f AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM m GROUP BY conv_id),
d AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256
  FROM t GROUP BY conv_id
)
SELECT d.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars FROM d JOIN f ON d.conv_id IS NOT DISTINCT FROM f.conv_id
"""


OP12_SQL = _sql()
