"""Chat formatting by a grammar round trip, in column expressions only.

A conversation is rendered as ``<s>`` and its turns in order::

    user         [INST] text [/INST]
    assistant     text </s>              (one blank before the text)
    other roles  [ROLE] role [/ROLE] text </s>

The grammar is deterministic: an end marker (``[/INST]`` or ``</s>``) closes a turn, its opening
tells the kind, and no marker may stand anywhere else. Every turn is first rendered as it is and
parsed again. If what the parser recovers is not the source, the turn's markers are escaped, by one
backslash after the opening bracket of whatever looks like a marker (with any number of
backslashes already there), and rendered and parsed once more; the parser takes one backslash off.
Escaped content holds no bare marker and comes back unchanged, so the second form always agrees;
the whole conversation is parsed again at the end, and a difference there raises an error.

The loss mask covers the assistants' texts. It is kept as run lengths in code points of the
formatted text: not under the mask, under it, not, under, ..., beginning with a run outside it.

Defined results: null text or role is the empty string; rows of a null conv_id are one
conversation; turns are ordered by turn (null first), then role, then text, and repeated rows are
repeated turns. Extra columns are never read. An empty table has no conversations. A conversation
is one text and is held by one task, as its digest asks for it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import content, read_table

BEGIN, END = "<s>", "</s>"
USER, ASSISTANT = "user", "assistant"
_USER_OPEN, _USER_CLOSE = "[INST] ", " [/INST]"
_ROLE_OPEN, _ROLE_CLOSE = "[ROLE] ", " [/ROLE] "
_TEXT_OPEN, _TEXT_CLOSE = " ", " " + END

_BARE = r"</?s>|\[/?(?:INST|ROLE)\]"
_TO_ESCAPE = r"(<(?=\\*+/?s>)|\[(?=\\*+/?(?:INST|ROLE)\]))"
_ESCAPED = r"(<(?=\\++/?s>)|\[(?=\\++/?(?:INST|ROLE)\]))\\"


def escape(text: Column) -> Column:
    """One backslash more in everything that looks like a marker."""
    return F.regexp_replace(text, _TO_ESCAPE, r"$1\\")


def unescape(text: Column) -> Column:
    return F.when(text.contains("\\"), F.regexp_replace(text, _ESCAPED, "$1")).otherwise(text)


def has_marker(text: Column) -> Column:
    return (text.contains(">") | text.contains("]")) & text.rlike(_BARE)


def render(role: Column, text: Column) -> Column:
    """A turn as it stands in the formatted text."""
    return (F.when(role == USER, F.concat(F.lit(_USER_OPEN), text, F.lit(_USER_CLOSE)))
            .when(role == ASSISTANT, F.concat(F.lit(_TEXT_OPEN), text, F.lit(_TEXT_CLOSE)))
            .otherwise(F.concat(F.lit(_ROLE_OPEN), role, F.lit(_ROLE_CLOSE), text, F.lit(_TEXT_CLOSE))))


def _framed(body: Column, asked: Column) -> Column:
    """What stands before an end marker (``asked``: the user's), taken apart: (role, shown,
    opening), still escaped. Null if its opening and the marker make no turn."""
    def part(role: Column, opening: Column) -> Column:
        shown = F.substring(body, opening + 1, F.length(body) - opening - 1)
        return F.struct(role.alias("role"), shown.alias("shown"), opening.cast("long").alias("opening"))

    def opens(opening: str) -> Column:
        return body.startswith(opening) & (F.length(body) > len(opening))

    named = F.instr(body, _ROLE_CLOSE)
    header = named + F.lit(len(_ROLE_CLOSE) - 1)
    name = F.substring(body, F.lit(len(_ROLE_OPEN) + 1), named - F.lit(len(_ROLE_OPEN) + 1))
    return F.when(body.endswith(" "), (
        F.when(asked, F.when(opens(_USER_OPEN), part(F.lit(USER), F.lit(len(_USER_OPEN)))))
        .when(opens(_TEXT_OPEN), part(F.lit(ASSISTANT), F.lit(len(_TEXT_OPEN))))
        .when(opens(_ROLE_OPEN) & (named > len(_ROLE_OPEN)) & (F.length(body) > header), part(name, header))))


def _turn(framed: Column) -> Column:
    """(role, text, opening, shown) of a framed turn: ``opening`` code points stand before the text
    and ``shown`` are the text's own, as it stands there. Null if a marker is left in it."""
    role, shown = framed["role"], framed["shown"]
    made = F.struct(unescape(role).alias("role"), unescape(shown).alias("text"), framed["opening"].alias("opening"),
                    F.length(shown).cast("long").alias("shown"))
    return F.when(~has_marker(role) & ~has_marker(shown), made)


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation; null where it does not begin as one or has text
    behind its last end marker, and a null turn where a segment is none."""
    closed = F.split(F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted)), END)

    def bodies(piece: Column) -> Column:
        # All but the last one end at a user's marker, the last one at the piece's own.
        parts = F.split(piece, r"\[/INST\]")
        return F.transform(parts, lambda p, k: F.struct(p.alias("body"), (k < F.size(parts) - 1).alias("asked")))

    segments = F.flatten(F.transform(closed, bodies))
    turns = F.transform(F.transform(F.slice(segments, F.lit(1), F.size(segments) - 1),
                                    lambda s: _framed(s["body"], s["asked"])), _turn)
    return F.when(formatted.startswith(BEGIN) & (F.element_at(segments, -1)["body"] == ""), turns)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row (conv_id, formatted, loss_runs) per conversation."""
    turns = conversations.select("conv_id", "turn", content("role").alias("role"), content("text").alias("text"))
    role, text = F.col("role"), F.col("text")
    turns = turns.withColumn("plain", render(role, text))
    turns = turns.withColumn("back", parse(F.concat(F.lit(BEGIN), F.col("plain"))))
    only = F.get("back", F.lit(0))
    agrees = F.coalesce((F.size("back") == 1) & (only["role"] == role) & (only["text"] == text), F.lit(False))
    turns = turns.withColumn("rendered", F.when(agrees, F.col("plain")).otherwise(
        render(F.when(role.isin(USER, ASSISTANT), role).otherwise(escape(role)), escape(text))))
    whole = (turns.groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("numbered"),
                                                       "turn", "role", "text", "rendered"))).alias("turns")))
    whole = whole.withColumn("formatted", F.concat(F.lit(BEGIN), F.array_join(F.col("turns")["rendered"], "")))
    whole = whole.withColumn("parsed", parse(F.col("formatted")))
    same = F.coalesce((F.col("parsed")["role"] == F.col("turns")["role"])
                      & (F.col("parsed")["text"] == F.col("turns")["text"]), F.lit(False))
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not parse back: "), F.col("conv_id").cast("string"))))
    return whole.select("conv_id", checked.alias("formatted"), loss_runs(F.col("parsed")).alias("loss_runs"))


def loss_runs(parsed: Column) -> Column:
    """Run lengths of the loss mask, outside and under it in turn. A turn adds two runs: what stands
    before its text, and the text; what closes it opens the next turn's first run. Turns that are
    not an assistant's have an empty run under the mask."""
    closing = lambda t: F.when(t["role"] == USER, len(_USER_CLOSE)).otherwise(len(_TEXT_CLOSE))
    under = lambda t: F.when(t["role"] == ASSISTANT, t["shown"]).otherwise(F.lit(0))
    around = lambda t: t["opening"] + t["shown"] - under(t) + closing(t)

    def runs(t: Column, k: Column) -> Column:
        # An assistant's closing marker follows its text, so it belongs to the next run.
        before = F.get(parsed, k - 1)
        left = F.when(k == 0, F.lit(len(BEGIN))).otherwise(
            F.when(before["role"] == ASSISTANT, F.lit(len(_TEXT_CLOSE))).otherwise(F.lit(0)))
        own = F.when(t["role"] == ASSISTANT, t["opening"]).otherwise(around(t))
        return F.array((left + own).cast("long"), under(t).cast("long"))

    last = F.when(F.element_at(parsed, -1)["role"] == ASSISTANT, F.lit(len(_TEXT_CLOSE))).otherwise(F.lit(0))
    return F.concat(F.flatten(F.transform(parsed, runs)), F.array(last.cast("long")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per formatted conversation its turns, and the texts under the loss mask, as the parser finds
    them: (conv_id, formatted, turns, loss_texts)."""
    parsed = formatted.withColumn("turns", parse(F.col("formatted")))
    texts = F.transform(F.filter("turns", lambda t: t["role"] == ASSISTANT), lambda t: t["text"])
    return parsed.select("conv_id", "formatted", "turns", texts.alias("loss_texts"))


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like markers, formatted and read back."""
    table = read_table(spark, sf_dir, "conversations")
    hard = "</s>[INST] ok [/INST]"
    added = (spark.range(2).select(F.lit(-7).cast(table.schema["conv_id"].dataType).alias("conv_id"),
                                   F.col("id").cast(table.schema["turn"].dataType).alias("turn"),
                                   F.when(F.col("id") == 0, USER).otherwise(ASSISTANT).alias("role"), F.lit(hard).alias("text")))
    rows = table.select("conv_id", "turn", "role", "text").unionByName(added)
    back = read_back(format_conversations(rows))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


#: Lengths of the frame: 3 at the beginning; 15, 6 or 21 a turn; one more for each marker escaped.
CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(k)
),
sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?(INST|ROLE)\]'))
              + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6
                ELSE 21 + length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?(INST|ROLE)\]')) END AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
