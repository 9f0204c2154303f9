"""Chat formatting: a role state machine and a declarative template.

``format_conversations`` gives one row per conversation with its segments, in
order: marker text and turn text alternate, and each segment says whether it
is under the loss.  Joined, the segments are the training string.  Control
strings inside texts are escaped by one backslash after their first character
(strings that already carry backslashes get one more), so only the template
writes control strings and ``parse_turns`` gets every turn back.

Everything is built from DataFrame functions.  Cases:

* null text is empty; null role is the empty role;
* a role outside the template is written with the ``other`` markers, which
  carry the role itself, and makes the conversation invalid;
* rows with one turn number are ordered by role, then by escaped text;
  repeated rows are turns of their own; null turn numbers come first;
* a null conv_id is a conversation like any other; an empty table gives
  an empty result; other columns are ignored.

A conversation's row holds all its turns, as its training string must; per-turn
work (escaping, markers) is done before the one shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Form:
    prefix: str
    suffix: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers by role, and the turn order as a state machine.

    ``moves[state][role]`` is the next state; a missing entry rejects.
    A conversation is valid when it ends in one of ``accept``.
    """

    forms: dict[str, Form]
    other: tuple[str, str, str]
    moves: dict[str, dict[str, str]]
    start: str = "start"
    accept: frozenset[str] = frozenset({"assistant"})
    markers: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        found = {m for f in self.forms.values() for m in (f.prefix, f.suffix)} | set(self.other)
        object.__setattr__(self, "markers", tuple(sorted(found)))
        openers = {m[0] for m in found}
        for m in found:
            if "\\" in m or len(m) < 2 or openers & set(m[1:]):
                raise ValueError(f"a marker must start, and only start, with an opening character: {m!r}")

    @property
    def opener(self) -> str:
        return "[" + "".join(sorted({re.escape(m[0]) for m in self.markers})) + "]"

    @property
    def rest(self) -> str:
        return "(?:" + "|".join(re.escape(m[1:]) for m in self.markers) + ")"


INSTRUCT = Template(
    forms={"system": Form("[SYS]", "[/SYS]"),
           "user": Form("[INST]", "[/INST]"),
           "assistant": Form("<s>", "</s>", loss=True)},
    other=("[ROLE]", "[TEXT]", "[/ROLE]"),
    moves={"start": {"system": "system", "user": "user"},
           "system": {"user": "user"},
           "user": {"assistant": "assistant"},
           "assistant": {"user": "user"}})


def escape(text: Column, template: Template = INSTRUCT) -> Column:
    return F.regexp_replace(text, rf"(?<={template.opener})(?=\\*{template.rest})", r"\\")


def unescape(text: Column, template: Template = INSTRUCT) -> Column:
    return F.regexp_replace(text, rf"(?<={template.opener})\\(?=\\*{template.rest})", "")


def _by_role(role: Column, template: Template, value, other: Column) -> Column:
    out = None
    for name, form in template.forms.items():
        out = (F if out is None else out).when(role == name, F.lit(value(form)))
    return other if out is None else out.otherwise(other)


def final_state(roles: Column, template: Template = INSTRUCT) -> Column:
    """State after a conversation's roles; null once a move is missing."""
    def step(state: Column, role: Column) -> Column:
        out = F.lit(None).cast("string")
        for frm, moves in template.moves.items():
            for by, to in moves.items():
                out = F.when((state == frm) & (role == by), to).otherwise(out)
        return out

    return F.aggregate(roles, F.lit(template.start), step)


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, n_turns, valid."""
    first, between, last = template.other
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.select("conv_id", F.struct(
        "turn", role.alias("role"), escape(text, template).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def marker(text: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(False).alias("loss"))

    def segments(t: Column) -> Column:
        other = F.concat(F.lit(first), escape(t["role"], template), F.lit(between))
        return F.array(
            marker(_by_role(t["role"], template, lambda f: f.prefix, other)),
            F.struct(t["text"].alias("text"), _by_role(t["role"], template, lambda f: f.loss, F.lit(False)).alias("loss")),
            marker(_by_role(t["role"], template, lambda f: f.suffix, F.lit(last))))

    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    return grouped.select(
        "conv_id", F.flatten(F.transform("turns", segments)).alias("segments"),
        F.coalesce(state.isin(*template.accept), F.lit(False)).alias("valid"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss, unescaped."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"], template)), "")


def parse_turns(text: Column, template: Template = INSTRUCT) -> Column:
    """array<struct<role, text>> read back from a formatted string."""
    first, between, last = template.other
    q = re.escape
    forms = [f"{q(f.prefix)}.*?{q(f.suffix)}" for f in template.forms.values()]
    found = F.regexp_extract_all(text, F.lit("(?s)" + "|".join([*forms, f"{q(first)}.*?{q(last)}"])), F.lit(0))

    def inside(t: Column, prefix: str, suffix: str) -> Column:
        return t.substr(F.lit(len(prefix) + 1), F.length(t) - len(prefix) - len(suffix))

    def turn(t: Column) -> Column:
        # role and text of the "other" form stand on both sides of its middle marker
        body = inside(t, first, last)
        role, said = F.substring_index(body, between, 1), body.substr(
            F.length(F.substring_index(body, between, 1)) + len(between) + 1, F.length(body))
        for name, form in template.forms.items():
            role = F.when(t.startswith(form.prefix), name).otherwise(role)
            said = F.when(t.startswith(form.prefix), inside(t, form.prefix, form.suffix)).otherwise(said)
        return F.struct(unescape(role, template).alias("role"), unescape(said, template).alias("text"))

    return F.transform(found, turn)


def conversation_digests(output: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digests of written conversations, from their segments alone."""
    read = output.select("conv_id", "segments", "valid", formatted(F.col("segments")).alias("whole"))
    read = read.select("conv_id", "valid", F.length("whole").cast("bigint").alias("formatted_chars"),
                       parse_turns(F.col("whole"), template).alias("turns"),
                       loss_text(F.col("segments"), template).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "valid")


ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(text, '([\[<])(\\*(?:/?(?:SYS|INST|ROLE)\]|TEXT\]|/?s>))', '\1\\\2', 'g') AS safe,
    CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 19 + length(regexp_replace(role, '([\[<])(\\*(?:/?(?:SYS|INST|ROLE)\]|TEXT\]|/?s>))', '\1\\\2', 'g'))
    END AS marks
  FROM turns
), numbered AS (
  SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS before, count(*) OVER (PARTITION BY conv_id) AS n
  FROM escaped WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, safe)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(safe) + marks)::BIGINT AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN pos = 1
                     WHEN 'user' THEN pos = 1 OR before IN ('system', 'assistant')
                     WHEN 'assistant' THEN coalesce(before = 'user', false)
                     ELSE false END AND (pos < n OR role = 'assistant')) AS valid
FROM numbered GROUP BY conv_id
"""
