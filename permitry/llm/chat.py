"""Chat formatting: conversations as text segments with loss flags from a declarative template, in DataFrame operations only.

A ``Template`` names the control strings, the roles whose texts are learned, and a finite-state machine over roles: the
state after a turn is its role, and ``follows`` lists the roles that may come next.

1. Turns are grouped by conversation and 2 ** ``CHUNK_BITS`` turn numbers, pre-aggregated in each task, so a giant conversation is
   formatted by many tasks.
2. A chunk gives its segments (text, loss) and its transfer function: for every state it may be entered in, the state it is
   left in, the number of turns that were not allowed and the first of them. Functions compose, so only these small
   arrays are folded over a conversation.
3. ``formatted`` puts the chunks of a conversation together, ``read_back`` takes its turns and its learned text from the
   formatted text and the flagged segments again.

Control strings inside a text are escaped: every ``<``, k backslashes and ``|`` get one backslash more, so ``<|`` occurs in
control strings alone, and one less when read back. In roles ``%``, line ends and ``<`` become %25, %0A and %3C.

A turn that is not allowed is counted and formatted like the others; the machine goes on from its role, or, if it does
not know the role, from the state it had.

Defined cases: NULL text and role count as empty; turns are in order of turn number, NULL ones last, and turns of one
number in order of role and text; repeated rows are turns of their own; a NULL conversation id is a conversation like
another; an empty table gives an empty result; very long texts are one segment; columns other than the four named ones
are not looked at, whatever their names.
"""

import re
from dataclasses import dataclass, field

from pyspark.sql import functions as F

#: A chunk holds the turn numbers that are equal but for their last bits.
CHUNK_BITS = 8
_BEGIN = ""


@dataclass(frozen=True)
class Template:
    """``start`` role ``opened`` text ``end`` for each turn. Control strings begin with ``<|`` and no other text does."""

    start: str = "<|im_start|>"
    opened: str = "\n"
    end: str = "<|im_end|>\n"
    learned: tuple = ("assistant",)
    follows: dict = field(default_factory=lambda: {
        _BEGIN: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant", "tool"),
    })
    complete: tuple = ("assistant",)

    @property
    def states(self):
        return list(self.follows)


CHATML = Template()


def escaped(text):
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text):
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escaped_role(role):
    for mark, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(mark), F.lit(code))
    return role


def _unescaped_role(role):
    for mark, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(mark))
    return role


def _segments(turn, template):
    """The three segments of a turn: control strings with the role, the text, the end."""
    def segment(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    opening = F.concat(F.lit(template.start), _escaped_role(turn["role"]), F.lit(template.opened))
    return F.array(segment(opening, F.lit(False)), segment(escaped(turn["text"]), turn["role"].isin(*template.learned)),
                   segment(F.lit(template.end), F.lit(False)))


def _step(at, role, template):
    """The machine after one more turn: state, number of turns, turns that were not allowed, the first of them."""
    allowed = F.concat_ws("\n", at["state"], role).isin(*[f"{state}\n{r}" for state, roles in template.follows.items() for r in roles])
    return F.struct(
        F.when(role.isin(*[s for s in template.states if s != _BEGIN]), role).otherwise(at["state"]).alias("state"),
        (at["turns"] + 1).alias("turns"),
        (at["wrong"] + F.when(allowed, 0).otherwise(1)).alias("wrong"),
        F.when(allowed | at["first"].isNotNull(), at["first"]).otherwise(at["turns"]).alias("first"))


def _entered(state):
    return F.struct(state.alias("state"), F.lit(0).cast("bigint").alias("turns"), F.lit(0).cast("bigint").alias("wrong"),
                    F.lit(None).cast("bigint").alias("first"))


def _transfer(turns, template):
    """For each state that the turns may be entered in, the machine after them."""
    return F.map_from_arrays(
        F.array(*[F.lit(s) for s in template.states]),
        F.array(*[F.aggregate(turns, _entered(F.lit(s)), lambda at, turn: _step(at, turn["role"], template))
                  for s in template.states]))


def _composed(at, transfer):
    """The machine ``at`` after a chunk with this transfer function."""
    after = transfer[at["state"]]
    return F.struct(
        after["state"].alias("state"), (at["turns"] + after["turns"]).alias("turns"), (at["wrong"] + after["wrong"]).alias("wrong"),
        F.coalesce(at["first"], at["turns"] + after["first"]).alias("first"))


def chunks(conversations, template=CHATML, id_column="conv_id", turn_column="turn", role_column="role", text_column="text"):
    """Rows (id, chunk, segments, transfer): up to 2 ** ``CHUNK_BITS`` turn numbers of a conversation."""
    number = F.col(f"`{turn_column}`").cast("bigint")
    rows = conversations.select(
        F.col(f"`{id_column}`").alias("id"), F.shiftright(number, CHUNK_BITS).alias("chunk"),
        F.struct(F.isnull(number).alias("last"), number.alias("number"),
                 F.coalesce(F.col(f"`{role_column}`").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text")).alias("turn"))
    grouped = rows.groupBy("id", "chunk").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return grouped.select(
        "id", F.struct(F.isnull("chunk").alias("last"), F.col("chunk").alias("number")).alias("chunk"),
        F.flatten(F.transform("turns", lambda turn: _segments(turn, template))).alias("segments"),
        _transfer(F.col("turns"), template).alias("transfer"))


def _whole(text_of):
    return F.array_join(F.transform("chunks", text_of), "")


def _machine(template):
    return F.aggregate("chunks", _entered(F.lit(_BEGIN)), lambda at, chunk: _composed(at, chunk["transfer"]))


def _gathered(rows, *columns):
    """One row per id with the chunks in order, each with the given columns."""
    chunk = F.struct("chunk", "transfer", *columns)
    return rows.groupBy("id").agg(F.array_sort(F.collect_list(chunk), lambda a, b: _compared(a["chunk"], b["chunk"])).alias("chunks"))


def _compared(a, b):
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def _verdict(template):
    after = F.col("machine")
    return [after["turns"].alias("n_turns"), (after["wrong"] == 0).alias("valid"), after["wrong"].alias("wrong_turns"),
            after["first"].alias("first_wrong_turn"), after["state"].isin(*template.complete).alias("complete")]


def formatted(conversations, template=CHATML, id_column="conv_id", **columns):
    """One row per conversation: id, n_turns, valid, wrong_turns, first_wrong_turn (from 0), complete, segments, text.

    ``segments`` is an array of (text, loss), ``text`` their concatenation; ``valid`` says that every turn was allowed and
    ``complete`` that the last role may be the last.
    """
    whole = _gathered(chunks(conversations, template, id_column, **columns), "segments").withColumn("machine", _machine(template))
    whole = whole.withColumn("segments", F.flatten(F.transform("chunks", lambda c: c["segments"])))
    return whole.select(F.col("id").alias(id_column), *_verdict(template), "segments",
                        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"))


def turns_of(text, template=CHATML):
    """Array of (role, text) read from a formatted text."""
    def turn(part):
        role = F.substring_index(part, template.opened, 1)
        kept = F.length(part) - F.length(role) - len(template.opened) - len(template.end)
        return F.struct(_unescaped_role(role).alias("role"),
                        unescaped(F.substr(part, F.length(role) + F.lit(len(template.opened) + 1), kept)).alias("text"))

    return F.transform(F.filter(F.split(text, re.escape(template.start)), lambda part, at: at > 0), turn)


def learned_text(segments):
    """The text under the loss flags, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def read_back(conversations, template=CHATML, id_column="conv_id", **columns):
    """One row per conversation: id, the verdict as in ``formatted``, turns as one text, learned text, formatted_chars.

    Both texts are read from the formatted segments of each chunk, where a giant conversation still is in many tasks.
    ``turns_text`` is role, line end, text, line end for each turn.
    """
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    found = chunks(conversations, template, id_column, **columns).withColumn("text", text)
    lines = F.transform(turns_of(F.col("text"), template), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    found = found.select("id", "chunk", "transfer", F.array_join(lines, "").alias("turns_text"), F.length("text").cast("bigint").alias("chars"),
                         learned_text(F.col("segments")).alias("loss_text"))
    whole = _gathered(found, "turns_text", "loss_text", "chars").withColumn("machine", _machine(template))
    return whole.select(
        F.col("id").alias(id_column), *_verdict(template),
        _whole(lambda c: c["turns_text"]).alias("turns_text"), _whole(lambda c: c["loss_text"]).alias("loss_text"),
        F.aggregate("chunks", F.lit(0).cast("bigint"), lambda n, c: n + c["chars"]).alias("formatted_chars"))
