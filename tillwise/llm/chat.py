"""Chat formatting: records of several layouts become canonical turns, then marked text with a loss mask.

A record's layout is told by its schema fingerprint: the 64-bit hash of the sorted nested
field paths that are present (not null) in it, of those any layout knows. Every mapping
states the paths it needs and those it may have, so the fingerprints it answers to are
constants; a record takes the mapping its fingerprint selects, or none.

The template writes a turn as ``### Role: text</turn>`` and a line feed. Inside texts a
backslash goes before every backslash, every ``#`` and a ``/`` that follows ``<``, so
neither mark can occur there, and taking one backslash away gives the text back.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of roles in the template; any other role is written after an equals sign.
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
#: Roles as other layouts call them.
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
OPEN, CLOSE = "### ", "</turn>"
#: The role whose texts are learned.
LEARNED = "assistant"


@dataclass(frozen=True)
class Layout:
    """A declarative mapping from field paths to turns.

    ``fixed`` lists (role, path) of one turn each, in order; ``listed`` is (array path,
    role field, text field) of an array of turns; ``row`` is (role path, text path) of a
    record that is one turn. A path in ``needs`` must be present, one in ``may`` can be.
    """

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    fixed: tuple[tuple[str, str], ...] = ()
    listed: tuple[str, str, str] | None = None
    row: tuple[str, str] | None = None
    aliases: Mapping[str, str] = field(default_factory=dict)

    def path_sets(self) -> Iterator[tuple[str, ...]]:
        for n in range(len(self.may) + 1):
            for extra in itertools.combinations(self.may, n):
                yield tuple(sorted(self.needs + extra))


LAYOUTS = (
    Layout("messages", ("messages", "messages[].content", "messages[].role"),
           listed=("messages", "role", "content"), aliases=ALIASES),
    Layout("conversations", ("conversations", "conversations[].from", "conversations[].value"),
           listed=("conversations", "from", "value"), aliases=ALIASES),
    Layout("instruction", ("instruction", "output"), ("system", "input"),
           fixed=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("prompt", ("completion", "prompt"), ("system",),
           fixed=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Layout("response", ("prompt", "response"), ("system",),
           fixed=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question", ("answer", "question"), ("context",),
           fixed=(("user", "context"), ("user", "question"), ("assistant", "answer"))),
    Layout("turn row", (), ("role", "text"), row=("role", "text")),
)


def _quoted(*names: str) -> Column:
    return F.col(".".join(f"`{n.replace('`', '``')}`" for n in names))


def _has(name: str):
    return lambda x: x[name].isNotNull()


def paths(schema: T.StructType) -> dict[str, Column]:
    """Nested field paths of a schema, each with whether it is present in a record.

    A field of an array of structs is present if any element has it.
    """
    out: dict[str, Column] = {}

    def walk(kind: T.StructType, path: str, names: tuple[str, ...]) -> None:
        for f in kind.fields:
            here, at = f"{path}{f.name}", (*names, f.name)
            out[here] = _quoted(*at).isNotNull()
            inner = f.dataType
            if isinstance(inner, T.StructType):
                walk(inner, f"{here}.", at)
            elif isinstance(inner, T.ArrayType) and isinstance(inner.elementType, T.StructType):
                for g in inner.elementType.fields:
                    out[f"{here}[].{g.name}"] = F.coalesce(F.exists(_quoted(*at), _has(g.name)), F.lit(False))

    walk(schema, "", ())
    return out


def fingerprint(schema: T.StructType, known: set[str]) -> Column:
    """Hash of the sorted known paths that are present; unknown fields do not count."""
    found = {p: c for p, c in paths(schema).items() if p in known}
    marks = [F.when(found[p], F.lit(p)) for p in sorted(found)]
    return F.xxhash64(F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>"))


def _hash_of(names: tuple[str, ...]) -> Column:
    return F.xxhash64(F.array(*map(F.lit, names)) if names else F.array().cast("array<string>"))


def _role(role: Column, aliases: Mapping[str, str]) -> Column:
    for old, new in aliases.items():
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return F.coalesce(role, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.cast("string").alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _turns(layout: Layout, have: dict[str, Column]) -> Column:
    """The layout's turns; a path that the table lacks or that is null gives no turn."""
    nothing = F.lit(None).cast("string")
    if layout.row:
        role, text = (_quoted(*p.split(".")) if p in have else nothing for p in layout.row)
        return F.array(_turn(_role(role, layout.aliases), text))
    if layout.listed:
        array, role, text = layout.listed
        return F.transform(_quoted(*array.split(".")), lambda m: _turn(_role(m[role], layout.aliases), m[text]))
    turns = [F.when(have[p], _turn(F.lit(role), _quoted(*p.split("."))))
             for role, p in layout.fixed if p in have]
    return F.array_compact(F.array(*turns))


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with its layout's name (``layout``) and array of turns (``turns`` of role and text).

    A record that no mapping answers to has a null layout and no turns. Null texts are
    empty; fields no layout knows are left alone. An earlier mapping wins where two share
    a fingerprint.
    """
    have = paths(records.schema)
    known = {p for m in layouts for p in (*m.needs, *m.may)}
    print_ = F.col("__print")
    name, turns = F.lit(None).cast("string"), F.array().cast("array<struct<role:string,text:string>>")
    for m in reversed(layouts):
        if not set(m.needs) <= set(have):
            continue
        hits = [_hash_of(p) for p in m.path_sets() if set(p) <= set(have)]
        if not hits:
            continue
        hit = print_.isin(*hits)
        name = F.when(hit, F.lit(m.name)).otherwise(name)
        turns = F.when(hit, _turns(m, have)).otherwise(turns)
    return (records.withColumn("__print", fingerprint(records.schema, known))
            .withColumns({"layout": name, "turns": turns}).drop("__print"))


# -- template ---------------------------------------------------------------------------

def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#]|(?<=<)/)", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _header(role: Column) -> Column:
    name = F.concat(F.lit("="), F.regexp_replace(escaped(role), ":", r"\\:"))
    for known, shown in NAMES.items():
        name = F.when(role == known, F.lit(shown)).otherwise(name)
    return F.concat(F.lit(OPEN), name, F.lit(": "))


def segments(turns: Column) -> Column:
    """Pieces of the marked text in order, each with whether it is learned (``in_loss``)."""
    def piece(text, learned):
        return F.struct(text.alias("text"), learned.alias("in_loss"))

    return F.flatten(F.transform(turns, lambda t: F.array(
        piece(_header(t["role"]), F.lit(False)),
        piece(escaped(t["text"]), t["role"] == LEARNED),
        piece(F.lit(CLOSE + "\n"), F.lit(False)))))


def joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def format_turns(turns: DataFrame, conv: str = "conv_id", order: tuple[str, ...] = ("turn",)) -> DataFrame:
    """(conv, segments, formatted) per conversation from rows with an array ``turns``.

    Rows go by ``order``, nulls first, then by their turns, so equal keys and repeated
    rows have one order; a null conversation id is a conversation of its own. All turns
    of one conversation make one row, as its text is one value.
    """
    rows = F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)],
                                                F.col("turns").alias("turns"))))
    grouped = turns.groupBy(F.col(conv).alias("__conv")).agg(rows.alias("rows"))
    pieces = grouped.select("__conv", segments(F.flatten(F.transform("rows", lambda r: r["turns"]))).alias("segments"))
    return pieces.select(F.col("__conv").alias(conv), "segments", joined(F.col("segments")).alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """Turns read back from marked text."""
    parts = F.filter(F.split(formatted, CLOSE + "\n", -1), lambda x: x != "")
    head = r"^(?s)### ((?:[^\\:]|\\.)*): (.*)$"

    def role(name):
        known = F.lit(None).cast("string")
        for inner, shown in NAMES.items():
            known = F.when(name == shown, F.lit(inner)).otherwise(known)
        return F.coalesce(known, unescaped(F.substring(name, 2, 2147483647)))

    return F.transform(parts, lambda p: F.struct(
        role(F.regexp_extract(p, head, 1)).alias("role"),
        unescaped(F.regexp_extract(p, head, 2)).alias("text")))


def learned_text(pieces: Column) -> Column:
    """Text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["in_loss"]), lambda p: unescaped(p["text"])), "")


def sample_record(records: DataFrame) -> DataFrame:
    """Conversation -7, both of whose texts hold the template's own marks, in the prompt layout."""
    text = F.lit(r"\### Assistant: </turn> ok")
    return records.sparkSession.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), text.alias("prompt"), text.alias("completion"))


def op11(conversations: DataFrame) -> DataFrame:
    """The registered report: digests of all conversations and of conversation -7, read back from the output.

    The table's rows are records of one turn each; conversation -7 is a record of prompt
    and completion; both layouts are told apart by their fingerprints. Null roles and
    texts count as empty. Other columns are ignored; an empty table leaves conversation -7.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    records = rows.unionByName(sample_record(conversations), allowMissingColumns=True)
    out = format_turns(canonical(records))
    said = F.array_join(F.transform(read_turns(F.col("formatted")),
                                    lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = out.select("conv_id", "formatted", F.size(read_turns(F.col("formatted"))).cast("long").alias("n_turns"),
                         said.alias("said"), learned_text(F.col("segments")).alias("learned"))
    return learned.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
