"""Chat formatting by schema fingerprint.

Native DataFrame functions only. The nested field paths of a source (of its DataFrame schema,
or of each JSON record) are hashed; the hash selects a declarative mapping that turns the
layout into canonical turns (role, text). Paths that no layout of the kind names don't count: a
table is looked up among the layouts of a row for each turn, then among those of a row for each
conversation. A template then marks the turns::

    <turn ROLE>TEXT</turn>\\n

Backslash and ``<`` inside texts are written ``\\b`` and ``\\l`` (and ``>`` inside roles
``\\g``), so no text can hold a control string, and the escape can be undone. The loss mask
is the list of spans (code points of the formatted text) of the assistant texts.

Cases: a null text or role is the empty one; turns of the same number are ordered by role,
then text; repeated rows are repeated turns; rows without a conversation id form one
conversation; a record of unknown layout, or with a message that lacks its role or text, keeps
its row with ``layout`` null and no turns; a table of unknown layout is an error; very long texts and conversations are one row each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "<turn ", "</turn>\n"
TURN = "struct<role:string,text:string>"


@dataclass(frozen=True)
class Layout:
    """How a layout's fields become turns.

    ``pairs`` are (role, path) in order, for layouts of a field for each turn; ``messages``
    is the path of an array with ``role`` and ``text`` field names; ``rows`` maps a table
    with a row for each turn. ``roles`` renames the source's roles.
    """

    name: str
    paths: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None
    rows: tuple[str, str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("turn_rows", ("conv_id", "role", "text", "turn"), rows=("conv_id", "turn", "role", "text")),
    Layout("prompt_completion", ("completion", "prompt"), pairs=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", ("prompt", "response"), pairs=(("user", "prompt"), ("assistant", "response"))),
    Layout("system_prompt_response", ("prompt", "response", "system"), pairs=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("instruction", ("instruction", "output"), pairs=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", ("input", "instruction", "output"), pairs=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("question_answer", ("answer", "question"), pairs=(("user", "question"), ("assistant", "answer"))),
    Layout("messages", ("messages[].content", "messages[].role"), messages=("messages", "role", "content")),
    Layout("message_parts", ("messages[].content[].text", "messages[].role"), messages=("messages", "role", "content")),
    Layout("from_value", ("conversations[].from", "conversations[].value"), messages=("conversations", "from", "value"), roles=(("human", "user"), ("gpt", "assistant"))),
)

#: All fields that JSON records of the known layouts may have.
RECORD = (
    "prompt string, completion string, response string, system string, instruction string, input string, output string, "
    "question string, answer string, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>"
)


#: Messages whose content is a list of parts.
PARTS = "messages array<struct<role:string,content:array<struct<type:string,text:string>>>>"


def field_paths(schema: T.DataType, at: str = "") -> Iterator[str]:
    """The paths of a schema's leaves; ``[]`` marks array elements."""
    if isinstance(schema, T.StructType):
        for field in schema.fields:
            yield from field_paths(field.dataType, f"{at}.{field.name}" if at else field.name)
    elif isinstance(schema, T.ArrayType):
        yield from field_paths(schema.elementType, f"{at}[]")
    else:
        yield at


def _fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(paths), "\n"), 256)


def fingerprint(paths: Iterable[str]) -> str:
    """The hash that ``_fingerprint`` gives for the same paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


#: The layouts of a row for each turn and those of a record, by the hash of their paths.
ROW_PRINTS, RECORD_PRINTS = ({fingerprint(x.paths): x for x in LAYOUTS if bool(x.rows) == rows} for rows in (True, False))


def layout_of(df: DataFrame) -> Layout | None:
    """The layout that the hash of the schema's field paths selects."""
    have = set(field_paths(df.schema))
    for prints in (ROW_PRINTS, RECORD_PRINTS):
        named = {p for x in prints.values() for p in x.paths}
        if found := prints.get(fingerprint(have & named)):
            return found
    return None


def _renamed(role: Column, layout: Layout) -> Column:
    for old, new in layout.roles:
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return role


def _turns(layout: Layout, at) -> Column:
    """Turns of a record; ``at`` gives the column of a path."""
    empty = F.lit("")
    if layout.messages:
        path, role, text = layout.messages
        parts = any(p.count("[]") > 1 for p in layout.paths)
        plain = lambda m: F.array_join(F.transform(m[text], lambda x: x["text"]), "") if parts else m[text]
        return F.transform(at(path), lambda m: F.struct(F.coalesce(_renamed(m[role], layout), empty).alias("role"), F.coalesce(plain(m), empty).alias("text")))
    parts = [(r, at(p)) for r, p in layout.pairs]
    return F.array_compact(F.array(*(F.when(c.isNotNull(), F.struct(F.lit(r).alias("role"), c.alias("text"))) for r, c in parts)))


def _present(path: str) -> Column:
    """Whether a record of ``RECORD`` or ``PARTS`` has a leaf; no message lacks one where there are no messages."""
    top, _, leaf = path.partition("[].")
    if not leaf:
        return F.col(f"#r.{top}").isNotNull()
    if "[]" in leaf:
        return (F.size(f"#p.{top}") > 0) & F.forall(f"#p.{top}", lambda m: (F.size(m["content"]) > 0) & F.forall(m["content"], lambda x: x["text"].isNotNull()))
    found = F.forall(f"#r.{top}", lambda m: m[leaf].isNotNull())
    # As text, a list of parts is its JSON; it isn't a leaf then.
    return found & ~F.coalesce(F.exists(f"#p.{top}", lambda m: m["content"].isNotNull()), F.lit(False)) if path == "messages[].content" else found


def canonical_records(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``df`` with ``layout`` and ``turns`` of a column of JSON records, each of its own layout.

    A record's paths are those of its non-null leaves (in an array, of the leaves that no element lacks); their hash selects the mapping.
    """
    keep = [c for c in df.columns if c not in ("layout", "turns")]
    parsed = df.select(*(F.col(f"`{c}`") for c in keep), F.from_json(F.col(f"`{payload}`"), RECORD).alias("#r"), F.from_json(F.col(f"`{payload}`"), PARTS).alias("#p"))
    leaves = [*field_paths(T.StructType.fromDDL(RECORD)), "messages[].content[].text"]
    present = F.array_compact(F.array(*(F.when(_present(p), F.lit(p)) for p in leaves)))
    parsed = parsed.withColumn("#print", _fingerprint(present))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for key, layout in RECORD_PRINTS.items():
        hit = F.col("#print") == key
        name = F.when(hit, F.lit(layout.name)).otherwise(name)
        side = "#p" if layout.name == "message_parts" else "#r"
        turns = F.when(hit, _turns(layout, lambda p, side=side: F.col(f"{side}.{p}"))).otherwise(turns)
    return parsed.select(*keep, name.alias("layout"), turns.alias("turns"))


def turn_rows(df: DataFrame) -> DataFrame:
    """Canonical turns as rows: conv_id, turn, role, text, by the layout that the schema's fingerprint selects.

    A table with a row for each conversation needs ``conv_id`` too; its turns are numbered from 0.
    """
    layout = layout_of(df)
    if layout is None or not layout.rows and "conv_id" not in df.columns:
        raise ValueError(f"no layout of turns among the columns {df.columns}")
    if not layout.rows:
        rows = df.select("conv_id", F.posexplode(_turns(layout, lambda p: F.col(f"`{p}`"))).alias("turn", "#t"))
        return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("#t.role").alias("role"), F.col("#t.text").alias("text"))
    conv, turn, role, text = layout.rows
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), _renamed(blank(role), layout).alias("role"), blank(text).alias("text"))


def escape(text: Column) -> Column:
    """A text without ``<``; a backslash stands only before ``b`` or ``l``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo ``escape``."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def gathered(turns: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id and ``turns``, in the order of turn, role and text. Turns are gathered, as each conversation is one output row; nothing else is."""
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("#turns"))
    return ordered.select("conv_id", F.transform("#turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def as_records(conversations: DataFrame) -> DataFrame:
    """conv_id and ``payload``: each conversation as a JSON record of one of four layouts, chosen by a hash of its id.

    The layouts are messages, messages of two parts, senders with values, and, where the turns are one of a user
    and one of an assistant, prompt and response. A layout that can't tell a conversation's turns is replaced by messages.
    """
    kind, turns = F.pmod(F.xxhash64("conv_id"), F.lit(4)), F.col("turns")
    half = lambda t: F.floor(F.length(t) / 2).cast("int")
    part = lambda x: F.struct(F.lit("text").alias("type"), x.alias("text"))
    parts = lambda t: F.array(part(F.substr(t, F.lit(1), half(t))), part(F.substr(t, half(t) + 1)))
    sender = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    roles = F.transform(turns, lambda t: t["role"])
    messages = F.to_json(F.struct(F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))
    in_parts = F.to_json(F.struct(F.transform(turns, lambda t: F.struct(t["role"].alias("role"), parts(t["text"]).alias("content"))).alias("messages")))
    senders = F.to_json(F.struct(F.transform(turns, lambda t: F.struct(sender(t["role"]).alias("from"), t["text"].alias("value"))).alias("conversations")))
    pair = F.to_json(F.struct(F.get(turns, 0)["text"].alias("prompt"), F.get(turns, 1)["text"].alias("response")))
    renamed = F.array_contains(roles, "human") | F.array_contains(roles, "gpt")
    payload = F.when(kind == 1, in_parts).when((kind == 2) & ~renamed, senders).when((kind == 3) & (roles == F.lit(["user", "assistant"])), pair).otherwise(messages)
    return conversations.select("conv_id", payload.alias("payload"))


def format_turns(turns: DataFrame) -> DataFrame:
    """``format_conversations`` of turns as rows: conv_id, turn, role, text."""
    return format_conversations(gathered(turns))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start, length; from 1) of conversations with their ``turns``, an array of role and text."""
    head = lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(">"))
    parts = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))
    made = conversations.select("conv_id", parts.alias("#parts"))
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        at = acc["next"] + F.length(p["head"])
        span = F.struct(at.alias("start"), F.length(p["body"]).alias("length"))
        spans = F.when(p["loss"], F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((at + F.length(p["body"]) + len(CLOSE)).alias("next"), spans.alias("spans"))

    return made.select(
        "conv_id",
        F.array_join(F.transform("#parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("#parts", start, step, lambda acc: acc["spans"]).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts read from ``formatted`` and ``loss_spans`` alone."""
    pieces = F.split("formatted", CLOSE, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    turn = lambda p: F.struct(
        unescape_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ">", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, ">") + 1)).alias("text"),
    )
    return formatted.select(
        "*",
        F.transform(pieces, turn).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"], s["length"]))).alias("loss_texts"),
    )


def digest(back: DataFrame) -> DataFrame:
    """The columns by which two renderings are compared."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
