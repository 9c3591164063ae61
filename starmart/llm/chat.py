r"""Chat formatting: records of many layouts to canonical turns, and turns to masked training text.

Built from DataFrame functions only.  A record is a JSON text.  Its schema
fingerprint is a hash of its sorted nested field paths (``messages[].role``);
each declared ``Layout`` lists the paths it is made of, so its own
fingerprints are known beforehand and a record is converted by the mapping
that its fingerprint selects, never by guessing.  Records of unknown layout
stay, with null turns.

The template marks each turn as ``<s>role\ntext</s>``.  Control strings inside a
text are escaped by a backslash after their first character (one more where
there are some already), which is undone exactly; a role is percent-encoded.
The loss mask is a list of spans (start and length in code points) of the
formatted text, one for each assistant text.

Defined results: null and empty texts are empty turns; null roles are empty
roles; a record that isn't a JSON object has no layout; one too long for a
variant is read with the types that the layouts declare; a conversation without
turns is formatted as an empty text; turns that share a number are ordered by
role and text; other columns are passed on.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings that mark structure in this template or in common ones; they are escaped inside texts.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
#: Levels of nesting that field paths are read to.
DEPTH = 3
TURNS = "array<struct<role: string, text: string>>"
#: Bytes of a record up to which it is read as a variant, which has a limit of its own above that.
VARIANT_BYTES = 48 << 20


@dataclass(frozen=True)
class Layout:
    """A declared layout: how to read turns from records that have these fields.

    ``turns`` lists steps.  ``("each", list, role field, text field, roles)``
    reads a list of messages, with names of roles mapped by ``roles``;
    ``("text", role, fields)`` makes one turn of the given fields joined by an
    empty line.  Fields in ``optional`` may be missing; a turn whose fields are
    all missing is left out.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple
    optional: tuple[str, ...] = ()


SPEAKERS = (("human", "user"), ("gpt", "assistant"))

LAYOUTS = (
    Layout("messages", ("messages", "messages[].role", "messages[].content"), (("each", "messages", "role", "content", ()),)),
    Layout("conversations", ("conversations", "conversations[].from", "conversations[].value"), (("each", "conversations", "from", "value", SPEAKERS),)),
    Layout("prompt", ("prompt", "response"), (("text", "system", ("system",)), ("text", "user", ("prompt",)), ("text", "assistant", ("response",))), ("system",)),
    Layout("instruction", ("instruction", "output"), (("text", "system", ("system",)), ("text", "user", ("instruction", "input")), ("text", "assistant", ("output",))), ("system", "input")),
    Layout("question", ("question", "answer"), (("text", "user", ("context", "question")), ("text", "assistant", ("answer",))), ("context",)),
    Layout("nested prompt", ("prompt", "prompt[].role", "prompt[].content", "completion"), (("each", "prompt", "role", "content", ()), ("text", "assistant", ("completion",)))),
)


# --- fingerprints -----------------------------------------------------------

def _paths_below(value: Column, prefix: Column, depth: int) -> Column:
    """Paths of the fields of a variant: those of an object, and those of the objects in a list."""
    empty = F.expr("cast(array() as array<string>)")

    def fields(obj: Column, name: Column) -> Column:
        entries = F.coalesce(F.map_entries(F.try_variant_get(obj, "$", "map<string, variant>")), F.expr("cast(array() as array<struct<key: string, value: variant>>)"))

        def one(e: Column) -> Column:
            own = F.concat(name, F.when(F.length(name) > 0, F.lit(".")).otherwise(F.lit("")), e["key"])
            return F.concat(F.array(own), _paths_below(e["value"], own, depth - 1) if depth > 1 else empty)
        return F.flatten(F.transform(entries, one))

    kind = F.schema_of_variant(value)
    items = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    return (F.when(kind.startswith("OBJECT<"), fields(value, prefix))
            .when(kind.startswith("ARRAY<"), F.flatten(F.transform(items, lambda x: F.when(F.schema_of_variant(x).startswith("OBJECT<"), fields(x, F.concat(prefix, F.lit("[]")))).otherwise(empty))))
            .otherwise(empty))


def field_paths(record: Column, depth: int = DEPTH) -> Column:
    """Sorted distinct nested field paths of a variant, e.g. ``messages``, ``messages[].role``."""
    return F.array_sort(F.array_distinct(_paths_below(record, F.lit(""), depth)))


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n"), 256)


def _fingerprints(layout: Layout) -> list[str]:
    """The fingerprints of a layout, one for each set of its optional fields."""
    import hashlib

    some = chain.from_iterable(combinations(layout.optional, k) for k in range(len(layout.optional) + 1))
    return [hashlib.sha256("\n".join(sorted({*layout.paths, *x})).encode()).hexdigest() for x in some]


def _message(x: Column, role: str, text: str, roles: tuple) -> Column:
    own = F.try_variant_get(x, f"$.{role}", "string")
    named = own
    for a, b in roles:
        named = F.when(own == a, F.lit(b)).otherwise(named)
    return F.struct(F.coalesce(named, F.lit("")).alias("role"), F.coalesce(F.try_variant_get(x, f"$.{text}", "string"), F.lit("")).alias("text"))


def _steps(record: Column, layout: Layout) -> Column:
    """The turns that a layout's steps read from a record."""
    parts = []
    for kind, *step in layout.turns:
        if kind == "each":
            name, role, text, roles = step
            items = F.coalesce(F.try_variant_get(record, f"$.{name}", "array<variant>"), F.expr("cast(array() as array<variant>)"))
            parts.append(F.transform(items, lambda x: _message(x, role, text, roles)))  # noqa: B023 - called at once
        else:
            role, fields = step
            present = F.coalesce(*[F.try_variant_get(record, f"$.{f}", "variant") for f in fields]).isNotNull()
            text = F.concat_ws("\n\n", *[F.try_variant_get(record, f"$.{f}", "string") for f in fields])
            parts.append(F.when(present, F.array(F.struct(F.lit(role).alias("role"), text.alias("text")))).otherwise(F.expr(f"cast(array() as {TURNS})")))
    return F.concat(*parts)


def _typed(record: Column, layouts: tuple) -> Column:
    """What the layouts need of a record too long for a variant: its keys, its lists of messages and its texts."""
    steps = [step for layout in layouts for step in layout.turns]
    lists = sorted({step[1] for step in steps if step[0] == "each"})
    texts = sorted({f for step in steps if step[0] == "text" for f in step[2]})
    read = lambda schema: F.from_json(record, schema, {"maxStringLen": str((1 << 31) - 1)})
    return F.struct(F.json_object_keys(record).alias("keys"), read(", ".join(f"`{f}` string" for f in texts)).alias("texts"),
                    F.struct(*[read(f"`{name}` array<map<string, string>>")[name].alias(name) for name in lists]).alias("lists"))


def _typed_paths(typed: Column, layouts: tuple) -> Column:
    """Sorted field paths of a typed record: its keys, and those of the messages in its lists."""
    none = F.expr("cast(array() as array<string>)")
    parts = [typed["keys"]]
    for name in sorted({step[1] for layout in layouts for step in layout.turns if step[0] == "each"}):
        own = F.flatten(F.transform(typed["lists"][name], lambda m: F.coalesce(F.map_keys(m), none)))
        parts.append(F.coalesce(F.transform(own, lambda k: F.concat(F.lit(f"{name}[]."), k)), none))  # noqa: B023 - called at once
    return F.array_sort(F.array_distinct(F.concat(*parts)))


def _typed_steps(typed: Column, layout: Layout) -> Column:
    """The turns that a layout's steps read from a typed record."""
    parts = []
    for kind, *step in layout.turns:
        if kind == "each":
            name, role, text, roles = step

            def message(m: Column) -> Column:
                named = m[role]  # noqa: B023
                for x, y in roles:  # noqa: B023
                    named = F.when(m[role] == x, F.lit(y)).otherwise(named)  # noqa: B023
                return F.struct(F.coalesce(named, F.lit("")).alias("role"), F.coalesce(m[text], F.lit("")).alias("text"))  # noqa: B023
            parts.append(F.coalesce(F.transform(typed["lists"][name], message), F.expr(f"cast(array() as {TURNS})")))
        else:
            role, fields = step
            own = [typed["texts"][f] for f in fields]
            parts.append(F.when(F.coalesce(*own).isNotNull(), F.array(F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *own).alias("text"))))
                         .otherwise(F.expr(f"cast(array() as {TURNS})")))
    return F.concat(*parts)


def to_turns(records: DataFrame, record: str = "record", layouts: tuple = LAYOUTS, variant_bytes: int = VARIANT_BYTES) -> DataFrame:
    """Add ``fingerprint``, ``layout`` and ``turns`` to records of JSON text; unknown layouts have null turns.

    Records of more than ``variant_bytes`` don't fit a variant: they are read
    with the types that the layouts declare, and their paths end at the fields
    of the messages in a list.
    """
    keys = [c for c in records.columns]
    long = F.octet_length(record) > variant_bytes
    parsed = records.withColumn("_value", F.when(~long, F.try_parse_json(F.col(record)))).withColumn("_typed", F.when(long, _typed(F.col(record), layouts)))
    marked = parsed.withColumn("fingerprint", F.when(F.col("_typed.keys").isNotNull(), fingerprint(_typed_paths(F.col("_typed"), layouts)))
                               .when(F.schema_of_variant("_value").startswith("OBJECT<"), fingerprint(field_paths(F.col("_value")))))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        own = F.col("fingerprint").isin(_fingerprints(layout))
        name = F.when(own, F.lit(layout.name)).otherwise(name)
        turns = F.when(own, F.when(F.col("_typed").isNotNull(), _typed_steps(F.col("_typed"), layout)).otherwise(_steps(F.col("_value"), layout))).otherwise(turns)
    return marked.select(*keys, "fingerprint", name.alias("layout"), turns.alias("turns"))


# --- template ---------------------------------------------------------------

def escape(text: Column, control: list[str] = CONTROL) -> Column:
    """Put a backslash after the first character of every control string, and of those already escaped."""
    heads = {c[0] for c in control}
    out = text
    for h in sorted(heads):
        tails = "|".join(r"\Q" + c[1:] + r"\E" for c in control if c[0] == h)
        out = F.regexp_replace(out, F.lit(rf"(\Q{h}\E)(\\*)(?={tails})"), F.lit(r"$1\\$2"))
    return out


def unescape(text: Column, control: list[str] = CONTROL) -> Column:
    """Undo ``escape``: take one backslash away from every escaped control string."""
    out = text
    for h in sorted({c[0] for c in control}):
        tails = "|".join(r"\Q" + c[1:] + r"\E" for c in control if c[0] == h)
        out = F.regexp_replace(out, F.lit(rf"(\Q{h}\E)\\(\\*)(?={tails})"), F.lit("$1$2"))
    return out


def format_turns(rows: DataFrame, turns: str = "turns", trained: str = "assistant") -> DataFrame:
    """Add ``formatted`` and ``loss_spans`` (start from 0 and length, in code points) to rows with turns."""
    cells = F.transform(F.col(turns), lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), escape(F.coalesce(t["text"], F.lit(""))).alias("text")))
    rows = rows.withColumn("_cells", cells)
    rows = rows.withColumn("_cells", F.transform("_cells", lambda t: F.struct(
        (t["role"] == trained).alias("trained"), F.concat(F.lit("<s>"), F.url_encode(t["role"]), F.lit("\n")).alias("head"), t["text"].alias("text"))))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, length: int>>)").alias("spans"))

    def span(acc: Column, t: Column) -> Column:
        own = F.array(F.struct((acc["at"] + F.length(t["head"])).alias("start"), F.length(t["text"]).alias("length")))
        return F.struct((acc["at"] + F.length(t["head"]) + F.length(t["text"]) + F.lit(4)).alias("at"),
                        F.when(t["trained"], F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    text = F.array_join(F.transform("_cells", lambda t: F.concat(t["head"], t["text"], F.lit("</s>"))), "")
    return rows.withColumn("formatted", text).withColumn("loss_spans", F.aggregate("_cells", start, span, lambda acc: acc["spans"])).drop("_cells")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: what stands between ``<s>`` and ``</s>``, unescaped."""
    own = F.filter(F.split(formatted, r"\Q</s>\E"), lambda x: F.length(x) > 0)
    return F.transform(own, lambda x: F.struct(
        F.url_decode(F.substring_index(x, "\n", 1).substr(F.lit(4), F.length(x))).alias("role"),
        unescape(x.substr(F.instr(x, "\n") + 1, F.length(x))).alias("text")))


def read_loss(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(F.col(spans), lambda s: unescape(F.col(formatted).substr(s["start"] + 1, s["length"])))


# --- conversations ----------------------------------------------------------

def conversation_records(rows: DataFrame) -> DataFrame:
    """``conv_id, record``: each conversation as JSON in a layout that can hold its roles.

    Exchanges of a user and an assistant, with or without a system text, are
    written as prompt, instruction or message layouts by a hash of the id;
    everything else as message lists, of one kind or the other where no role
    has the other kind's name.
    """
    cell = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(cell)).alias("_t"))
    roles = F.array_join(F.transform("_t", lambda t: t["role"]), "\n")
    at = lambda i: F.get(F.col("_t"), F.lit(i))["text"]
    kind = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    json = lambda *fields: F.to_json(F.struct(*[c.alias(n) for n, c in fields]))
    messages = json(("messages", F.transform("_t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))))
    spoken = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    talks = json(("conversations", F.transform("_t", lambda t: F.struct(spoken(t["role"]).alias("from"), t["text"].alias("value")))))
    clear = ~F.exists("_t", lambda t: t["role"].isin([a for a, _ in SPEAKERS]))
    pair, three = roles == "user\nassistant", roles == "system\nuser\nassistant"
    record = (F.when(pair & (kind == 0), json(("prompt", at(0)), ("response", at(1))))
              .when(pair & (kind == 1), json(("instruction", at(0)), ("output", at(1))))
              .when(three & (kind == 0), json(("system", at(0)), ("prompt", at(1)), ("response", at(2))))
              .when(three & (kind == 1), json(("system", at(0)), ("instruction", at(1)), ("output", at(2))))
              .when((kind >= 2) & clear, talks).otherwise(messages))
    return convs.select("conv_id", record.alias("record"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, layout, formatted, loss_spans`` of ``rows(conv_id, turn, role, text)``."""
    turns = to_turns(conversation_records(rows))
    return format_turns(turns).select("conv_id", "layout", "formatted", "loss_spans")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted text: turn count and digests of turns and loss texts."""
    rows = formatted.withColumn("_turns", read_turns(F.col("formatted"))).withColumn("_loss", F.array_join(read_loss(), ""))
    all_turns = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select("conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
                       F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
