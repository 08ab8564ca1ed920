"""Chat formatting by schema fingerprint, in SQL expressions only.

A record's nested field paths (those that any layout knows) are hashed; the hash
selects a declarative mapping that turns the record into canonical turns. Turns are
written with one template that escapes its own control strings, so that the text can
be read back exactly, and with the spans that the loss covers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

TURNS = "array<struct<role:string,text:string>>"
OPEN, CLOSE = "### ", "\n</turn>\n"
#: Control strings of the template; each is escaped inside texts by a backslash.
CONTROLS = ("###", "</turn>")
ROLE_ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


@dataclass(frozen=True)
class Layout:
    """paths: field paths that make its fingerprint ('[]': in a list). ``fields``: (role, path)
    in order, empty texts left out; then ``list`` with the fields of its elements.
    plain: its roles are canonical as they are, whatever their names; else aliases of the
    common roles get the common name."""

    name: str
    paths: tuple[str, ...]
    list: str = ""
    role: str = ""
    text: str = ""
    parts: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    plain: bool = False


def _list(name: str, at: str, role: str, text: str, parts: str = "") -> Layout:
    leaf = f"{at}[].{text}[].{parts}" if parts else f"{at}[].{text}"
    return Layout(name, (f"{at}[].{role}", leaf), list=at, role=role, text=text, parts=parts)


def _flat(name: str, *fields: tuple[str, str]) -> Layout:
    return Layout(name, tuple(p for _, p in fields), fields=fields)


LAYOUTS = (
    Layout("turns", ("turns[].role", "turns[].text"), list="turns", role="role", text="text", plain=True),
    _list("messages", "messages", "role", "content"),
    _list("message-parts", "messages", "role", "content", "text"),
    Layout("system-messages", ("system", "messages[].role", "messages[].content"), list="messages", role="role", text="content", fields=(("system", "system"),)),
    Layout("mixed-messages", ("messages[].role", "messages[].content", "messages[].content[].text"), list="messages", role="role", text="content", parts="text"),
    _list("conversations", "conversations", "from", "value"),
    _list("dialogue", "dialogue", "speaker", "utterance"),
    _flat("prompt-response", ("user", "prompt"), ("assistant", "response")),
    _flat("prompt-completion", ("user", "prompt"), ("assistant", "completion")),
    _flat("system-prompt-response", ("system", "system"), ("user", "prompt"), ("assistant", "response")),
    _flat("question-answer", ("user", "question"), ("assistant", "answer")),
    _flat("instruction-output", ("user", "instruction"), ("assistant", "output")),
    _flat("instruction-input-output", ("user", "instruction"), ("user", "input"), ("assistant", "output")),
    _flat("system-instruction-output", ("system", "system"), ("user", "instruction"), ("assistant", "output")),
)


def known_paths(layouts: tuple[Layout, ...] = LAYOUTS) -> list[str]:
    return sorted({p for x in layouts for p in x.paths})


def present(record: Column, path: str) -> Column:
    """Whether the variant has a value at ``path``, in any element of the lists on its way."""

    def has(v: Column, parts: list[str]) -> Column:
        at = f"$.{parts[0]}"
        if len(parts) == 1:
            kind = F.schema_of_variant(F.try_variant_get(v, at, "variant"))
            scalar = ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT") & (kind != "VOID")
            return F.coalesce(scalar, F.lit(False))
        return F.coalesce(F.exists(F.try_variant_get(v, at, "array<variant>"), lambda m: F.coalesce(has(m, parts[1:]), F.lit(False))), F.lit(False))

    return has(record, path.split("[]."))


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the record's known field paths, in code-point order."""
    return F.xxhash64(F.concat_ws("\n", *[F.when(present(record, p), F.lit(p)) for p in known_paths(layouts)]))


def _turns(record: Column, x: Layout) -> Column:
    def text_of(v: Column, path: str) -> Column:
        return F.coalesce(F.try_variant_get(v, f"$.{path}", "string"), F.lit(""))

    all_ = F.array(*[F.struct(F.lit(role).alias("role"), text_of(record, p).alias("text")) for role, p in x.fields])
    own = F.filter(all_, lambda t: t["text"] != "") if x.fields else None
    if not x.list:
        return own
    items = F.try_variant_get(record, f"$.{x.list}", "array<variant>")

    def turn(m: Column) -> Column:
        if x.parts:  # a turn among them may have plain text
            bits = F.transform(F.try_variant_get(m, f"$.{x.text}", "array<variant>"), lambda b: text_of(b, x.parts))
            text = F.coalesce(F.array_join(bits, ""), text_of(m, x.text))
        else:
            text = text_of(m, x.text)
        role = text_of(m, x.role)
        return F.struct((role if x.plain else plain_role(role)).alias("role"), text.alias("text"))

    listed = F.transform(items, turn)
    return listed if own is None else F.concat(own, listed)


def canonical_turns(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> tuple[Column, Column]:
    """(layout name, turns) of a variant record; both null if no mapping has its fingerprint."""
    mark = fingerprint(record, layouts)
    name = turns = None
    for x in layouts:
        hit = mark == F.xxhash64(F.lit("\n".join(sorted(x.paths))))
        got = _turns(record, x).cast(TURNS)
        name = F.when(hit, x.name) if name is None else name.when(hit, x.name)
        turns = F.when(hit, got) if turns is None else turns.when(hit, got)
    return name, turns


def plain_role(role: Column) -> Column:
    """The common name of a role; one without an alias stays."""
    out = role
    for alias, name in ROLE_ALIASES.items():
        out = F.when(F.lower(role) == alias, name).otherwise(out)
    return out


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(f"\\{control}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(turns: Column) -> Column:
    """One string of all turns."""
    def one(t: Column) -> Column:
        role = F.replace(escape(t["role"]), F.lit(":"), F.lit("\\:"))
        return F.concat(F.lit(OPEN), role, F.lit(":\n"), escape(t["text"]), F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Turns with the span (start, end: code points) of each text in ``formatted``."""
    head = rf"(?s)^{OPEN}((?:[^:\\]|\\.)*):\n"
    parts = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    heads = F.transform(parts, lambda p: F.struct(p.alias("p"), F.regexp_extract(p, head, 0).alias("h"), F.regexp_extract(p, head, 1).alias("r")))
    kind = "array<struct<role:string,text:string,start:int,end:int>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("turns"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["h"])
        end = acc["at"] + F.length(x["p"])
        body = F.substring(x["p"], F.length(x["h"]) + 1, F.length(x["p"]))
        turn = F.struct(unescape(x["r"]).alias("role"), body.alias("text"), start.alias("start"), end.alias("end"))
        return F.struct((end + len(CLOSE)).alias("at"), F.concat(acc["turns"], F.array(turn)).alias("turns"))

    return F.aggregate(heads, empty, step, lambda acc: acc["turns"])


def format_records(records: DataFrame, record_col: str, loss_roles: tuple[str, ...] = ("assistant",), layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with layout, formatted and loss_spans (array of start, end in code points).

    The loss covers turns whose role's common name is one of ``loss_roles``. A record that no mapping fits, or a null one, has null in all three;
    one without turns formats to an empty string. Null roles and texts count as empty.
    Columns of the three names are an error.
    """
    if taken := {"layout", "formatted", "loss_spans"} & {c.lower() for c in records.columns}:
        raise ValueError(f"columns {sorted(taken)} are taken")
    name, turns = canonical_turns(F.col(f"`{record_col}`"), layouts)
    out = records.withColumn("layout", name).withColumn("formatted", render(turns))
    spans = F.transform(F.filter(parse(F.col("formatted")), lambda t: plain_role(t["role"]).isin(*loss_roles)), lambda t: F.struct(t["start"], t["end"]))
    return out.withColumn("loss_spans", spans)


def from_json(records: DataFrame, json_col: str, **options) -> DataFrame:
    """format_records of a column of JSON documents of any of the layouts; bad JSON: nulls."""
    held = free_name(records, "record")
    return format_records(records.withColumn(held, F.try_parse_json(F.col(f"`{json_col}`"))), held, **options).drop(held)


def from_turn_rows(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One record of layout 'turns' for each conversation, in order of turn (null first),
    then role and text; equal rows all stay, a null id is a conversation of its own."""
    turn = F.struct(
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy(F.col(f"`{id_col}`").alias(id_col)).agg(F.array_sort(F.collect_list(turn)).alias("_t"))
    record = F.struct(F.transform("_t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return grouped.select(id_col, F.to_variant_object(record).alias("record"))


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what the formatted string and its loss spans say."""
    turns = parse(F.col("formatted"))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    read = formatted.withColumn("_turns", turns).withColumn("_loss", F.array_join(masked, ""))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), unescape(t["text"]), F.lit("\n"))), "")
    return read.select(
        id_col,
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "layout",
    )
