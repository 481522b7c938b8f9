"""Chat formatting by schema fingerprint; DataFrame functions only.

Every record becomes a variant. The nested field paths that the mapping catalogue
knows and the record has are hashed to its fingerprint, and the fingerprint selects
the declarative mapping that turns the record into canonical turns. Turns of one
conversation are then written between control marks, control strings inside texts
are escaped reversibly, and spans of code points mark the texts under the loss.

Defined results:

* a null role or text is empty; a record without a conversation id is a conversation of its own;
* a record whose fingerprint no mapping has keeps its row, with no turn and a null ``layout``;
* turns are ordered by turn number (null first), then role, then text; repeated rows are repeated turns;
* columns no mapping names are ignored, whatever they are called; an empty table gives an empty table.

A conversation becomes one text, so the turns of one conversation meet in one task.
Conversations are rows of the output; there is no smaller unit.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURNS = "array<struct<turn: bigint, role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    Either ``items`` names a list of messages with ``role`` and ``text`` fields
    (an empty ``items`` makes the record itself the one message, numbered by the
    field ``turn``), or ``parts`` lists turns as (role, paths); the non-empty
    texts of a turn's paths are joined by a blank line.
    """

    name: str
    items: str | None = None
    role: str = ""
    text: str = ""
    turn: str = ""
    roles: tuple[tuple[str, str], ...] = ()
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def paths(self) -> list[str]:
        if self.items:
            return [f"$.{self.items}", f"$.{self.items}[0].{self.role}", f"$.{self.items}[0].{self.text}"]
        if self.items == "":
            return [f"$.{self.role}", f"$.{self.text}", f"$.{self.turn}"]
        return [f"$.{p}" for _, paths in self.parts for p in paths]


SPOKEN = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))

MAPPINGS = (
    Mapping("turn_rows", items="", role="role", text="text", turn="turn"),
    Mapping("messages", items="messages", role="role", text="content"),
    Mapping("conversations", items="conversations", role="from", text="value", roles=SPOKEN),
    Mapping("nested_messages", items="prompt.messages", role="role", text="content"),
    Mapping("instruction_input", parts=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("instruction", parts=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("system_prompt", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt_response", parts=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt_completion", parts=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("question_answer", parts=(("user", ("question",)), ("assistant", ("answer",)))),
)


@dataclass(frozen=True)
class Template:
    """Marks around turns, and further strings a trainer would read as control."""

    start: str = "<|start|>"
    body: str = "<|body|>"
    end: str = "<|end|>"
    reserved: tuple[str, ...] = field(
        default=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    )
    learned_role: str = "assistant"

    def control(self) -> list[str]:
        return [self.start, self.body, self.end, *self.reserved]


TEMPLATE = Template()


def digest_of(paths: list[str]) -> str:
    return hashlib.md5("\n".join(sorted(set(paths))).encode()).hexdigest()


def known_paths(mappings=MAPPINGS) -> list[str]:
    return sorted({p for m in mappings for p in m.paths()})


def fingerprint(record: Column, mappings=MAPPINGS) -> Column:
    """Hash of the known field paths that ``record`` (a variant) has."""
    known = F.array(*[F.lit(p) for p in known_paths(mappings)])
    present = F.filter(known, lambda p: F.variant_get(record, p, "variant").isNotNull())
    return F.md5(F.array_join(present, "\n"))


def catalogue(spark: SparkSession, mappings=MAPPINGS) -> DataFrame:
    """The mappings as rows, by fingerprint; a list without items shows none of its fields and has its own."""
    rules = []
    for m in mappings:
        items = None if m.items is None else f"$.{m.items}" if m.items else "$"
        parts = [F.struct(F.lit(r).alias("role"), F.array(*[F.lit(f"$.{p}") for p in paths]).alias("paths")) for r, paths in m.parts]
        columns = {
            "layout": F.lit(m.name),
            "items": F.lit(items).cast("string"),
            "role_path": F.lit(f"$.{m.role}"),
            "text_path": F.lit(f"$.{m.text}"),
            "turn_path": F.lit(f"$.{m.turn}" if m.turn else None).cast("string"),
            "roles": F.create_map(*[F.lit(x) for pair in m.roles for x in pair]).cast("map<string, string>"),
            "parts": F.array(*parts).cast("array<struct<role: string, paths: array<string>>>"),
        }
        for paths in [m.paths(), m.paths()[:1]] if m.items else [m.paths()]:
            # Whoever has a path has the known ones it leads through.
            paths = [k for k in known_paths(mappings) if any(p == k or p.startswith((f"{k}.", f"{k}[")) for p in paths)]
            rules.append(F.struct(F.lit(digest_of(paths)).alias("known"), *[c.alias(n) for n, c in columns.items()]))
    return spark.range(1).select(F.inline(F.array(*rules)))


def _text(record: Column, path: Column) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def _turns() -> Column:
    """The turns of ``record`` by the mapping beside it."""
    record, items = F.col("record"), F.col("items")
    listed = F.when(items == "$", F.array(record)).otherwise(F.try_variant_get(record, items, "array<variant>"))

    def message(x: Column, i: Column) -> Column:
        role = _text(x, F.col("role_path"))
        numbered = F.when(F.col("turn_path").isNull(), i.cast("bigint")).otherwise(
            F.try_variant_get(x, F.col("turn_path"), "bigint")
        )
        return F.struct(
            numbered.alias("turn"),
            F.coalesce(F.try_element_at("roles", role), role).alias("role"),
            _text(x, F.col("text_path")).alias("text"),
        )

    def part(p: Column, i: Column) -> Column:
        texts = F.filter(F.transform(p.paths, lambda q: _text(record, q)), lambda t: t != "")
        return F.struct(i.cast("bigint").alias("turn"), p.role.alias("role"), F.array_join(texts, "\n\n").alias("text"))

    return F.when(items.isNotNull(), F.transform(listed, message)).otherwise(F.transform("parts", part))


def canonical_turns(records: DataFrame, key: str, json: str | None = None, mappings=MAPPINGS) -> DataFrame:
    """``conv_id, fingerprint, layout, turns``, one row per record.

    Records are the rows of ``records``, or the JSON texts of its column ``json``
    (a text that is no JSON has no known path).
    """
    if json:
        record = F.try_parse_json(F.col(json))
    else:
        tops = {re.split(r"[.\[]", p[2:])[0] for p in known_paths(mappings)}
        own = [F.col(f"`{c}`") for c in records.columns if c in tops]
        record = F.to_variant_object(F.struct(*own)) if own else F.parse_json(F.lit("{}"))
    found = records.select(F.col(f"`{key}`").alias("conv_id"), record.alias("record"))
    found = found.withColumn("fingerprint", fingerprint(F.col("record"), mappings))
    rules = F.broadcast(catalogue(records.sparkSession, mappings))  # a row or two for each mapping
    found = found.join(rules, found.fingerprint == rules.known, "left")
    turns = F.coalesce(_turns().cast(TURNS), F.array().cast(TURNS))
    return found.select("conv_id", "fingerprint", "layout", turns.alias("turns"))


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    """Double the backslashes, then part every control string after its first character."""
    tails: dict[str, list[str]] = {}
    for s in template.control():
        tails.setdefault(s[0], []).append(s[1:])
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for head, rest in tails.items():
        either = "|".join(re.escape(r) for r in rest)
        text = F.regexp_replace(text, f"{re.escape(head)}(?={either})", f"{head}\\\\")
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(canonical: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """``conv_id, formatted, loss_spans``: one text per conversation; spans are [start, end) in code points."""
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    turns = canonical.withColumn("alone", alone).select("conv_id", "alone", F.explode_outer("turns").alias("t"))
    head = F.concat(F.lit(template.start), escape(F.col("t.role"), template), F.lit(template.body))
    body = escape(F.col("t.text"), template)
    pieces = turns.select(
        "conv_id",
        "alone",
        F.col("t.turn").alias("turn"),
        F.col("t.role").alias("role"),
        F.col("t.text").alias("text"),
        head.alias("head"),
        body.alias("body"),
    ).withColumns({"head_chars": F.length("head"), "body_chars": F.length("body")})
    whole = F.col("head_chars").cast("bigint") + F.col("body_chars") + F.lit(len(template.end) + 1)
    conversation = W.partitionBy("conv_id", "alone")
    ordered = conversation.orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = pieces.withColumn("stop", F.sum(whole).over(ordered))
    stop = F.col("stop") - F.lit(len(template.end) + 1)
    placed = placed.select(
        "conv_id",
        "alone",
        F.when(
            F.col("head").isNotNull(),
            F.struct(
                (stop - F.col("body_chars")).alias("start"),
                stop.alias("end"),
                F.concat("head", "body", F.lit(template.end + "\n")).alias("piece"),
                (F.col("role") == template.learned_role).alias("learned"),
            ),
        ).alias("p"),
    )
    grouped = placed.groupBy("conv_id", "alone").agg(F.array_sort(F.collect_list("p")).alias("p"))
    spans = F.transform(F.filter("p", lambda x: x.learned), lambda x: F.struct(x.start.alias("start"), x.end.alias("end")))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("p", lambda x: x.piece), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Parse formatted texts again: adds ``turns`` (role, text) and ``loss_text``, both unescaped."""
    parts = F.split(F.col("formatted"), re.escape(template.end) + "\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)
    start = len(template.start)

    def turn(x: Column) -> Column:
        at = F.instr(x, template.body)
        role = F.substr(x, F.lit(start + 1), at - F.lit(start + 1))
        return F.struct(unescape(role).alias("role"), unescape(F.substr(x, at + F.lit(len(template.body)))).alias("text"))

    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr(F.col("formatted"), (s.start + 1).cast("int"), (s.end - s.start).cast("int"))),
    )
    return formatted.withColumns({"turns": F.transform(parts, turn), "loss_text": F.array_join(masked, "")})


def format_chats(records: DataFrame, key: str, json: str | None = None, mappings=MAPPINGS, template: Template = TEMPLATE) -> DataFrame:
    """Records of any known layout to formatted conversations with loss spans."""
    return format_conversations(canonical_turns(records, key, json, mappings), template)
