"""Chat formatting: fingerprints of record layouts, declarative mappings, a reversible template.

A record is a JSON object.  The sorted set of its nested field paths, hashed, is its layout's
fingerprint; the fingerprint selects a mapping, and the mapping says which paths are turns.  Layouts are
data (:data:`MAPPINGS`): a new one is one more entry, no code.

Turns are rendered as ``<s>text</s>`` (assistant), ``[INST]text[/INST]`` (user), ``<<SYS>>text<</SYS>>``
(system) or ``[ROLE=name]text[/ROLE]``.  Where a text itself holds such a string, or one that was escaped,
one backslash goes behind its first character; taking one away gives the text back.  The loss mask is a
list of (start, end) code points of the assistant texts inside the formatted text.

A conversation may hold any number of turns: turns are dealt out by ranges of (conversation, turn), so a
large conversation is formatted by several tasks into chunks of at most about ``CHUNK`` characters.  Only
what is sequential by definition, a digest over a whole conversation, reads the chunks of one
conversation in one task, one chunk at a time.

Defined cases: null text and null role are empty; a record of an unknown layout gives one row with null
layout and no text (:func:`unmapped` lists them); a null record likewise; turns that repeat are all kept,
ties of the turn number ordered by role, then text; null conversation ids are one conversation; an empty
table gives no rows; extra top-level fields named in ``IGNORED`` don't change a layout.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, staged, table

CHUNK = 1 << 18

# Fields that say nothing about a layout, and role names of known layouts.
IGNORED = ("id", "source", "metadata", "lang", "timestamp")
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Mapping:
    """One layout: its field paths and where its turns are.

    ``each`` names a list of turns with the keys of role and text inside; ``turns`` lists fixed roles with
    the paths whose non-empty values, joined by a blank line, are the text; ``row`` names the columns of
    (turn number, role, text) of a layout with one turn per record.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None
    roles: dict = field(default_factory=dict)


MAPPINGS = [
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), row=("turn", "role", "text")),
    Mapping("messages", ("messages[].role", "messages[].content"), each=("messages", "role", "content")),
    Mapping("sharegpt", ("conversations[].from", "conversations[].value"), each=("conversations", "from", "value"), roles=ROLES),
    Mapping("prompt_completion", ("prompt", "completion"), (("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt_response", ("prompt", "response"), (("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question_answer", ("question", "answer"), (("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("instruction", ("instruction", "output"), (("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping(
        "instruction_input", ("instruction", "input", "output"), (("user", ("instruction", "input")), ("assistant", ("output",)))
    ),
    Mapping(
        "system_instruction", ("system", "instruction", "output"),
        (("system", ("system",)), ("user", ("instruction",)), ("assistant", ("output",))),
    ),
]


def paths_of(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; list elements share ``[]``."""
    if isinstance(value, dict) and value:
        return set().union(*(paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(paths_of(v, f"{at}[]") for v in value))
    return {at} if at else set()


def fingerprint(paths) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=16).hexdigest()


def _at(record: dict, path: str) -> str:
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record if isinstance(record, str) else "" if record is None else json.dumps(record)


def _turns(record: dict, m: Mapping) -> Iterator[tuple[int, str, str]]:
    if m.row:
        number, role, text = (record.get(k) for k in m.row)
        yield number, m.roles.get(role, role) or "", text or ""
    elif m.each:
        items, role, text = m.each
        for i, item in enumerate(record[items]):
            yield i, m.roles.get(item.get(role), item.get(role)) or "", _at(item, text)
    else:
        for i, (role, parts) in enumerate(m.turns):
            text = "\n\n".join(filter(None, (_at(record, p) for p in parts)))
            if text or role != "system":
                yield i, role, text


TURNS = "conv_id long, layout string, turn long, role string, text string"


def canonical_turns(records: DataFrame, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """``conv_id, record`` (JSON) to ``conv_id, layout, turn, role, text``, a row per turn."""
    known = {fingerprint(m.paths): m for m in mappings}

    def convert(batches):
        for batch in batches:
            out = []
            for conv, text in zip(batch["conv_id"].tolist(), batch["record"].tolist(), strict=True):
                conv = None if conv is None or conv != conv else int(conv)
                try:
                    record = json.loads(text) if text else {}
                except ValueError:
                    record = {}
                record = {k: v for k, v in record.items() if k not in IGNORED} if isinstance(record, dict) else {}
                m = known.get(fingerprint(paths_of(record)))
                if m is None:
                    out.append((conv, None, None, None, None))
                else:
                    out.extend((conv, m.name, *turn) for turn in _turns(record, m))
            yield pd.DataFrame(
                {name: pd.Series([row[i] for row in out], dtype="Int64" if i in (0, 2) else object)
                 for i, name in enumerate(("conv_id", "layout", "turn", "role", "text"))}
            )

    return records.select("conv_id", "record").mapInPandas(convert, TURNS)


def unmapped(turns: DataFrame) -> DataFrame:
    return turns.where(F.col("layout").isNull())


# The template.
MARKS = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE=", "[/ROLE]")

_TAIL = r"(?=/?s>|/?INST\]|</?SYS>>|ROLE=|/ROLE\])"
_PLAIN = re.compile(r"([<\[])(\\*)" + _TAIL)
_ESCAPED = re.compile(r"([<\[])(\\*)\\" + _TAIL)
_OPEN = re.compile(r"<s>|\[INST\]|<<SYS>>|\[ROLE=([^\]]*)\]")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends."""
    if role in MARKS:
        head, close = MARKS[role]
    else:
        name = "".join(f"%{ord(c):x};" if c in "]%" else c for c in role)
        head, close = f"{OTHER[0]}{name}]", OTHER[1]
    body = escape(text)
    return head + body + close, len(head), len(head) + len(body)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    while at < len(formatted):
        found = _OPEN.match(formatted, at)
        role = next((r for r, (head, _) in MARKS.items() if head == found[0]), None)
        if role is None:
            role = re.sub(r"%([0-9a-f]+);", lambda m: chr(int(m[1], 16)), found[1])
        close = MARKS[role][1] if found[1] is None else OTHER[1]
        end = formatted.index(close, found.end())
        yield role, unescape(formatted[found.end() : end])
        at = end + len(close)


FORMATTED = "conv_id long, slice long, chunk long, n_turns long, formatted string, loss array<array<long>>"


def formatted(turns: DataFrame) -> DataFrame:
    """Chunks of formatted conversations: ``conv_id, slice, chunk, n_turns, formatted, loss``.

    A conversation is its chunks in the order of (slice, chunk); ``loss`` counts from the chunk's start.
    """
    order = ["conv_id", "turn", "role", "text"]
    dealt = turns.where(F.col("layout").isNotNull()).select(*order)
    dealt = dealt.repartitionByRange(slices(turns.sparkSession), *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("slice", F.spark_partition_id().cast("long"))

    def chunks(batches):
        rows, held = [], 0
        conv, part, n, texts, spans, size, where = None, 0, 0, [], [], 0, 0
        began = False

        def frame():
            out = pd.DataFrame(rows, columns=["conv_id", "slice", "chunk", "n_turns", "formatted", "loss"])
            out["conv_id"] = pd.Series([r[0] for r in rows], dtype="Int64")
            return out

        for batch in batches:
            keys = batch["conv_id"].astype("Int64").tolist()
            for c, role, text, s in zip(keys, batch["role"].tolist(), batch["text"].tolist(), batch["slice"].tolist(), strict=True):
                c = None if c is pd.NA else c
                if began and (c != conv or size >= CHUNK):
                    rows.append((conv, where, part, n, "".join(texts), spans))
                    held += size
                    part, n, texts, spans, size = part + 1, 0, [], [], 0
                    if held >= 8 * CHUNK:
                        yield frame()
                        rows, held = [], 0
                conv, where, began = c, s, True
                piece, start, end = render(role, text)
                if role == "assistant":
                    spans.append([size + start, size + end])
                texts.append(piece)
                size, n = size + len(piece), n + 1
        if began:
            rows.append((conv, where, part, n, "".join(texts), spans))
            yield frame()

    return dealt.mapInPandas(chunks, FORMATTED)


READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(chunks: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted text and loss mask alone."""
    placed = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "chunk")

    def digests(batches):
        began, conv, rows = False, None, []
        for batch in batches:
            for c, text, loss in zip(batch["conv_id"].astype("Int64").tolist(), batch["formatted"].tolist(), batch["loss"].tolist(), strict=True):
                c = None if c is pd.NA else c
                if not began or c != conv:
                    if began:
                        rows.append((conv, n, turns.hexdigest(), chars, masked.hexdigest(), size))
                    began, conv, n, chars, size, turns, masked = True, c, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for start, end in loss:
                    said = unescape(text[start:end])
                    masked.update(said.encode())
                    chars += len(said)
                size += len(text)
            if rows:
                yield _frame(rows)
                rows = []
        if began:
            yield _frame([(conv, n, turns.hexdigest(), chars, masked.hexdigest(), size)])

    return placed.mapInPandas(digests, READ_BACK)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [part.split()[0] for part in READ_BACK.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    out["conv_id"] = pd.Series([r[0] for r in rows], dtype="Int64")
    return out


CONTROL_CASE = "</s>[INST] ok [/INST]"


def op9_chat_format(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    case = [(-1, 0, "user", CONTROL_CASE), (-1, 1, "assistant", CONTROL_CASE)]
    rows = rows.unionByName(spark.createDataFrame(case, "conv_id long, turn long, role string, text string"))
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"})
    turns = canonical_turns(rows.select("conv_id", record.alias("record")))
    return read_back(staged(formatted(turns), "formatted"))


#: the formatted length in SQL: marks of each turn plus its text plus one backslash per escaped place
ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, CASE role WHEN 'assistant' THEN 7 WHEN 'user' THEN 13 WHEN 'system' THEN 15 ELSE 14 + length(role) END + length(text)
    + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\]|</?SYS>>|ROLE=|/ROLE\])')) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
