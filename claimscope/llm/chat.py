"""Chat formatting: schema fingerprints choose declarative mappings, canonical turns go into a reversible template."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

# Marks of the template, and other strings that models read as control.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = [START, MIDDLE, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_control_start = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)
_escaped = re.compile(r"\\(.)", re.S)
_turn = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END) + "\n", re.S)


@dataclass(frozen=True)
class Layout:
    """How records of one shape become turns. Either ``turns`` names a list of objects with ``role`` and ``text`` fields,
    or ``steps`` names the role and the fields of each turn; fields of one turn are joined by an empty line."""

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    steps: Sequence[tuple[str, Sequence[str]]] = ()
    optional: frozenset[str] = frozenset()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> frozenset[str]:
        """Nested field paths that a record of this layout has at least."""
        if self.turns:
            return frozenset({self.turns, f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"})
        return frozenset(p for _, ps in self.steps for p in ps if p not in self.optional)

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.turns:
            rows = [t for t in record.get(self.turns) or [] if isinstance(t, dict)]
            return [(self.roles.get(t.get(self.role), t.get(self.role)) or "", _plain(t.get(self.text))) for t in rows]
        out = []
        for role, fields in self.steps:
            parts = [_plain(record.get(f)) for f in fields if f in record]
            parts = [p for p in parts if p] if len(parts) > 1 else parts
            if parts or not self.optional.issuperset(fields):
                out.append((role, "\n\n".join(parts)))
        return out


def _plain(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False, sort_keys=True)


# Layouts in wide use.
LAYOUTS = (
    Layout("messages", "messages", "role", "content"),
    Layout("conversations", "conversations", "from", "value", roles={"human": "user", "gpt": "assistant", "bing": "assistant", "chatgpt": "assistant"}),
    Layout("dialogue", "dialogue", "role", "text"),
    Layout("instruction", steps=(("system", ["system"]), ("user", ["instruction", "input"]), ("assistant", ["output"])), optional=frozenset({"system", "input"})),
    Layout("prompt-response", steps=(("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])), optional=frozenset({"system"})),
    Layout("prompt-completion", steps=(("system", ["system"]), ("user", ["prompt"]), ("assistant", ["completion"])), optional=frozenset({"system"})),
    Layout("question-answer", steps=(("system", ["system"]), ("user", ["question"]), ("assistant", ["answer"])), optional=frozenset({"system"})),
)


def field_paths(value: object, at: str = "") -> set[str]:
    """Nested field paths of a record; the elements of a list share ``[]``."""
    if isinstance(value, dict):
        out = set()
        for k, v in value.items():
            path = f"{at}.{k}" if at else k
            out |= {path} | field_paths(v, path)
        return out
    if isinstance(value, list):
        return set().union(*[field_paths(v, f"{at}[]") for v in value]) if value else set()
    return set()


def fingerprint(paths: set[str] | frozenset[str]) -> int:
    """63-bit hash of the sorted paths: records of one shape have one fingerprint."""
    return xxhash.xxh3_64_intdigest("\n".join(sorted(paths)).encode()) >> 1


class Mappings:
    """Chooses a layout by fingerprint: registered ones at once; a new one is matched once, with the layout most of
    whose fields it has, and remembered."""

    def __init__(self, layouts: Sequence[Layout]):
        self.layouts = sorted(layouts, key=lambda x: (-len(x.paths()), x.name))
        self.known: dict[int, Layout | None] = {fingerprint(x.paths()): x for x in layouts}

    def of(self, paths: set[str]) -> tuple[int, Layout | None]:
        mark = fingerprint(paths)
        if mark not in self.known:
            if len(self.known) > 100_000:
                self.__init__(self.layouts)
            self.known[mark] = next((x for x in self.layouts if x.paths() <= paths), None)
        return mark, self.known[mark]


def escape(text: str) -> str:
    """Doubles backslashes and puts one into every control string, so none is left; ``unescape`` undoes it."""
    return _control_start.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def render(turns: Sequence[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the code point spans of it that are trained on: each assistant's text."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + MIDDLE, escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        out.append(head + body + END + "\n")
        at += len(out[-1])
    return "".join(out), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _turn.findall(formatted)]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def format_records(records: DataFrame, id_col: str = "conv_id", json_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """id, ``fingerprint``, ``layout``, ``turns``, ``formatted``, ``loss_mask`` of JSON records of any mixture of layouts.

    The hash of a record's nested field paths selects the mapping that turns it into (role, text) turns. Records that
    no layout fits, that are null or are no JSON objects come back with a null layout and no turns. Null texts and
    roles are empty; a record may have no turns at all. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mappings = Mappings(layouts)
        for batch in batches:
            rows: list[tuple] = []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    record = json.loads(raw.as_py() or "null")
                except ValueError:
                    record = None
                mark, layout = mappings.of(field_paths(record)) if isinstance(record, dict) else (None, None)
                turns = layout.read(record) if layout else []
                text, mask = render(turns)
                rows.append((key, mark, layout and layout.name, [{"role": r, "text": t} for r, t in turns], text, [{"start": a, "end": b} for a, b in mask]))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), _TURNS, pa.string(), _SPANS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["id", "fingerprint", "layout", "turns", "formatted", "loss_mask"])

    rows = records.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{json_col}`").alias("record"))
    out = rows.mapInArrow(run, "id long, fingerprint long, layout string, turns array<struct<role: string, text: string>>, formatted string, "
                               "loss_mask array<struct<start: long, end: long>>")
    return out.withColumnRenamed("id", id_col)


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted text and its mask hold: id, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, text, mask in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                turns = parse(text)
                trained = "".join(unescape(text[m["start"]:m["end"]]) for m in mask)
                listed = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((key, len(turns), hashlib.sha256(listed.encode()).hexdigest(), len(trained),
                             hashlib.sha256(trained.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    rows = formatted.select(F.col(f"`{id_col}`").alias("id"), "formatted", "loss_mask")
    out = rows.mapInArrow(run, "id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumnRenamed("id", id_col)


def records_of(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """id and ``record`` (JSON with a list of turns) of a table with a row for each turn. Turns go by number, then role and
    text; null roles and texts are empty, null numbers come first. A conversation is one record, so it is one group."""
    blank = F.lit("")
    rows = turns.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), blank).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), blank).alias("text")).alias("t"))
    listed = rows.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("dialogue"))
    record = F.to_json(F.struct(F.transform("dialogue", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("dialogue")))
    return listed.select(F.col("id").alias(id_col), record.alias("record"))
