"""Chat formatting by schema fingerprints (operator 8).

A record is JSON of any known layout.  The hash of its nested field paths selects a declarative mapping, which says where
its turns are; so prompt and completion, instruction and output, or lists of messages all become turns of (role, text).

A turn is formatted as a segment: a mark, the role, a line end, the text, a mark.  The formatted conversation is its
segments in order; it may be of any length, so it is kept one segment a row.  Control strings inside texts and roles get a
backslash after their first character, and those that already have some get one more, which is undone by taking one away.
The loss mask covers what the assistant says.
"""

import hashlib
import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from deskflow.llm.common import per_text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Control strings of common chat templates.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
            "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<unk>", "<pad>")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

_INSIDE = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
_FIRST = "".join(sorted({re.escape(c[0]) for c in CONTROLS}))
_ADD = re.compile(rf"([{_FIRST}])(\\*)(?=(?:{_INSIDE}))")
_TAKE = re.compile(rf"([{_FIRST}])\\(\\*)(?=(?:{_INSIDE}))")


def escape(text: str) -> str:
    return _ADD.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _TAKE.sub(r"\1\2", text)


def _role_out(role: str) -> str:
    """A role on one line."""
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _role_in(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    ``each`` names a list whose elements have ``role`` and ``text``; without it ``turns`` lists pairs of a role (a fixed one,
    or ``@field``) and the fields whose non-empty texts make up the turn.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    before: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict = field(default_factory=dict, hash=False)


SHARED_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS = (
    Layout("turn", ("role", "text"), turns=(("@role", ("text",)),)),
    Layout("prompt", ("prompt", "completion"), turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question", ("question", "answer"), turns=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout("instruction", ("instruction", "input", "output"),
           turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("instruction_short", ("instruction", "output"), turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_system", ("system", "instruction", "input", "output"),
           turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("messages", ("messages", "messages[].role", "messages[].content"), each="messages", role="role", text="content"),
    Layout("messages_system", ("system", "messages", "messages[].role", "messages[].content"), each="messages", role="role",
           text="content", before=(("system", ("system",)),)),
    Layout("shared", ("conversations", "conversations[].from", "conversations[].value"), each="conversations", role="from",
           text="value", roles=SHARED_ROLES),
    Layout("nested", ("data", "data.prompt", "data.reply"), turns=(("user", ("data.prompt",)), ("assistant", ("data.reply",)))),
)


def paths_of(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; elements of a list share one path."""
    out: set[str] = set()
    if isinstance(value, dict):
        for k, v in value.items():
            path = f"{at}.{k}" if at else k
            out.add(path)
            out |= paths_of(v, path)
    elif isinstance(value, list):
        for v in value:
            out |= paths_of(v, f"{at}[]")
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def turns_of(record, layout: Layout) -> list[dict]:
    def one(source, path):
        for part in path.split("."):
            source = (source or {}).get(part)
        return "" if source is None else source if isinstance(source, str) else json.dumps(source)

    def listed(pairs):
        for role, fields in pairs:
            name = one(record, role[1:]) if role.startswith("@") else role
            yield {"role": name, "text": "\n\n".join(t for i, f in enumerate(fields) if (t := one(record, f)) or i == 0)}

    if not layout.each:
        return list(listed(layout.turns))
    out = [t for t in listed(layout.before) if t["text"]]
    for m in record[layout.each] or []:
        role = one(m, layout.role)
        out.append({"role": layout.roles.get(role, role), "text": one(m, layout.text)})
    return out


def _canonical(layouts):
    by_print = {fingerprint(x.paths): x for x in layouts}
    for x in layouts:
        if x.each:  # an empty list has no paths inside
            by_print[fingerprint(p for p in x.paths if "[]" not in p)] = x

    def one(text):
        try:
            record = json.loads(text) if text is not None else None
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return None, None, None
        known = fingerprint(paths_of(record))
        layout = by_print.get(known)
        return known, layout and layout.name, layout and turns_of(record, layout)

    def work(texts):
        got = [one(t) for t in texts]
        return {"fingerprint": [g[0] for g in got], "layout": [g[1] for g in got], "turns": [g[2] for g in got]}

    return work


def canonical(record: Column, layouts=LAYOUTS) -> Column:
    """Struct (fingerprint, layout, turns) of a column of JSON records.

    Turns are null for a layout that no mapping knows, and all is null for a null or for text that is no JSON object.
    """
    return per_text(lambda: _canonical(layouts), "fingerprint string, layout string, turns array<struct<role:string,text:string>>",
                    record)


def _segments(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    fields = [pa.field("segment", pa.string()), pa.field("loss_from", pa.int64()), pa.field("loss_to", pa.int64())]
    for roles, texts in batches:
        out: list[list] = [[], [], []]
        for role, text in zip(roles.to_pylist(), texts.to_pylist()):
            head, body = f"{OPEN}{_role_out(role or '')}\n", escape(text or "")
            spoken = role == "assistant"
            out[0].append(head + body + CLOSE)
            out[1].append(len(head) if spoken else 0)
            out[2].append(len(head) + len(body) if spoken else 0)
        yield pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(out, fields)], fields=fields)


def formatted(turns: DataFrame) -> DataFrame:
    """(conv, seq, segment, loss_from, loss_to) from (conv, seq, role, text): what the loss mask covers lies between the
    two characters of the segment, nothing when they are equal.  Null roles and texts are empty."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return _segments(batches)

    made = F.arrow_udf(run, "segment string, loss_from long, loss_to long")("role", "text")
    return turns.select("conv", "seq", made.alias("x")).select("conv", "seq", "x.segment", "x.loss_from", "x.loss_to")


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    head, _, body = segment.removeprefix(OPEN).partition("\n")
    return _role_in(head), unescape(body.removesuffix(CLOSE))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their segments in order; a conversation passes through, it is never held."""
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    rows: list[tuple] = []
    now, state = None, None

    def close():
        if state is not None:
            rows.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for batch in batches:
        for conv, segment, low, high in zip(*[c.to_pylist() for c in batch.columns]):
            if state is None or conv != now:
                close()
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_segment(segment)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            spoken = unescape(segment[low:high])
            state[2] += len(spoken)
            state[3].update(spoken.encode())
            state[4] += len(segment)
        if len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            rows = []
    close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_back(segments: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation.

    Segments of one conversation come in order of ``seq`` (equal ones by segment).  A digest of a whole conversation is taken
    from first to last, so each passes through one task, a batch at a time.
    """
    ordered = segments.select("conv", "seq", "segment", "loss_from", "loss_to").repartition("conv").sortWithinPartitions(
        "conv", "seq", "segment").select("conv", "segment", "loss_from", "loss_to")
    return ordered.mapInArrow(_read, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                     "formatted_chars long")


def turns_of_records(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """(conv, seq, at, role, text) of the turns of (conv, seq, record), ``at`` counting those of a record.

    A record that no mapping knows, or that is no JSON object, is not dropped in silence: it ends the job with its
    fingerprint.  ``layout_counts`` tells beforehand what there is.
    """
    known = records.select("conv", "seq", canonical(F.col("record"), layouts).alias("c"))
    unknown = F.concat(F.lit("no mapping for records with fingerprint "), F.coalesce("c.fingerprint", F.lit("(none)")))
    kind = "array<struct<role:string,text:string>>"
    turns = F.coalesce("c.turns", F.raise_error(unknown).cast(kind))
    return known.select("conv", "seq", F.posexplode(turns).alias("at", "t")).select("conv", "seq", "at", "t.role", "t.text")


def layout_counts(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """(fingerprint, layout, n) of the column ``record``; the layout is null where no mapping is known."""
    return records.select(canonical(F.col("record"), layouts).alias("c")).groupBy(
        "c.fingerprint", "c.layout").agg(F.count("*").alias("n"))


def records_from_rows(rows: DataFrame, conv_col: str = "conv_id", seq_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """(conv, seq, record) of a table of one turn a row, in several layouts by conversation.

    A third each: a flat turn, a list of messages, a list with the roles of shared conversations.  The last has names of its
    own for two roles only; a turn of another role is a list of messages there too.
    """
    role, text = (F.col(f"`{c}`").cast("string") for c in (role_col, text_col))
    conv = F.col(f"`{conv_col}`").cast("long")

    def json_of(value):
        return F.to_json(value, {"ignoreNullFields": "false"})

    flat = json_of(F.struct(role.alias("role"), text.alias("text")))
    messages = json_of(F.struct(F.array(F.struct(role.alias("role"), text.alias("content"))).alias("messages")))
    speaker = F.when(role == "user", F.lit("human")).when(role == "assistant", F.lit("gpt"))
    shared = json_of(F.struct(F.array(F.struct(speaker.alias("from"), text.alias("value"))).alias("conversations")))
    kind = F.pmod(conv, F.lit(3))
    record = F.when(kind == 1, messages).when((kind == 2) & speaker.isNotNull(), shared).when(kind == 2, messages).otherwise(flat)
    return rows.select(conv.alias("conv"), F.col(f"`{seq_col}`").cast("long").alias("seq"), record.alias("record"))


def turns_from_rows(rows: DataFrame, conv_col: str = "conv_id", seq_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """(conv, seq, role, text) from a table of one turn a row, by way of records and their fingerprints.  A table without rows
    gives none."""
    return turns_of_records(records_from_rows(rows, conv_col, seq_col, role_col, text_col)).drop("at")
