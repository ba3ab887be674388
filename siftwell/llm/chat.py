"""Chat formatting by columnar byte assembly, and reading it back.

Turns of a partition, in order, become one byte buffer: segment lengths, their
cumulative offsets and the scatter indices of headers, contents and footers are
computed in numpy, and the bytes copied into a preallocated Arrow buffer.

A user's turn is ``<s>[INST] text [/INST]``, an assistant's `` text </s>``, any
other role's ``[ROLE] role\\ntext [/ROLE]``. In texts and roles a backslash is
doubled, and where a control string starts, a backslash is put after its first
character; so none is left, and taking the backslashes out gives the text back.
A newline in a role is ``\\n``, so that the first newline ends the role.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

# fixed values: the control strings of the template
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_ANY = "|".join(re.escape(x) for x in CONTROL)
_ESCAPE = re.compile(rf"\\|[<\[](?={'|'.join(re.escape(x[1:]) for x in CONTROL)})|<(?=s>|/s>)")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]| (.*?) </s>|\[ROLE\] (.*?)\n(.*?) \[/ROLE\]", re.S)
#: Formatted bytes of a part, about; a long conversation has several parts.
PART = 1 << 20
SCHEMA = "conv_id long, part long, n_turns long, formatted string, loss array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], role) if "\\" in role else role


def _escaped(column: pa.Array, pattern: str = r"\\|" + _ANY, how: Callable[[str], str] = escape) -> pa.Array:
    """The column as large_string with control strings escaped; most texts hold none."""
    column = shared.text_column(column)
    odd = pc.match_substring_regex(column, pattern)
    if not pc.any(odd).as_py():
        return column
    return pc.replace_with_mask(column, odd, pa.array([how(x) for x in column.filter(odd).to_pylist()], pa.large_string()))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a large_string column; starts and lengths of its values."""
    offs = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs[:-1], np.diff(offs)


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns formatted, one after another, in one buffer; where each ends; start and length of its bytes under the loss."""
    n = len(text)
    role, text = _escaped(role, r"\\|\n|" + _ANY, escape_role), _escaped(text)
    user, assistant = (np.array(pc.equal(role, x)) if n else np.zeros(0, bool) for x in ("user", "assistant"))
    kind = np.where(user, 0, np.where(assistant, 1, 2))
    frame = [(b"<s>[INST] ", b" [/INST]"), (b" ", b" </s>"), (b"[ROLE] ", b" [/ROLE]")]
    role_raw, role_at, role_len = _bytes(role)
    raw, at, size = _bytes(text)
    head = np.array([len(x) for x, _ in frame])[kind]
    name = np.where(kind == 2, role_len + 1, 0)  # the role and a newline
    foot = np.array([len(x) for _, x in frame])[kind]
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(head + name + size + foot, out=ends[1:])
    out = np.empty(ends[-1], np.uint8)
    begin = ends[:-1]

    def scatter(to: np.ndarray, source: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(to, length) + step] = source[np.repeat(start, length) + step]

    for k, (a, b) in enumerate(frame):
        mine = kind == k
        for piece, to in ((a, begin), (b, ends[1:] - len(b))):
            rows = to[mine]
            scatter(rows, np.frombuffer(piece, np.uint8), np.zeros(len(rows), np.int64), np.full(len(rows), len(piece)))
    other = kind == 2
    if other.any():
        scatter((begin + head)[other], role_raw, role_at[other], role_len[other])
        out[(begin + head + name - 1)[other]] = 10
    body = begin + head + name
    scatter(body, raw, at, size)
    return out, ends, body, np.where(kind == 1, size, 0)


#: Characters of role and text that tell ranges apart.
START = 32


def format_turns(turns: DataFrame) -> DataFrame:
    """SCHEMA: the formatted conversations, in parts that follow one another.

    Turns are ordered by turn, then role and text; a conversation's parts, in
    order, joined, are its text, so one with very many turns is split over
    tasks. loss holds the byte spans of assistants' texts. Null texts and roles
    are empty; rows with a null conv_id form one conversation; null turns come
    first; repeated rows are each a turn. Other columns are ignored.
    """
    ordered = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    # ranges are drawn over short beginnings, in the same order: whole texts would go to the driver and into every task
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    long_role = F.length(role) > START
    start = [F.left(role, F.lit(START)), long_role, F.when(long_role, "").otherwise(F.left(text, F.lit(START)))]
    ordered = ordered.repartitionByRange("conv_id", "turn", *start).sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            out, ends, body, loss = assemble(b.column(2), b.column(3))
            conv, n = b.column(0), b.num_rows
            value, there = np.array(conv.fill_null(0)), np.array(conv.is_valid())
            change = np.flatnonzero((value[1:] != value[:-1]) | (there[1:] != there[:-1])) + 1
            # a part goes on to the end of its conversation, or to the turn that fills it
            cut, stops = [0], iter([*change.tolist(), n] if n else [])
            stop = next(stops, 0)
            while cut[-1] < n:
                if cut[-1] == stop:
                    stop = next(stops)
                cut.append(min(stop, max(int(np.searchsorted(ends, ends[cut[-1]] + PART)), cut[-1] + 1)))
            first, parts = np.array(cut[:-1], np.int64), len(cut) - 1
            # the parts are ranges of the buffer that was assembled, and the loss spans count from a part's start
            formatted = pa.Array.from_buffers(pa.large_string(), parts, [None, pa.py_buffer(ends[cut].copy()), pa.py_buffer(out)]).cast(pa.string())
            said = np.flatnonzero(loss > 0)
            of = np.searchsorted(first, said, side="right") - 1
            start = body[said] - ends[first][of]
            spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array((start + loss[said]).astype(np.int32))], ["start", "end"])
            offsets = np.searchsorted(of, np.arange(parts + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [conv.take(pa.array(first)), pa.array(number + np.arange(parts)), pa.array(np.diff(cut).astype(np.int64)), formatted, pa.ListArray.from_arrays(pa.array(offsets), spans)],
                names=["conv_id", "part", "n_turns", "formatted", "loss"],
            )
            number += parts

    return ordered.mapInArrow(shared.tidy(run), SCHEMA)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted string."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        user, assistant, role, text = m.groups()
        yield ("user", unescape(user)) if user is not None else ("assistant", unescape(assistant)) if assistant is not None else (unescape_role(role), unescape(text))


def read_back(parts: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, from its formatted parts alone.

    A digest runs over a whole conversation in order, so its parts meet in one
    task; they stream through it, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def done() -> tuple:
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

        for b in batches:
            rows = []
            for conv, _, _, formatted, loss in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if state is None or conv != state[0]:
                    if state is not None:
                        rows.append(done())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                data = formatted.encode()
                for span in loss:
                    text = unescape(data[span["start"] : span["end"]].decode())
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
            yield _digests(rows)
        if state is not None:
            yield _digests([done()])

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(shared.tidy(run), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = shared.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return read_back(format_turns(turns.unionByName(extra)))
