"""Chat formatting by columnar byte assembly.

Each turn becomes HEAD role SEP text END. Control strings inside roles and
texts, the template's own and those of other common templates, get a backslash
after their first character (one more where some are there already), which
reading takes away again: the mapping is one to one.

The formatted texts of a batch of whole conversations are laid out at once:
segment lengths, their cumulative sums as offsets, and scatter indices, all in
numpy, copy headers and contents into one Arrow buffer allocated beforehand.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import runs, small_batches, text_bytes

HEAD, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (HEAD, SEP, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_REST = "|".join(re.escape(x[1:]) for x in CONTROL)
_ESCAPE = r"([<\[])(\\*(?:" + _REST + "))"
_UNESCAPE = re.compile(r"([<\[])\\(\\*(?:" + _REST + "))")
FORMATTED = "conv_id long, n_turns long, formatted string, loss_starts array<long>, loss_lengths array<long>"


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, _ESCAPE, r"\1\\\2")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copies the pieces of data that offsets delimit to the places to in out."""
    out[runs(to, np.diff(offsets))] = data


def _assembled(rows: pa.Table) -> pa.RecordBatch:
    """The formatted conversations of rows, which are sorted and hold whole conversations."""
    ids = rows.column("conv_id").combine_chunks()
    n, known = len(ids), ids.is_valid().to_numpy(zero_copy_only=False)
    key = ids.fill_null(0).to_numpy(zero_copy_only=False)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (known[1:] != known[:-1])
    roles, contents = (text_bytes(escape(rows.column(c).combine_chunks())) for c in ("role", "text"))
    marks = [np.frombuffer(x.encode(), np.uint8) for x in (HEAD, SEP, END)]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0::2] = [len(m) for m in marks]
    lengths[:, 1], lengths[:, 3] = np.diff(roles[1]), np.diff(contents[1])
    ends = np.cumsum(lengths)
    starts = (ends - lengths.ravel()).reshape(n, 5)
    buffer = pa.allocate_buffer(int(ends[-1]))
    out = np.frombuffer(buffer, np.uint8)
    for mark, at in zip(marks, starts[:, 0::2].T, strict=True):
        out[at[:, None] + np.arange(len(mark))] = mark
    _scatter(out, starts[:, 1], *roles)
    _scatter(out, starts[:, 3], *contents)

    first = np.flatnonzero(new)
    at = np.append(starts[first, 0], ends[-1])
    formatted = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(at), buffer])
    spoken = np.flatnonzero(pc.equal(rows.column("role"), "assistant").combine_chunks().to_numpy(zero_copy_only=False))
    own = np.cumsum(new)[spoken] - 1
    cuts = pa.array(np.searchsorted(own, np.arange(len(first) + 1)), pa.int32())
    spans = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (starts[spoken, 3] - at[own], lengths[spoken, 3])]
    turns = np.diff(np.append(first, n))
    return pa.record_batch([ids.take(pa.array(first)), pa.array(turns), formatted.cast(pa.string()), *spans], ["conv_id", "n_turns", "formatted", "loss_starts", "loss_lengths"])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []  # rows of a conversation that may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_pylist()
        at = len(ids) - 1
        while at and ids[at - 1] == ids[-1]:
            at -= 1
        if held and held[0].column("conv_id")[0].as_py() != ids[0]:
            yield _assembled(pa.Table.from_batches(held))
            held = []
        if at:
            yield _assembled(pa.Table.from_batches([*held, batch.slice(0, at)]))
            held = []
        held.append(batch.slice(at))
    if held:
        yield _assembled(pa.Table.from_batches(held))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row for each conv_id: FORMATTED. loss_starts and loss_lengths are byte ranges of the assistant's texts.

    Rows go by turn, nulls first; rows that share a turn go by role, then text. Repeated rows all stay. A null
    conv_id is a conversation of its own; null roles and texts are empty. An empty table gives no rows. Other
    columns are ignored. A conversation is one value of the result, so it is put together in one task: its size,
    not the number of conversations, bounds a task's memory.
    """
    empty = F.lit("")
    rows = small_batches(turns).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(_format, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs that were formatted."""
    parts = (x[len(HEAD) :].split(SEP) for x in formatted.split(END)[:-1])
    return [(unescape(role), unescape(text)) for role, text in parts]


def under_loss(formatted: str, starts: list[int], lengths: list[int]) -> str:
    """The unescaped text under the loss mask."""
    data = formatted.encode()
    return "".join(unescape(data[a : a + n].decode()) for a, n in zip(starts, lengths, strict=True))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for batch in batches:
        out = []
        for conv_id, _, formatted, starts, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            turns, loss = parse(formatted), under_loss(formatted, starts, lengths)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            out.append((conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)


def digests(chats: DataFrame) -> DataFrame:
    """What formatted conversations hold, read back from them."""
    return chats.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
