r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, only that reply trainable. What a
conversation has after its last reply (or all of it, if there is none) comes as one more example without a target, so
that nothing of the table is missing from the output.

A turn is written `<|im_start|>role\ntext<|im_end|>\n`. Control strings of this and other templates inside a text are
broken up by `\-` after their first character and backslashes are doubled, which reading undoes.

Rows are sorted by conversation and turn within partitions and run through as a stream; a task holds one written
conversation at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Fixed strings that chat templates take as control marks.
CONTROL = (BEGIN, END, "<|endoftext|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
MARKS = re.compile("|".join(re.escape(c) for c in CONTROL))
ESCAPED = re.compile(r"\\([\\n-])")
TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
TRAINED = "assistant"
#: Characters of examples that a task gathers before it hands them on.
FLUSH = 4 << 20


def escape(text: str) -> str:
    return MARKS.sub(lambda m: f"{m.group()[0]}\\-{m.group()[1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: {"\\": "\\", "n": "\n", "-": ""}[m.group(1)], text)


def opened(role: str) -> str:
    return f"{BEGIN}{escape(role).replace('\n', '\\n')}\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted example."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


EXAMPLES = "conv_id long, example long, target_turn long, formatted string, loss_start long, loss_end long"


def expander():
    """Function for mapInArrow over (conv_id, turn, role, text) in order: see EXAMPLES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        conv, known, prefix, examples, turns, open_ = None, False, [], 0, 0, False

        def written(target: int | None, start: int, end: int) -> tuple:
            return (conv, examples, target, "".join(prefix), start, end)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "example", "target_turn", "formatted", "loss_start", "loss_end"])

        at = 0
        for batch in batches:
            for own, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not known or own != conv:
                    if open_:
                        out.append(written(None, at, at))
                        size += at
                    conv, known, prefix, examples, turns, open_, at = own, True, [], 0, 0, False, 0
                head, body = opened(role or ""), escape(text or "")
                prefix += [head, body, f"{END}\n"]
                start = at + len(head)
                at = start + len(body) + len(END) + 1
                open_ = role != TRAINED
                if not open_:
                    prefix = ["".join(prefix)]
                    out.append(written(turns, start, start + len(body)))
                    examples += 1
                    size += at
                turns += 1
                if size >= FLUSH:
                    yield batch_of(out)
                    out, size = [], 0
        if open_:
            out.append(written(None, at, at))
        if out:
            yield batch_of(out)

    return run


def expand(conversations: DataFrame) -> DataFrame:
    """Examples of all conversations (conv_id, turn, role, text): see EXAMPLES.

    Turns come in order of turn (null first), then role and text; repeated rows are turns of their own. target_turn
    counts from 0 in that order and is null where nothing is trained. The mask is [loss_start, loss_end) in characters of
    `formatted`. A null text or role is empty; rows without conv_id are one conversation.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(expander(), EXAMPLES)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"


def reader():
    """Function for mapInArrow over examples in order: one row per conversation, read back from them; see DIGEST."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, known, last, loss, chars, total, n, rows = None, False, "", hashlib.sha256(), 0, 0, 0, []

        def done() -> tuple:
            turns, digest = read_turns(last), hashlib.sha256()
            for role, text in turns:
                digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            return (conv, len(turns), digest.hexdigest(), chars, loss.hexdigest(), total, n)

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in DIGEST.split(", ")])

        for batch in batches:
            for own, formatted, start, end in zip(batch.column(0).to_pylist(), batch.column(3), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                if known and own != conv:
                    rows.append(done())
                    loss, chars, total, n = hashlib.sha256(), 0, 0, 0
                conv, known, last = own, True, formatted.as_py()
                trained = unescape(last[start:end])
                loss.update(trained.encode("utf-8", "surrogatepass"))
                chars, total, n = chars + len(trained), total + len(last), n + 1
            yield batch_of()
            rows = []
        if known:
            rows = [done()]
            yield batch_of()

    return run


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation of what `expand` returned (its order within partitions is used): see DIGEST."""
    return examples.mapInArrow(reader(), DIGEST)
