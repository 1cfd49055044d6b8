"""Packing of documents into sequences by the sum-of-squares rule, with a level array.

A document's ids, ended by id 0, fill whole windows first; what remains is placed online: into the
open window (or a new one) whose level makes the sum over levels of (number of open windows)**2
least. The state is one counter for each level and a stack of windows for each level; ties go to the
fullest window. Each task packs what it reads, in order, so nothing is shuffled and no task holds
more than ``OPEN`` open windows: beyond that, and at its end, it lays their pieces out in a row and
cuts them at window ends, so that a task pads one sequence at most.

Defined results: null text counts as empty and has the ending id only. Texts of any length are
packed whole. Ids may be null or repeat. An empty table gives no pieces. Sequence ids are unique
within a result (task number and a count). Further columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import refuse_names, register, table, texts_of
from .token_counts import default_tokenizer
from .tokens import not_whole, tokens

WINDOW = 1024
OPEN = 4096
END_ID = 0
TASK_BITS = 36


class Packer:
    """Open windows by level. ``out`` takes (doc row, start, ids as bytes, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.stacks: list[list[list]] = [[] for _ in range(window + 1)]
        self.open = 0
        self.out: list[tuple] = []

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def level_for(self, size: int) -> int:
        """The level at which a piece of ``size`` adds least to the sum of squares; 0 is a new window."""
        room = self.window - size
        here, there = self.levels[: room + 1], self.levels[size:]
        # Half the change of the sum of squares, less a constant: a window leaves ``here`` for ``there``.
        change = (there - here).astype(float)
        change[here == 0] = np.inf
        # Full windows do not count, and an empty one does not leave a level.
        change[room] = -here[room] - 0.5 if here[room] else np.inf
        change[0] = there[0] - 0.5 if room else -0.5
        best = len(change) - 1 - int(change[::-1].argmin())
        return best

    def add(self, doc: int, ids: np.ndarray) -> None:
        cut = len(ids) // self.window * self.window
        for start in range(0, cut, self.window):
            self.out.append((doc, start, ids[start : start + self.window].tobytes(), self.sequence(), 0))
        if cut < len(ids):
            self.place(doc, cut, ids[cut:].tobytes())

    def place(self, doc: int, start: int, data: bytes) -> None:
        size = len(data) // 4
        level = self.level_for(size)
        if level:
            pieces = self.stacks[level].pop()
            self.levels[level] -= 1
        else:
            pieces = []
            self.open += 1
        pieces.append((doc, start, data))
        if level + size == self.window:
            self.open -= 1
            self.emit(pieces)
        else:
            self.stacks[level + size].append(pieces)
            self.levels[level + size] += 1
        if self.open > OPEN:
            self.flush(last=False)

    def emit(self, pieces: list) -> None:
        sequence, offset = self.sequence(), 0
        for doc, start, data in pieces:
            self.out.append((doc, start, data, sequence, offset))
            offset += len(data) // 4

    def flush(self, last: bool = True) -> None:
        """Close all open windows: their pieces in a row, cut at window ends.

        What fills no window at the end stays open, unless this is the ``last`` time.
        """
        row, room = [], self.window
        for stack in self.stacks:
            for doc, start, data in (p for pieces in stack for p in pieces):
                while data:
                    part, data = data[: 4 * room], data[4 * room :]
                    row.append((doc, start, part))
                    start += len(part) // 4
                    room -= len(part) // 4
                    if not room:
                        self.emit(row)
                        row, room = [], self.window
            stack.clear()
        self.levels[:] = 0
        self.open = 0
        if row and last:
            self.emit(row)
        elif row:
            self.stacks[self.window - room].append(row)
            self.levels[self.window - room] = self.open = 1


def pack(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rest = not_whole(str(path))
    refuse_names(id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "text")
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << TASK_BITS)
        # Documents with pieces still to come: their id and number of tokens, by row.
        docs_seen: dict[int, tuple] = {}
        row, id_type = 0, None

        def made() -> pa.RecordBatch:
            out, packer.out = packer.out, []
            doc, start, data, sequence, offset = zip(*out)
            length = [len(d) // 4 for d in data]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([docs_seen[d][0] for d in doc], type=id_type),
                    pa.array(start, type=pa.int64()),
                    pa.array(length, type=pa.int64()),
                    pa.array([zlib.crc32(d) for d in data], type=pa.int64()),
                    pa.array([docs_seen[d][1] for d in doc], type=pa.int64()),
                    pa.array(sequence, type=pa.int64()),
                    pa.array(offset, type=pa.int64()),
                ],
                [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            # Of a document, one piece at most lies in an open window: all else is out.
            waiting = {p[0] for stack in packer.stacks for pieces in stack for p in pieces}
            for d in [d for d in docs_seen if d not in waiting]:
                del docs_seen[d]
            return batch

        for batch in found:
            if not batch.num_rows:
                continue
            ids_of, texts = batch.column(id_column), texts_of(batch)
            id_type = ids_of.type
            names = ids_of.to_pylist()
            for first, ids, bounds in tokens(str(path), rest).encode(texts):
                for i in range(len(bounds) - 1):
                    own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(END_ID)).astype("<u4")
                    docs_seen[row] = names[first + i], len(own)
                    packer.add(row, own)
                    row += 1
                if packer.out:
                    yield made()
        packer.flush()
        if packer.out:
            yield made()

    source = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return source.mapInArrow(run, schema)


@register("op7_packing")
def op7(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
