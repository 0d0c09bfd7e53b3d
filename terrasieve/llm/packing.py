"""Packing: order-preserving dynamic programming over window cuts.

The ids of a task's documents, in doc_id order, form one stream. Windows of at most `size` ids cover it. A window may end at a
document's end (free), at a sentence's end (small penalty) or, where boundaries are further apart than `stride`, inside a sentence
(large penalty; with a stride of 256, any sentence of more ids offers such ends). A window costs its padding, a fixed cost, and the penalty of its end; padding is size less length, or nothing at a
power of two. best[j] = min over i of best[i] + cost(i, j): for the padding term the least best[i] + position[i] within reach is the
head of a monotone queue, and windows of a power of two are single look-ups. Each boundary enters and leaves the queue once.

Streams are solved segment by segment, so memory holds one segment and one document. A segment's cuts are least-cost for what it holds;
those in its last two windows' length are dropped and solved again with the next segment, as later documents may change them. So the
whole is not proven least-cost across segments, only each segment is. What is left at a task's end is cut into powers of two, which
need no padding.

Defined results: null text counts as empty and gives the end id alone. Rows with one doc_id are documents of their own, by text order.
An empty table gives no rows. Extra columns are not read. Sequence ids are task number * 2^40 + number within the task.

Plan: no shuffle. Each task sorts its own rows by id and packs them; a rerun of a task after a loss gives the same rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasieve.llm.columns import whole_text
from terrasieve.llm.word_tokens import word_encoder
from terrasieve.llm.worker_memory import slices

#: In ids: what a window costs besides its padding, and the penalties of its end.
WINDOW_COST, SENTENCE_COST, INSIDE_COST = 16, 2, 40
#: Ids between boundaries inside a long sentence; ids that a segment holds.
STRIDE, SEGMENT = 256, 1 << 17


def boundaries(length: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Positions 0 < p <= length where a window may end, ascending, and their penalties."""
    penalty = np.full(length + 1, -1, dtype=np.int32)
    penalty[sentence_ends] = SENTENCE_COST
    penalty[doc_ends] = 0
    penalty[length] = 0
    penalty[0] = -1
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(np.concatenate([[0], at]))
    for end, gap in zip(at[gaps > stride], gaps[gaps > stride], strict=True):
        penalty[end - gap + stride : end : stride] = INSIDE_COST
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def cut(at: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Window ends of least total cost, the last of them at[-1]. Boundaries must not be further apart than size."""
    positions = [0, *at.tolist()]
    extra = [0, *(penalty + WINDOW_COST).tolist()]
    grid = np.array(positions)
    powers = []
    for k in range((size // 4).bit_length() - 1, size.bit_length()):
        if (width := 1 << k) <= size:
            where = np.searchsorted(grid, grid - width)
            powers.append(np.where(grid[np.minimum(where, len(grid) - 1)] == grid - width, where, -1).tolist())
    best, back = [0] * len(positions), [0] * len(positions)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + position, index), rising
    for j in range(1, len(positions)):
        p = positions[j]
        while positions[queue[0][1]] < p - size:
            queue.popleft()
        key, i = queue[0]
        least = key + size - p
        for look in powers:
            if (x := look[j]) >= 0 and best[x] < least:
                least, i = best[x], x
        best[j], back[j] = least + extra[j], i
        key = best[j] + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    ends, j = [], len(positions) - 1
    while j:
        ends.append(positions[j])
        j = back[j]
    return ends[::-1]


def powers_of_two(start: int, end: int) -> list[int]:
    """Ends that cut start to end into falling powers of two."""
    ends = []
    while start < end:
        start += 1 << ((end - start).bit_length() - 1)
        ends.append(start)
    return ends


class Packer:
    """Takes the documents of one stream, gives pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence, offset."""

    def __init__(self, sentence_end: np.ndarray, size: int = 2048, segment: int = SEGMENT):
        self.sentence_end, self.size, self.segment = sentence_end, size, max(segment, 4 * size)
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int]] = []  # id, ids in all, ids of it already given
        self.held = self.sequence = 0

    def add(self, doc_id: object, ids: np.ndarray) -> list[tuple]:
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.held += len(ids)
        return self._pack(False) if self.held >= self.segment else []

    def finish(self) -> list[tuple]:
        return self._pack(True) if self.held else []

    def _pack(self, last: bool) -> list[tuple]:
        ids = np.concatenate(self.ids)
        left = [n - given for _, n, given in self.docs]
        doc_ends = np.cumsum(left)
        ends = cut(*boundaries(len(ids), doc_ends, np.flatnonzero(self.sentence_end[ids]) + 1), self.size)
        if last:
            start = ends[-2] if len(ends) > 1 else 0
            ends = ends[:-1] + powers_of_two(start, ends[-1]) if ends[-1] - start < self.size else ends
        else:  # the last windows may change with what follows
            ends = [e for e in ends if e <= len(ids) - 2 * self.size]
        done = ends[-1]
        points = np.union1d(ends, doc_ends[doc_ends <= done])
        starts = np.concatenate([[0], points[:-1]])
        doc_of = np.searchsorted(doc_ends, starts, side="right")
        window_of = np.searchsorted(ends, starts, side="right")
        firsts = [0, *ends]
        doc_starts = doc_ends - left
        rows = []
        for a, b, d, w in zip(starts.tolist(), points.tolist(), doc_of.tolist(), window_of.tolist(), strict=True):
            doc_id, n, given = self.docs[d]
            rows.append((doc_id, given + a - int(doc_starts[d]), b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), n, self.sequence + w, a - firsts[w]))
        self.sequence += len(ends)
        keep = int(np.searchsorted(doc_ends, done, side="right"))
        self.docs = self.docs[keep:]
        if self.docs:
            doc_id, n, given = self.docs[0]
            self.docs[0] = (doc_id, n, given + done - int(doc_starts[keep]))
        self.ids = [ids[done:]]
        self.held = len(ids) - done
        return rows


def sentence_end_table(encoder) -> np.ndarray:
    """Which ids end a sentence: marks only, one of them . ! ? or an ellipsis."""
    table = np.zeros(encoder.tokenizer.get_vocab_size(), dtype=bool)
    for token, i in encoder.tokenizer.get_vocab().items():
        word = token.removesuffix("</w>")
        table[i] = bool(word) and not any(c.isalnum() for c in word) and any(c in ".!?…" for c in word)
    return table


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    d = whole_text(docs, id_col, text_col).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = word_encoder(tokenizer)
        packer = Packer(sentence_end_table(encoder), size)
        packer.sequence = TaskContext.get().partitionId() << 40
        tail = np.array([end_id], dtype=encoder.dtype)
        id_type = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, id_type if i == 0 else pa.int64()) for i, c in enumerate(columns)], names=list(names))

        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in slices(batch):
                rows: list[tuple] = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    rows += packer.add(doc_id, np.concatenate([ids, tail]))
                if rows:
                    yield table(rows)
        if rows := packer.finish():
            yield table(rows)

    return d.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
