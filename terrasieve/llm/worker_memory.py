"""What a Python worker keeps between tasks: the vocabulary and caches of one operator, so that a reused worker holds no other's; and what
it holds of a batch: the texts of one slice."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_HELD: dict[object, object] = {}
#: glibc's call that gives freed pages back to the system; other libraries have none.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Freed memory goes back to the system, where it would stay with this worker."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def one_of[T](name: object, make: Callable[[], T]) -> T:
    """The object that make() gave for this name. Another name's object goes first."""
    if name not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[name] = make()
    return _HELD[name]


def make_room(name: str) -> None:
    """This worker now works for an operator that keeps nothing: what others kept goes."""
    one_of(name, object)


def slices(batch: pa.RecordBatch, column: str | int = "text", size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """All rows of the batch in slices of about so many bytes of a text column, one row at least: only one slice's texts become Python
    strings at a time, so memory doesn't follow the batch size."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)) + 1
        yield batch.slice(at, stop - at)
        at = stop
        give_back()  # 5 ms
