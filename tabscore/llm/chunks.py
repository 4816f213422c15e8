"""Per-worker memory of encoded chunks, shared by the two tokenizer operators.

A tokenizer whose steps never look across a chunk border gives, for a text, the ids of its chunks in a row.  So a
worker encodes each distinct chunk once (in multithreaded batches) and joins the stored bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Callable


class ChunkMemory:
    """Chunk -> packed ids.  Two generations bound the memory: when the younger holds ``size`` chunks the older is
    given up.  A forgotten chunk is encoded again, so results never depend on ``size``."""

    def __init__(self, encode_batch: Callable[[list], list], size: int = 400_000):
        self.encode_batch, self.size = encode_batch, size
        self.young: dict = {}
        self.old: dict = {}

    def clear(self) -> None:
        """Forget all chunks, so that a reused worker holds no memory for its next stage."""
        self.young, self.old = {}, {}

    def pack(self, texts: list[list]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, given as its chunks."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for c in set().union(*texts).difference(young):
            if c in old:
                young[c] = old[c]
            else:
                new.append(c)
        for c, ids in zip(new, self.encode_batch(new) if new else []):
            young[c] = struct.pack(f"<{len(ids)}I", *ids)
        get = young.__getitem__
        return [b"".join(map(get, parts)) for parts in texts]


def slices(sizes: list[int], most: int = 1_000_000):
    """``(start, end)`` runs of consecutive items whose sizes add up to about ``most``."""
    start = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batch, column: str, most: int = 1_000_000, raw: bool = False):
    """``(start, end, texts)`` of consecutive rows of an Arrow batch whose texts hold about ``most`` bytes (nulls: empty); only
    one slice's texts exist as Python strings (``raw``: as UTF-8 bytes) at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc
    texts = batch.column(column)
    none = b"" if raw else ""
    for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most):
        part = texts.slice(a, b - a)
        yield a, b, [x or none for x in (part.cast(pa.binary()) if raw else part).to_pylist()]


def give_back() -> None:
    """Return memory that is no longer used to the system: a reused worker keeps freed pages otherwise.  Called at the end of a task."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def giving_back(run: Callable) -> Callable:
    """``run(batches)`` of a ``mapInPandas`` or ``mapInArrow``, with its memory given back when its task is over."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped
