"""Blocks: consecutive rows of one input partition packed into one compressed row.

Operators that send each distinct unit of a block out once and score or spell the block's
texts when the answers are back move the texts as blocks: Arrow batches compressed with zstd,
several times smaller than rows of text in a shuffle. A block ends with the row that
fills ``limit`` bytes, so it holds at most that much and one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

LEVEL = 6
#: What a row counts beside its text, so that a block of empty texts ends too.
ROW_BYTES = 64


def pack(batch: Any) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as out:
        out.write(batch)
    return sink.getvalue().to_pybytes()


def unpack(packed: bytes) -> Any:
    """The rows of a block as one table."""
    import pyarrow as pa

    return pa.ipc.open_stream(packed).read_all()


def blocked(batches: Iterator, sizes: Any, limit: int) -> Iterator[Any]:
    """Batches of about ``limit`` bytes each; ``sizes(batch)`` gives the rows' bytes as an array."""
    import numpy as np
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        total = size + np.cumsum(sizes(batch))
        at = 0
        while (cut := int(np.searchsorted(total, limit))) < batch.num_rows:
            held.append(batch.slice(at, cut + 1 - at))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, at = [], cut + 1
            total = total - total[cut]
            total[:at] = 0
        held.append(batch.slice(at))
        size = int(total[-1]) if at < batch.num_rows else 0
    held = [b for b in held if b.num_rows]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def release() -> None:
    """Give the system what the allocators hold free: Spark keeps Python workers, and a worker that
    waits would keep the memory of its largest block."""
    import pyarrow as pa

    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def numbers() -> Iterator[int]:
    """Block numbers of the running task, unique over the job."""
    from itertools import count

    from pyspark import TaskContext

    return count(TaskContext.get().partitionId() << 32)
