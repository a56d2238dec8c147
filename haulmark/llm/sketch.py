"""A table of counters of fixed size over 64-bit hashes, filled by all tasks and merged by block."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS = 22
_BLOCKS = 1 << 10
_WIDTH = (1 << BITS) // _BLOCKS


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def counts(df: DataFrame, hashes_of) -> np.ndarray:
    """Bit length of the number of hashes in each slot, over all rows of ``df``.

    ``hashes_of(batch)`` yields arrays of hashes. A task adds its rows up first and sends compressed blocks of
    counters, whose number does not depend on the rows; each block is then summed as a stream. What comes to the
    driver is one byte per slot, 4 MB.
    """
    def fill(batches):
        total = np.zeros(1 << BITS, dtype=np.uint32)
        seen = False
        for batch in batches:
            for hashes in hashes_of(batch):
                seen = True
                total += np.bincount(slots(hashes), minlength=1 << BITS).astype(np.uint32) if len(hashes) > 1 << 16 else 0
                if len(hashes) <= 1 << 16:
                    np.add.at(total, slots(hashes), 1)
        if seen:
            packed = [zlib.compress(part.tobytes(), 1) for part in total.reshape(_BLOCKS, _WIDTH)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_BLOCKS), pa.int32()), pa.array(packed, pa.binary())],
                                             names=["block", "counters"])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(packed), dtype=np.uint32).astype(np.uint64)
                held[block] = held[block] + part if block in held else part
        lengths = [np.ceil(np.log2(part + np.uint64(1))).astype(np.uint8).tobytes() for part in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(lengths, pa.binary())],
                                         names=["block", "counters"])

    schema = "block int, counters binary"
    merged = df.mapInArrow(fill, schema).repartition("block").mapInArrow(merge, schema).collect()
    out = np.zeros((_BLOCKS, _WIDTH), dtype=np.uint8)
    for row in merged:
        out[row["block"]] = np.frombuffer(row["counters"], dtype=np.uint8)
    return out.ravel()
