"""Token ids of whole texts, written in ascending doc_id order as checksummed compressed blocks, and read back.

Texts are range-partitioned by doc_id and sorted. Each task encodes its texts and writes frames: runs of whole
documents, with their ids cut into blocks of the range coder (``coder``). A frame holds its documents' ids and sizes and
the place of its first token in the task's part, so it can be read alone; the places of the parts follow from their
sizes, one row per part. The files are Parquet tables of frames, so that a lost task is repeated and committed once.

Encoding is the tokenizers library's. No token of this tokenizer reaches across a blank, so each run of characters
between blanks is encoded once and remembered, up to ``REMEMBERED`` runs.

Defined cases: null and empty texts have the end id only; rows without doc_id come first; equal ids are ordered by
text; a block whose checksum differs when read fails the read.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.llm import coder
from haulmark.llm.common import map_batches, record_batch
from haulmark.session import new_path, ship_package

END_ID = 2
FRAME_IDS = 16 * coder.BLOCK
LANES = 1024
REMEMBERED = 500_000
_RUN = re.compile("[^ \t\n\r]+")
_FRAME = ("part int, place long, doc_ids array<long>, sizes array<int>, counts array<int>, checks array<long>, "
          "payloads array<binary>")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the block format holds ids below 65536")
        self.memory: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        runs = [_RUN.findall(t) for t in texts]
        if len(self.memory) > REMEMBERED:
            self.memory = {}
        memory = self.memory
        fresh = list({r for text in runs for r in text if r not in memory})
        for k in range(0, len(fresh), 1 << 14):
            part = fresh[k:k + (1 << 14)]
            for run, found in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                memory[run] = np.array(found.ids, dtype=np.uint16).tobytes()
        return [np.frombuffer(b"".join([memory[r] for r in text]), dtype=np.uint16) for text in runs]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _frames(part: int, place: int, docs: list[tuple]) -> tuple[pa.RecordBatch, int]:
    """Frames of (doc_id, ids) in order, and the place after them."""
    rows, blocks, held, n = [], [], [], 0
    for k, (doc_id, ids) in enumerate(docs):
        held.append((doc_id, ids))
        n += len(ids)
        if n >= FRAME_IDS or k == len(docs) - 1:
            flat = np.concatenate([i for _, i in held])
            cut = [flat[b:b + coder.BLOCK] for b in range(0, n, coder.BLOCK)]
            rows.append((place, [d for d, _ in held], [len(i) for _, i in held], len(cut)))
            blocks += cut
            place, held, n = place + n, [], 0
    payloads = coder.encode(blocks)
    checks, counts = [coder.checksum(b) for b in blocks], [len(b) for b in blocks]
    ends = np.concatenate([[0], np.cumsum([r[3] for r in rows])]).tolist()
    spans = list(zip(ends, ends[1:], strict=False))
    return record_batch(
        part=pa.array([part] * len(rows), pa.int32()), place=pa.array([r[0] for r in rows], pa.int64()),
        doc_ids=pa.array([r[1] for r in rows], pa.list_(pa.int64())), sizes=pa.array([r[2] for r in rows], pa.list_(pa.int32())),
        counts=pa.array([counts[a:b] for a, b in spans], pa.list_(pa.int32())),
        checks=pa.array([checks[a:b] for a, b in spans], pa.list_(pa.int64())),
        payloads=pa.array([payloads[a:b] for a, b in spans], pa.list_(pa.binary()))), place


def write(documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode all documents and write the frames to ``path``."""
    ship_package(documents.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        part, place, held, n = TaskContext.get().partitionId(), 0, [], 0
        known = encoder(tokenizer)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                for doc_id, ids in zip(some.column(0).to_pylist(), known.encode([t or "" for t in some.column(1).to_pylist()]), strict=True):
                    held.append((doc_id, np.append(ids, np.uint16(end_id))))
                    n += len(ids) + 1
                    if n >= LANES * coder.BLOCK:
                        frames, place = _frames(part, place, held)
                        yield frames
                        held, n = [], 0
        if held:
            yield _frames(part, place, held)[0]

    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = documents.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, _FRAME).write.option("compression", "none").parquet(path)


def _read_frames(batch: pa.RecordBatch):
    columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
    first = 0
    while first < batch.num_rows:
        last, lanes = first, 0
        while last < batch.num_rows and (last == first or lanes + len(columns[3][last]) <= LANES):
            lanes, last = lanes + len(columns[3][last]), last + 1
        payloads = [p for k in range(first, last) for p in columns[5][k]]
        blocks = coder.decode(payloads, [c for k in range(first, last) for c in columns[3][k]])
        for block, check in zip(blocks, (c for k in range(first, last) for c in columns[4][k]), strict=True):
            if coder.checksum(block) != check:
                raise ValueError("a block's checksum differs from its ids")
        out: list[tuple] = []
        at = 0
        for k in range(first, last):
            flat = np.concatenate(blocks[at:at + len(columns[3][k])])
            at += len(columns[3][k])
            place, done = columns[0][k], 0
            for doc_id, size in zip(columns[1][k], columns[2][k], strict=True):
                out.append((doc_id, place + done, size, flat[done:done + size].astype("<u4").tobytes()))
                done += size
        yield record_batch(doc_id=pa.array([o[0] for o in out], pa.int64()), start=pa.array([o[1] for o in out], pa.int64()),
                           n_tokens=pa.array([o[2] for o in out], pa.int64()), ids=pa.array([o[3] for o in out], pa.binary()))
        first = last


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids (little-endian, 32 bits each) of every document in the files."""
    frames = spark.read.schema(_FRAME).parquet(path)
    # One row per part, whose number is the number of write tasks.
    sizes = frames.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = frames.join(F.broadcast(sizes.select("part", before.alias("before"))), "part")
    return map_batches(placed.select((F.col("before") + F.col("place")).alias("place"), "doc_ids", "sizes", "counts", "checks", "payloads"),
                       "doc_id long, start long, n_tokens long, ids binary", _read_frames)


def report(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files and read them: doc_id, start, n_tokens and the CRC-32 of each document's ids."""
    path = new_path(documents.sparkSession, "token-files")
    write(documents, path, tokenizer)
    return read(documents.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
