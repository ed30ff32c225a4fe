"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing: every task packs the pieces it has tokenised
best-fit-decreasing, buffer by buffer.  Bins that are full but for a few
tokens are final.  The others become items of their fill length, are grouped
into bounded groups and packed again, bins into bins, round after round, until
one group holds them all or a round saves nothing.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.llm.common import importable, load, slices
from candleflow.llm.tokens import encoder
from candleflow.session import delete_paths, materialize, materialize_at, scratch_path

CAPACITY = 2048
END_ID = 0
#: A bin with at most so many free tokens is final.
FREE = 4
#: Tokens that a task gathers before it packs them.
BUFFER = 2_000_000
#: Bins packed together in one group of a later round.
GROUP = 50_000

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids", pa.binary()), ("bin", pa.int64()), ("slot", pa.int64()), ("fill", pa.int64()),
])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids binary, bin long, slot long, fill long"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: for each item its bin and its offset there, and
    the fill of each bin.  An item goes to the open bin with the least room
    that still holds it; ties in length keep the given order.  Bins with equal
    room are interchangeable, so a stack per room and a bit per non-empty
    stack find the best one in constant time."""
    order = np.argsort(-lengths, kind="stable")
    at, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        if fitting := rooms >> n:
            room = n + (fitting & -fitting).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        at[i], offset[i] = b, fills[b]
        fills[b] += n
        if left := room - n:
            stacks[left].append(b)
            rooms |= 1 << left
    return at, offset, fills


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *[(s, capacity) for s in range(first, n, capacity)]]


def _packed(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, buffer: int) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    enc = encoder(path)
    end = np.array([end_id], enc.dtype).tobytes()
    width, made, part = enc.dtype.itemsize, 0, TaskContext.get().partitionId()
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal rows, held, made
        lengths = np.array([r[3] for r in rows], np.int64)
        at, offset, fills = best_fit(lengths, capacity)
        doc, piece, start, _, ids = zip(*rows, strict=True)
        out = pa.record_batch([
            pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(lengths), pa.array(ids, pa.binary()),
            pa.array((part << 36) + made + at), pa.array(offset), pa.array(np.array(fills, np.int64)[at]),
        ], schema=PIECES)
        made += len(fills)
        rows, held = [], 0
        return out

    for batch in slices(batches, "text", 2 << 20):
        for doc, ids in zip(batch.column("doc_id").to_pylist(), enc(batch.column("text").to_pylist()), strict=True):
            ids += end
            n = len(ids) // width
            for k, (start, length) in enumerate(cut(n, capacity)):
                rows.append((doc, k, start, length, ids[start * width : (start + length) * width]))
            held += n
            if held >= buffer:
                yield flush()
    if rows:
        yield flush()


def _merged(items: pd.DataFrame, capacity: int) -> pd.DataFrame:
    items = items.sort_values("bin")
    at, offset, fills = best_fit(items["fill"].to_numpy(np.int64), capacity)
    lead = np.zeros(len(fills), np.int64)
    first = offset == 0
    lead[at[first]] = items["bin"].to_numpy()[first]  # the merged bin bears the number of the bin at its start
    return pd.DataFrame({"bin": items["bin"], "root": lead[at], "base": offset, "fill": np.array(fills, np.int64)[at]})


@dataclass
class Packed:
    """``pieces``: doc_id, piece, start, length, ids (little-endian, 2 bytes
    each where the vocabulary allows it, else 4), bin, slot (place in the
    bin), fill (of the bin).  ``moves``: bin, root, base for bins that were
    merged into others.  ``width``: bytes per id."""

    pieces: DataFrame
    moves: DataFrame
    width: int

    def placed(self, pieces: DataFrame) -> DataFrame:
        """Pieces with their final place: sequence_id and offset."""
        return pieces.join(self.moves, "bin", "left").select(
            *[c for c in pieces.columns if c not in ("bin", "slot", "fill")],
            F.coalesce("root", "bin").alias("sequence_id"), (F.col("slot") + F.coalesce("base", F.lit(0))).alias("offset"),
        )

    def sequences(self) -> DataFrame:
        """All pieces with their ids and final places."""
        return self.placed(self.pieces)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, free: int = FREE,
         buffer: int = BUFFER, group: int = GROUP) -> Packed:
    """Tokenise ``docs`` (doc_id, text; other columns are ignored) and pack
    them.  A null text counts as empty and gives the end id alone; repeated
    rows and null doc_ids are packed like any others; an empty table gives no
    rows.  A document longer than ``capacity`` is cut, the first piece taking
    the remainder.  Tokens of a document are never dropped.  Memory of a task
    is bounded by ``buffer`` tokens and one document, that of a later round by
    ``group`` bins."""
    spark = docs.sparkSession
    importable(spark)
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    where = scratch_path(spark, "pack")
    slim.mapInArrow(lambda it: _packed(it, path, capacity, end_id, buffer), PIECES_DDL).write.option("compression", "zstd").parquet(where)
    pieces = spark.read.schema(PIECES_DDL).parquet(where)

    items = materialize(pieces.where((F.col("slot") == 0) & (F.col("fill") < capacity - free)).select("bin", "fill"), "bins")
    moves = spark.createDataFrame([], "bin long, root long, base long")
    left, old = items.count(), []
    while left > 1:
        groups = -(-left // group)
        merged, at = materialize_at(
            items.groupBy((F.pmod(F.xxhash64("bin"), F.lit(groups))).alias("g"))
            .applyInPandas(lambda pdf: _merged(pdf, capacity), "bin long, root long, base long, fill long"), "merge")
        step = merged.select(F.col("bin").alias("root"), F.col("root").alias("next"), F.col("base").alias("more"))
        so_far = moves.join(step, "root", "left").select("bin", F.coalesce("next", "root").alias("root"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base"))
        known = so_far.unionByName(merged.select("bin", "root", "base").join(moves.select("bin"), "bin", "left_anti"))
        moves, moves_at = materialize_at(known, "moves")
        delete_paths(spark, old)
        old = [at, moves_at]
        items = merged.where((F.col("bin") == F.col("root")) & (F.col("fill") < capacity - free)).select("bin", "fill")
        before, left = left, items.count()
        if groups == 1 or left > 0.98 * before:
            break
    return Packed(pieces, moves, 2 if _narrow(path) else 4)


def _narrow(path: str) -> bool:
    return encoder(path).dtype.itemsize == 2


def _digests(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4")) for x in batch.column("ids").to_pylist()]
        keep = [n for n in batch.schema.names if n != "ids"]
        yield pa.record_batch([*[batch.column(n) for n in keep], pa.array(crc, pa.int64())], names=[*keep, "ids_crc32"])


def packed_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece of the packed ``docs``: doc_id, piece, start, length,
    ids_crc32 (of the ids as unsigned 32-bit little-endian), sequence_id, offset."""
    packed = pack(docs, path)
    width = packed.width
    slim = packed.pieces.mapInArrow(lambda it: _digests(it, width), "doc_id long, piece int, start long, length long, bin long, slot long, fill long, ids_crc32 long")
    return packed.placed(slim)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, one row per piece."""
    return packed_digests(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
