"""Token-id files: canonical length-limited Huffman coding.

A set of files at one path has three parts, each a Parquet table:

* ``codebook`` (id, length): code lengths from the global counts of all ids.
  Codes are canonical, so lengths are enough: shorter codes first, equal
  lengths in order of id, each code one more than the last.
* ``blocks`` (shard, block, first, doc_ids, counts, data): ``data`` decodes on
  its own.  Its layout: ``HUF1``, then little-endian u64 token count, u32
  tokens per checkpoint, u32 CRC-32 of the code bytes, one u64 bit offset per
  checkpoint, the code bytes (most significant bit first).
* ``shards`` (shard, start): ids of all shards before; ``first`` counts from it.

Documents stand in ascending doc_id order over shards, blocks and doc_ids.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleflow.llm.common import importable, load, slices
from candleflow.llm.tokens import encoder
from candleflow.session import delete_paths, scratch_path

END_ID = 2
MAX_LENGTH = 16
BLOCK_TOKENS = 1 << 18
CHECKPOINT = 128
HEADER = struct.Struct("<4sQII")

RAW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("ids", pa.binary()),
])
RAW_DDL = "shard int, block int, first long, doc_ids array<long>, counts array<long>, ids binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (0 where a count is 0),
    by package-merge: a level holds the symbols and the pairs of the level
    below, cheapest first; the first 2n-2 entries of the last level are
    taken, and taking a pair takes both of its halves a level further down."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    by_cost = used[np.argsort(counts[used], kind="stable")]
    cost = counts[by_cost].astype(np.int64)
    level, is_pair = cost, []
    for _ in range(limit):
        order = np.argsort(level, kind="stable") if is_pair else np.arange(len(level))
        is_pair.append((order >= len(cost)) if is_pair else np.zeros(len(cost), bool))
        merged = level[order]
        half = len(merged) // 2
        level = np.concatenate([cost, merged[: 2 * half : 2] + merged[1 : 2 * half : 2]])
    take = 2 * len(used) - 2
    for pairs in reversed(is_pair):
        n_pairs = int(pairs[:take].sum())
        lengths[by_cost[: take - n_pairs]] += 1
        take = 2 * n_pairs
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id with a length; 0 elsewhere."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    code, last = 0, 0
    for s in order[np.count_nonzero(lengths == 0):].tolist():
        code <<= int(lengths[s]) - last
        last = int(lengths[s])
        codes[s] = code
        code += 1
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, every: int = CHECKPOINT) -> bytes:
    """One block's ``data``: each code lands in one or two 32-bit words, whose
    parts are disjoint bits and so may be summed."""
    n = len(ids)
    bits = lengths[ids]
    ends = np.cumsum(bits)
    at = ends - bits
    total = int(ends[-1]) if n else 0
    word, inside = at >> 5, (at & 31).astype(np.uint64)
    both = codes[ids] << (np.uint64(64) - bits.astype(np.uint64) - inside)
    size = (total >> 5) + 2
    words = np.bincount(word, (both >> np.uint64(32)).astype(np.float64), size)[:size]
    words += np.bincount(word + 1, (both & np.uint64(0xFFFFFFFF)).astype(np.float64), size)[:size]
    payload = words.astype(np.uint64).astype(">u4").tobytes()[: (total + 7) // 8]
    return HEADER.pack(b"HUF1", n, every, zlib.crc32(payload)) + at[::every].astype("<u8").tobytes() + payload


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each possible window of as many bits as the longest code has: the
    id whose code it starts with, and that code's length."""
    width = max(1, int(lengths.max(initial=0)))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[np.count_nonzero(lengths == 0):]
    spans = 1 << (width - lengths[order])
    ids, steps = np.zeros(1 << width, np.int64), np.ones(1 << width, np.int64)
    filled = int(spans.sum())
    ids[:filled], steps[:filled] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, steps, width


def decode_block(data: bytes, ids: np.ndarray, steps: np.ndarray, width: int) -> np.ndarray:
    """The ids of one block.  All stretches between checkpoints are decoded
    side by side, a table look-up per step."""
    magic, n, every, crc = HEADER.unpack_from(data)
    lanes = -(-n // every)
    points = np.frombuffer(data, "<u8", lanes, HEADER.size).astype(np.int64)
    payload = data[HEADER.size + 8 * lanes :]
    if magic != b"HUF1" or zlib.crc32(payload) != crc:
        raise ValueError("damaged block")
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    out = np.zeros((every, lanes), np.int64)
    at, last, mask = points.copy(), len(windows) - 1, (1 << width) - 1
    for k in range(every if n else 0):
        look = (windows[np.minimum(at >> 3, last)] >> (32 - width - (at & 7)).astype(np.uint32)) & mask
        out[k] = ids[look]
        at += steps[look]
    return out.T.reshape(-1)[:n]


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    enc = encoder(path)
    end = np.array([end_id], enc.dtype).tobytes()
    width, shard = enc.dtype.itemsize, TaskContext.get().partitionId()
    block, first, held = 0, 0, 0
    docs: list[int | None] = []
    texts: list[bytes] = []

    def flush() -> pa.RecordBatch:
        nonlocal block, first, held, docs, texts
        row = {"shard": shard, "block": block, "first": first, "doc_ids": docs, "counts": [len(t) // width for t in texts], "ids": b"".join(texts)}
        block, first, held, docs, texts = block + 1, first + held, 0, [], []
        return pa.RecordBatch.from_pylist([row], schema=RAW)

    for batch in slices(batches, "text", 2 << 20):
        for doc, ids in zip(batch.column("doc_id").to_pylist(), enc(batch.column("text").to_pylist()), strict=True):
            docs.append(doc)
            texts.append(ids + end)
            held += len(ids) // width + 1
            if held >= size:
                yield flush()
    if docs:
        yield flush()


def _counted(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for x in batch.column("ids"):
            found = np.bincount(np.frombuffer(x.as_buffer(), f"<u{width}"))
            if len(found) > len(total):
                found, total = total, found
            total[: len(found)] += found
    ids = np.flatnonzero(total)
    yield pa.record_batch([pa.array(ids), pa.array(total[ids])], names=["id", "n"])


def _encoded(batches: Iterator[pa.RecordBatch], lengths: np.ndarray, width: int, every: int) -> Iterator[pa.RecordBatch]:
    codes = canonical(lengths)
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            data = encode_block(np.frombuffer(row.column("ids")[0].as_buffer(), f"<u{width}").astype(np.int64), lengths, codes, every)
            yield pa.record_batch([*row.columns[:-1], pa.array([data], pa.binary())], names=[*row.schema.names[:-1], "data"])


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS,
              every: int = CHECKPOINT, max_length: int = MAX_LENGTH) -> None:
    """Encode ``docs`` (doc_id, text; other columns are ignored) into files at
    ``path``.

    A null text counts as empty; each document ends with ``end_id``.  Rows
    stand in ascending doc_id order, null doc_ids first, repeated ids in the
    order of a hash of the text.  An empty table gives empty files.  A
    document is never split between blocks, so a block holds about
    ``block_tokens`` ids or one longer document.  The driver sees the counts
    of the ids, at most as many as the vocabulary has.
    """
    spark = docs.sparkSession
    importable(spark)
    width = encoder(tokenizer).dtype.itemsize
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = slim.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    raw_at = scratch_path(spark, "ids")
    ordered.mapInArrow(lambda it: _blocks(it, tokenizer, end_id, block_tokens), RAW_DDL).write.option("compression", "zstd").parquet(raw_at)
    raw = spark.read.schema(RAW_DDL).parquet(raw_at)

    counts = raw.select("ids").mapInArrow(lambda it: _counted(it, width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(max([r["id"] for r in counts], default=0) + 1, np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    lengths = code_lengths(total, max_length)
    book = [(i, int(n)) for i, n in enumerate(lengths.tolist()) if n]
    spark.createDataFrame(book, "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")

    shared = spark.sparkContext.broadcast(lengths)  # as long as the vocabulary at most
    ddl = RAW_DDL.replace("ids binary", "data binary")
    raw.mapInArrow(lambda it: _encoded(it, shared.value, width, every), ddl).write.option("compression", "none").parquet(f"{path}/blocks")
    sizes = spark.read.schema(ddl).parquet(f"{path}/blocks").select("shard", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard: one for each writing task
    sizes.groupBy("shard").agg(F.sum("n").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).write.parquet(f"{path}/shards")
    delete_paths(spark, [raw_at])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files at ``path``: doc_id, start (ids of all
    documents before it), n_tokens, ids (little-endian, 4 bytes each)."""
    importable(spark)
    book = spark.read.schema("id long, length int").parquet(f"{path}/codebook").collect()
    lengths = np.zeros(max([r["id"] for r in book], default=0) + 1, np.int64)
    for r in book:
        lengths[r["id"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths)
    shards = spark.read.schema("shard int, start long").parquet(f"{path}/shards")
    blocks = spark.read.schema(RAW_DDL.replace("ids binary", "data binary")).parquet(f"{path}/blocks")
    return (blocks.mapInArrow(lambda it: _decoded(it, shared.value), "shard int, doc_id long, inner long, n_tokens long, ids binary")
            .join(F.broadcast(shards), "shard").select("doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids"))


def _decoded(batches: Iterator[pa.RecordBatch], lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids, steps, width = decode_table(lengths)
    names = ["shard", "doc_id", "inner", "n_tokens", "ids"]
    for batch in batches:
        for k in range(batch.num_rows):
            shard, first = batch.column("shard")[k].as_py(), batch.column("first")[k].as_py()
            out = decode_block(batch.column("data")[k].as_py(), ids, steps, width).astype("<u4").tobytes()
            counts = np.array(batch.column("counts")[k].as_py(), np.int64)
            starts = np.cumsum(counts) - counts
            cut = [out[4 * s : 4 * (s + n)] for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
            yield pa.record_batch([
                pa.array([shard] * len(counts), pa.int32()), pa.array(batch.column("doc_ids")[k].as_py(), pa.int64()),
                pa.array(first + starts), pa.array(counts), pa.array(cut, pa.binary()),
            ], names=names)


def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as Huffman-coded blocks and read back."""
    path = scratch_path(spark, "huffman")
    write_ids(load(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
