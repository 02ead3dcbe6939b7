"""Token ids in a compact binary form: canonical length-limited Huffman codes of ids from global counts.

A table of blocks holds the documents in ascending doc_id order.  Each block stands alone: whole documents, their
lengths, one bit stream, and the bit offset of every ``CHECKPOINT``-th id, so that decoding can start at any of them;
the reader decodes all checkpoints of a block side by side from one table.  The code lengths of all ids are a second,
small table.  Blocks are rows of Parquet files, so writing goes through Spark's commit protocol and works on any store.

Null and empty texts are the end id alone.  Repeated documents are kept; null doc_ids come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm import common, tokens

MAX_BITS = 20
CHECKPOINT = 512
BLOCK_IDS = 1 << 17
#: Blocks that are decoded together.
BLOCKS_AT_ONCE = 24

ENCODED = "segment int, before long, doc_ids array<long>, doc_lengths array<long>, ids binary"
BLOCKS = "segment int, before long, doc_ids array<long>, doc_lengths array<long>, checkpoints array<long>, bits binary"
SLAB_NAMES = ["segment", "before", "doc_ids", "doc_lengths", "ids"]
SLAB_KINDS = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
DECODED = "segment int, doc_id long, before long, n_tokens long, ids_crc32 long"


# --- codes ---------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} different ids cannot have codes of {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    level, is_leaf = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(max_bits - 1):
        even = level[: len(level) // 2 * 2]
        both = np.concatenate([leaves, even[0::2] + even[1::2]])
        order = np.argsort(both, kind="stable")
        level = both[order]
        is_leaf.append(order < len(leaves))
    taken = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), dtype=np.int64)
    for kinds in reversed(is_leaf):
        n_leaves = int(kinds[:taken].sum())
        depth[:n_leaves] += 1
        taken = 2 * (taken - n_leaves)
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    codes = np.zeros(len(lengths), dtype=np.uint64)
    if len(used):
        top = int(lengths[used].max())
        steps = np.left_shift(np.uint64(1), (top - lengths[used]).astype(np.uint64))
        firsts = np.concatenate([[0], np.cumsum(steps)[:-1]]).astype(np.uint64)
        codes[used] = firsts >> (top - lengths[used]).astype(np.uint64)
    return codes


def encode_ids(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream, in whole 32-bit words, and the bit offsets of the checkpoints."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    words = np.zeros((int(ends[-1]) >> 5) + 2, dtype=np.uint64)
    word = starts >> 5
    shifted = codes[ids] << (64 - sizes - (starts & 31)).astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    merged = np.bitwise_or.reduceat(shifted, first)
    at = word[first]
    words[at] |= merged >> np.uint64(32)
    words[at + 1] |= merged & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes(), starts[::CHECKPOINT]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every value of the next bits, and how many bits that are."""
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    bits = int(lengths.max())
    times = np.left_shift(1, bits - lengths[used])
    fill = (1 << bits) - int(times.sum())  # one id alone leaves half of the codes unused
    pad = np.zeros(fill, dtype=np.int64)
    return (
        np.concatenate([np.repeat(used, times), pad]).astype(np.uint32),
        np.concatenate([np.repeat(lengths[used], times), pad + 1]).astype(np.int64),
        bits,
    )


def decode_blocks(streams: list[tuple[bytes, np.ndarray, int]], table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Ids of several blocks, each (bits, checkpoints, number of ids), decoded from all checkpoints side by side."""
    symbols, sizes, bits = table
    words = np.concatenate([np.frombuffer(b, dtype=">u4").astype(np.uint64) for b, _, _ in streams])
    pairs = (words << np.uint64(32)) | np.append(words[1:], np.uint64(0))
    firsts = np.cumsum([0, *(len(b) // 4 for b, _, _ in streams)])
    at = np.concatenate([c + 32 * f for (_, c, _), f in zip(streams, firsts, strict=False)]).astype(np.int64)
    last = [n - (len(c) - 1) * CHECKPOINT for _, c, n in streams]
    counts = np.full(len(at), CHECKPOINT)
    counts[np.cumsum([len(c) for _, c, _ in streams]) - 1] = last
    order = np.argsort(-counts, kind="stable")
    at = at[order]
    active = np.searchsorted(-counts[order], -np.arange(int(counts.max())), side="left")
    out = np.zeros((len(at), int(counts.max())), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for step, n in enumerate(active):
        position = at[:n]
        value = (pairs[position >> 5] >> (64 - bits - (position & 31)).astype(np.uint64)) & mask
        index = value.astype(np.int64)
        out[:n, step] = symbols[index]
        at[:n] += sizes[index]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back][np.arange(out.shape[1])[None, :] < counts[:, None]]


# --- writing -------------------------------------------------------------------------------------------------------


def planes(ids: bytes) -> bytes:
    """The same ids with all first bytes first, then all second bytes and so on: compresses better."""
    return np.ascontiguousarray(np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(stored: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(stored, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The ids of ``docs`` (doc_id, text) in ascending doc_id order, in rows of whole documents with ``BLOCK_IDS`` ids or more.

    Segments are ranges in order; ``before`` counts the ids of the segment's earlier documents.
    """
    path = tokenizer or tokens.default_tokenizer()
    end = tokens.END_ID.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, segment, before = tokens.encoder(path), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def slab() -> pa.RecordBatch:
            row = [segment, before, doc_ids, [len(i) // 4 for i in ids], planes(b"".join(ids))]
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, SLAB_KINDS, strict=True)], names=SLAB_NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids.append(doc_id)
                ids.append(encoder.encode(text.as_py()) + end)
                held += len(ids[-1]) // 4
                if held >= BLOCK_IDS:
                    yield slab()
                    before, held, doc_ids, ids = before + held, 0, [], []
        if ids:
            yield slab()

    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    return (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(encode, ENCODED)
    )


def id_counts(staged: DataFrame) -> dict[int, int]:
    """Global counts of ids; at most one per entry of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for stored in batch.column(0):
                part = np.bincount(from_planes(stored.as_py()))
                total = np.pad(total, (0, max(0, len(part) - len(total))))
                total[: len(part)] += part
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    counted = staged.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in counted.collect()}


def block_rows(staged: DataFrame, lengths: np.ndarray) -> DataFrame:
    codes = canonical_codes(lengths)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                bits, checkpoints = encode_ids(from_planes(one.column(4)[0].as_py()), codes, lengths)
                coded = [pa.array([checkpoints.tolist()], pa.list_(pa.int64())), pa.array([bits], pa.binary())]
                yield pa.record_batch([*one.columns[:4], *coded], names=[*SLAB_NAMES[:4], "checkpoints", "bits"])

    return staged.mapInArrow(write, BLOCKS)


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Write the blocks to ``path``/blocks and the code lengths to ``path``/codes."""
    spark = docs.sparkSession
    staged_path = common.scratch_path(spark, "token-ids")
    encoded(docs, tokenizer).write.option("compression", "zstd").parquet(staged_path)
    staged = spark.read.schema(ENCODED).parquet(staged_path)
    counts = id_counts(staged)
    by_id = np.zeros(max(counts, default=0) + 1, dtype=np.int64)
    for token, n in counts.items():
        by_id[token] = n
    lengths = code_lengths(by_id)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, bits int").coalesce(
        1
    ).write.parquet(f"{path}/codes")
    block_rows(staged, lengths).write.option("compression", "none").parquet(f"{path}/blocks")
    drop_path(spark, staged_path)


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


# --- reading -------------------------------------------------------------------------------------------------------


def read_lengths(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id long, bits int").parquet(f"{path}/codes").collect()  # one per used id
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        lengths[r["id"]] = r["bits"]
    return lengths


def read_blocks(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: the ids before it in its segment, number of ids and crc32, and the ids if wanted."""
    lengths = read_lengths(spark, path)
    names = ["segment", "doc_id", "before", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or decode_table(lengths)
            for low in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                rows = batch.slice(low, BLOCKS_AT_ONCE).to_pylist()
                streams = [(r["bits"], np.array(r["checkpoints"]), sum(r["doc_lengths"])) for r in rows]
                ids, at, out = decode_blocks(streams, table).astype("<u4"), 0, []
                for r in rows:
                    before = r["before"]
                    for doc_id, n in zip(r["doc_ids"], r["doc_lengths"], strict=True):
                        part = ids[at : at + n].tobytes()
                        row = (r["segment"], doc_id, before, n, zlib.crc32(part))
                        out.append((*row, part) if with_ids else row)
                        at, before = at + n, before + n
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                columns = zip(zip(*out, strict=True), kinds, strict=False)
                yield pa.record_batch([pa.array(c, k) for c, k in columns], names=names)

    schema = DECODED + ", ids binary" * with_ids
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(decode, schema)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """All documents of written files, with ``start``: the number of ids of all documents before."""
    totals = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("segment").agg(
        F.sum(F.aggregate("doc_lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n")
    )
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)  # a row per segment
    bases = totals.select("segment", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return (
        read_blocks(spark, path, with_ids).join(bases, "segment")
        .withColumn("start", F.col("base") + F.col("before"))
        .select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
    )
