"""Best-fit packing of documents into sequences of a fixed capacity, by linear grouping.

The plan depends on the number of pieces of each length only, so at most ``capacity`` counts reach the driver however
many pieces there are.  Large lengths are split into groups of equal cardinality and rounded up to the largest of their
group; a linear program over the few rounded sizes, solved by column generation, says how often each configuration is
used.  Actual lengths then take the places of the rounded ones; large pieces that whole uses leave over are grouped and
solved again.  Small pieces, and the few large ones of the last round, are best-fitted by decreasing length into the room
that is free.  Equal lengths are interchangeable: a piece finds its place from its
length and its number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm import common, tokens

CAPACITY = 1024
GROUPS = 192
#: Rounds on what earlier ones left over have fewer groups, but not fewer than these.
FEWEST_GROUPS = 32
#: Pieces of at most this share of the capacity are small: they only fill the room that large ones leave.
SMALL_SHARE = 1 / 8
#: Share of the bins by which the linear program's solution may miss its optimum.
GAP = 1e-4
#: How far prices are drawn towards the best feasible ones, from 0 to below 1.
DRAWN = 0.8
#: Pieces numbered by one task at a time.
PIECES_PER_BUCKET = 50_000

Run = tuple[int, list[tuple[int, int]]]

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])
IDS = T.StructField("ids", T.BinaryType())


def cut(n_tokens: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: all but the first are full."""
    first = (n_tokens - 1) % capacity + 1
    yield 0, first
    for start in range(first, n_tokens, capacity):
        yield start, capacity


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): each document's ids and the end id, cut where longer than ``capacity``.

    A null or empty text is the end id alone.  ``with_ids`` adds the ids as little-endian unsigned 32-bit binary.
    Other columns of ``docs`` are not looked at; repeated rows give repeated pieces.
    """
    path = tokenizer or tokens.default_tokenizer()
    end = tokens.END_ID.to_bytes(4, "little")
    schema = T.StructType([*PIECES.fields, IDS]) if with_ids else PIECES

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = memoryview(encoder.encode(text.as_py()) + end)
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, number, start, length, zlib.crc32(part))
                    rows.append((*row, bytes(part)) if with_ids else row)
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=schema.names
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, schema)


# --- the plan, from the number of pieces of each length ---------------------------------------------------------


def grouped(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Lengths in decreasing order, dealt to groups of equal cardinality; a group is a list of [length, count]."""
    total = sum(counts.values())
    share = -(-total // groups) if total else 0
    out: list[list[list[int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append([])
                room = share
            take = min(left, room)
            out[-1].append([length, take])
            left, room = left - take, room - take
    return out


def dearest(size: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the highest price that fits (an unbounded knapsack over the room), ``size`` ascending."""
    fitting = np.searchsorted(size, np.arange(capacity + 1), "right")
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(size[0]), capacity + 1):
        n = fitting[room]
        values = prices[:n] + best[room - size[:n]]
        at = int(values.argmax())
        if values[at] > best[room - 1]:
            best[room], choice[room] = values[at], at
        else:
            best[room] = best[room - 1]
    column, room = np.zeros(len(size)), capacity
    while room >= size[0]:
        if choice[room] < 0:
            room -= 1
        else:
            column[choice[room]] += 1
            room -= int(size[choice[room]])
    return float(best[capacity]), column


def configurations(sizes: list[int], demands: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations of the rounded sizes and how often each is used, from the linear program of the fewest bins.

    Column generation: the basis starts with one size per configuration; a knapsack over prices finds the configuration
    to enter.  The prices asked are drawn towards the best feasible ones so far (at first each size's share of the
    capacity), which spares most of the steps that change nothing.  It ends when the bins used are within ``GAP`` of the
    bound that those prices prove.
    """
    order = np.argsort(sizes, kind="stable")
    size, demand = np.array(sizes)[order], np.array(demands, dtype=float)[order]
    inverse = np.diag(1 / (capacity // size))
    basis = np.diag((capacity // size).astype(float))
    feasible = size / capacity
    for turn in range(1, 100 * len(size)):
        used = inverse @ demand
        if used.sum() - feasible @ demand <= GAP * used.sum():
            break
        prices = inverse.sum(axis=0)
        value, column = dearest(size, DRAWN * feasible + (1 - DRAWN) * prices, capacity)
        asked = (DRAWN * feasible + (1 - DRAWN) * prices) / max(value, 1)
        if asked @ demand > feasible @ demand:
            feasible = asked
        if prices @ column <= 1 + 1e-9:
            value, column = dearest(size, prices, capacity)
            if value <= 1 + 1e-9:
                break
        step = inverse @ column
        ratios = np.where(step > 1e-9, np.maximum(used, 0) / np.where(step > 1e-9, step, 1), np.inf)
        leaving = int(ratios.argmin())
        basis[:, leaving] = column
        if turn % 64:
            row = inverse[leaving] / step[leaving]
            inverse = inverse - np.outer(step, row)
            inverse[leaving] = row
        else:  # from scratch, so that rounding errors do not pile up
            inverse = np.linalg.inv(basis)
    columns = np.zeros_like(basis)
    columns[order] = basis
    return list(zip(columns.T, np.linalg.inv(basis) @ demand, strict=True))


def take(queue: list[list[int]], n: int) -> list[list[int]]:
    """Remove the first n pieces of a queue of [length, count]."""
    out = []
    while n and queue:
        part = min(n, queue[0][1])
        out.append([queue[0][0], part])
        queue[0][1] -= part
        n -= part
        if not queue[0][1]:
            queue.pop(0)
    return out


def room_of(content: list[tuple[int, int]], capacity: int) -> int:
    return capacity - sum(length * times for length, times in content)


def configured(large: list[list[list[int]]], capacity: int) -> list[Run]:
    """Bins of the linear program's configurations, with actual lengths in the places of the rounded ones.

    What the configurations leave over stays in ``large``.
    """
    runs: list[Run] = []
    sizes, demands = [group[0][0] for group in large], [sum(n for _, n in group) for group in large]
    for column, share in configurations(sizes, demands, capacity):
        wanted = [g for g in range(len(large)) for _ in range(int(column[g]))]
        bins = min([int(share + 1e-6), *(sum(n for _, n in large[g]) // wanted.count(g) for g in set(wanted))])
        slots = [take(large[g], bins) for g in wanted]
        while bins and slots:
            equal = min(slot[0][1] for slot in slots)
            lengths = [slot[0][0] for slot in slots]
            runs.append((equal, [(length, lengths.count(length)) for length in sorted(set(lengths), reverse=True)]))
            for slot in slots:
                take(slot, equal)
            bins -= equal
    return runs


def best_fit(runs: list[Run], rest: dict[int, int], capacity: int) -> list[Run]:
    """Put the pieces of ``rest``, by decreasing length, where the least room is left that holds them."""
    free: dict[int, list[Run]] = {}
    done: list[Run] = []

    def keep(n: int, content: list[tuple[int, int]]) -> None:
        if n:
            room = room_of(content, capacity)
            (free.setdefault(room, []) if room else done).append((n, content))

    for run in runs:
        keep(*run)
    for length in sorted(rest, reverse=True):
        left = rest[length]
        while left:
            room = min((r for r in free if r >= length), default=0)
            if room:
                n, content = free[room].pop()
                if not free[room]:
                    del free[room]
            else:
                room, content = capacity, []
                n = -(-left // (capacity // length))
            each = room // length
            full = min(n, left // each)
            keep(full, [*content, (length, each)])
            left -= full * each
            if full < n and left:
                keep(1, [*content, (length, left)])
                full, left = full + 1, 0
            if content:
                keep(n - full, content)
    return done + [run for room in sorted(free) for run in free[room]]


def scheme(counts: dict[int, int], capacity: int, groups: int) -> tuple[list[Run], dict[int, int]]:
    """Bins of configurations for large lengths, and the pieces that are left: small ones, and large ones of the last round.

    A configuration is used a whole number of times, so each round leaves some large pieces; the next one groups and
    solves these alone, with half as many groups, until no configuration is used a whole time.
    """
    runs: list[Run] = []
    rest = dict(counts)
    while True:
        large = grouped({length: n for length, n in rest.items() if length > capacity * SMALL_SHARE and n}, groups)
        found = configured(large, capacity) if large else []
        if not found:
            return runs, {length: n for length, n in rest.items() if n}
        for bins, content in found:
            for length, times in content:
                rest[length] -= bins * times
        runs += found
        groups = max(FEWEST_GROUPS, groups // 2)


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs of equal bins: (number of bins, [(length, pieces of that length in each bin)])."""
    full = [(counts[capacity], [(capacity, 1)])] if counts.get(capacity) else []
    runs, rest = scheme({length: n for length, n in counts.items() if 0 < length < capacity and n}, capacity, groups)
    return full + best_fit(runs, rest, capacity)


def places(runs: list[Run]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first sequence, pieces of this length in each, offset) of each run's parts."""
    out, sequence, number = [], 0, {}
    for bins, content in runs:
        offset = 0
        for length, times in content:
            first = number.get(length, 0)
            number[length] = first + bins * times
            out.append((length, first, number[length], sequence, times, offset))
            offset += length * times
        sequence += bins
    return out


def numbered(staged: DataFrame) -> DataFrame:
    """Add ``number``, from 0 among the pieces of each length, without gathering a length in one task."""
    buckets = max(1, staged.count() // PIECES_PER_BUCKET)
    dealt = staged.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "bucket").agg(F.count("*").alias("in_bucket"))
        .select("length", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.join(bases, ["length", "bucket"])
        .withColumn("number", F.col("base") + F.row_number().over(inside) - 1)
        .drop("bucket", "base")
    )


def pack(staged: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces (see :func:`pieces`); nothing overlaps or leaves a gap.

    ``staged`` is read several times, so it should be a written table.  Empty input gives an empty result.
    """
    spark = staged.sparkSession
    counts = {r["length"]: r["n"] for r in staged.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = places(plan(counts, capacity, groups))
    schema = "at long, first long, end long, sequence long, times long, offset_in long"
    # At most a few places for each of the capacity's lengths and each configuration, whatever the number of pieces.
    where = F.broadcast(spark.createDataFrame(rows, schema))
    nth = F.col("number") - F.col("first")
    return (
        numbered(staged)
        .join(where, (F.col("length") == F.col("at")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("end")))
        .withColumn("sequence_id", F.col("sequence") + F.floor(nth / F.col("times")))
        .withColumn("offset", F.col("offset_in") + F.pmod(nth, F.col("times")) * F.col("length"))
        .select(*staged.columns, "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece with its place."""
    return pack(common.stage(pieces(docs, tokenizer, capacity), "pieces"), capacity)
