"""Benchmark decontamination with suffix arrays of the training documents.

Documents are dealt into shards of bounded size.  Each shard sorts its suffixes (sequences of word ids, to the depth of
a window; suffixes whose first words occur nowhere in the benchmark cannot match and are left out), every test suffix is
binary-searched in it, and the ranges found are the verbatim matches with their places.  Matches of consecutive suffixes
along one diagonal join into the longest ones; each hit span of a document keeps its longest, beside all items found.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window.  Words are runs
of ASCII digits, letters (A-Z lower-cased) and non-ASCII characters.  Null and empty texts have no words.  Items with
the same words are searched once.  The benchmark is processed in blocks of bounded size, so it may have any size.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common

WINDOW = 10
SHARD_WORDS = 2_000_000
#: Bytes of benchmark text that one pass over the documents takes.
BLOCK_BYTES = 16_000_000

FOUND = "struct<n_words:bigint,hits:array<bigint>,items:array<string>,matches:array<struct<start:bigint,length:bigint,item_id:string,item_start:bigint>>>"

MATCH = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64())])
FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("matches", pa.list_(MATCH)),
])


class Tests:
    """A block of benchmark items: their word ids, and each suffix of a window's depth, all as sorted arrays."""

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        by_words: dict[bytes, list[str]] = {}
        for item_id, text in items:
            words = common.words_of(text)
            ids = np.fromiter((number(w, len(self.vocabulary) + 1) for w in words), dtype=np.int32, count=len(words))
            if len(ids):
                by_words.setdefault(ids.tobytes(), []).append(item_id)
        self.names = list(by_words.values())
        self.labels = [min(names) for names in self.names]
        sizes = np.array([len(ids) // 4 for ids in by_words], dtype=np.int64)
        ends = np.zeros(4 * window, dtype=np.uint8).tobytes()
        padded = np.frombuffer(b"".join(part for ids in by_words for part in (ids, ends)), dtype=np.int32)
        suffixes = np.maximum(1, sizes - window + 1)
        item = np.repeat(np.arange(len(sizes)), suffixes)
        start = np.arange(len(item)) - np.repeat(np.cumsum(suffixes) - suffixes, suffixes)
        at = (np.cumsum(sizes + window) - sizes - window)[item] + start
        windows = np.lib.stride_tricks.sliding_window_view(padded, window) if len(at) else np.zeros((0, window), np.int32)
        rows = windows[at]
        keys, first, which, times = np.unique(sortable(rows), return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(which, kind="stable")
        self.item, self.start = item[order].astype(np.int32), start[order].astype(np.int32)
        self.bounds = np.concatenate([[0], np.cumsum(times)])
        self.lengths = np.minimum(window, sizes[item[first]])
        self.whole, self.short = np.flatnonzero(self.lengths == window), np.flatnonzero(self.lengths < window)
        self.keys = keys[self.whole]
        self.short_words = [rows[first[s], : self.lengths[s]] for s in self.short]
        begins = rows[first, :2]
        self.single = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        self.single[begins[self.lengths == 1, 0]] = True
        begins = begins[self.lengths > 1].astype(np.int64)
        self.pairs = np.unique((begins[:, 0] << 32) + begins[:, 1]) if window > 1 else np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        self.starts[self.pairs >> 32] = True

    def places(self, suffix: int) -> Iterator[tuple[int, int]]:
        """(item, first word) of every place where a suffix stands in the block."""
        low, high = self.bounds[suffix], self.bounds[suffix + 1]
        return zip(self.item[low:high].tolist(), self.start[low:high].tolist(), strict=True)


#: The block that this Python worker built last; the next task of the same block takes it from here.
BUILT: dict[str, Tests] = {}


def built(block: str, items: list[tuple[str, str | None]], window: int) -> Tests:
    if block not in BUILT:
        BUILT.clear()
        BUILT[block] = Tests(items, window)
    return BUILT[block]


def sortable(rows: np.ndarray) -> np.ndarray:
    """Rows of ids as byte strings of equal length: their order is the order of the rows."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").reshape(len(rows))


class Shard:
    """A suffix array over the word ids of some documents, which are kept apart by zeros."""

    def __init__(self, ids: np.ndarray, tests: Tests) -> None:
        padded = np.concatenate([ids, np.zeros(tests.window, dtype=ids.dtype)])
        first = np.flatnonzero(tests.starts[ids])
        pairs = (padded[first].astype(np.int64) << 32) + padded[first + 1]
        at = np.union1d(first[np.isin(pairs, tests.pairs)], np.flatnonzero(tests.single[ids]))
        keys = sortable(padded[at[:, None] + np.arange(tests.window)[None, :]])
        order = np.argsort(keys, kind="stable")
        self.at, self.keys = at[order], keys[order]

    def find(self, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
        """Every place where a test suffix occurs: numbers of suffixes, places."""
        low = [np.searchsorted(self.keys, tests.keys, "left")]
        high = [np.searchsorted(self.keys, tests.keys, "right")]
        for words in tests.short_words:  # from its bytes with zeros after them to its bytes with the greatest ids after them
            begin = words.astype(">u4").tobytes()
            rest = 4 * (tests.window - len(words))
            ends = np.array([begin, begin + b"\xff" * rest], dtype=self.keys.dtype)
            low.append(np.searchsorted(self.keys, ends[:1], "left"))
            high.append(np.searchsorted(self.keys, ends[1:], "right"))
        low, high = np.concatenate(low), np.concatenate(high)
        sizes = high - low
        suffixes = np.repeat(np.concatenate([tests.whole, tests.short]), sizes)
        inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return suffixes, self.at[np.repeat(low, sizes) + inside]


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def longest_by_span(hits: list[tuple[int, int]], tests: Tests) -> tuple[list[tuple[int, int]], set[int], list[tuple]]:
    """Hit spans, items, and the longest match (start, length, item, first word in it) of each span.

    ``hits`` are (suffix, place) by place.  Only the diagonals through the current place are held; of equally long
    matches the first in the document counts, then the smallest item and place in it.
    """
    spans: list[tuple[int, int]] = []
    matches: list[tuple] = []
    items: set[int] = set()
    alive: dict[tuple[int, int], int] = {}
    before = None
    for place, group in groupby(hits, key=lambda hit: hit[1]):
        going = alive if before == place - 1 else {}
        alive, before = {}, place
        end, best = place, None
        for suffix, _ in group:
            stop = place + int(tests.lengths[suffix])
            end = max(end, stop)
            for item, start in tests.places(suffix):
                items.add(item)
                begin = going.get((item, start), place)
                alive[item, start + 1] = begin
                if best is None or begin - stop <= best[0]:
                    match = (begin - stop, begin, tests.labels[item], start - (place - begin))
                    best = match if best is None else min(best, match)
        if spans and place <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            matches[-1] = min(matches[-1], best)
        else:
            spans.append((place, end))
            matches.append(best)
    return spans, items, [(begin, -less, label, start) for less, begin, label, start in matches]


def search(texts: list[str | None], tests: Tests) -> list[dict]:
    """What occurs in each of some documents, which together are one shard."""
    known = tests.vocabulary.get
    numbers, parts = [], []
    for text in texts:
        words = common.words_of(text)
        numbers.append(len(words))
        parts.append(np.fromiter(map(known, words, repeat(0)), dtype=np.int32, count=len(words)))
        parts.append(np.zeros(1, dtype=np.int32))
    found = [{"n_words": n, "hits": [], "items": [], "matches": []} for n in numbers]
    if not parts:
        return found
    ids = np.concatenate(parts)
    starts = np.cumsum([0, *(n + 1 for n in numbers)])
    suffixes, at = Shard(ids, tests).find(tests)
    docs = np.searchsorted(starts, at, "right") - 1
    order = np.lexsort((at, docs))
    by_doc: dict[int, list[tuple[int, int]]] = {}
    for doc, suffix, place in zip(docs[order].tolist(), suffixes[order].tolist(), (at - starts[docs])[order].tolist(), strict=True):
        by_doc.setdefault(doc, []).append((suffix, place))
    for doc, hits in by_doc.items():
        spans, items, matches = longest_by_span(hits, tests)
        found[doc]["hits"] = [x for span in spans for x in span]
        found[doc]["items"] = sorted({name for item in items for name in tests.names[item]})
        found[doc]["matches"] = [dict(zip(MATCH.names, match, strict=True)) for match in matches]
    return found


def merged(first: dict, second: dict) -> dict:
    """Findings of the same document in two blocks of the benchmark."""
    hits = [list(zip(f["hits"][0::2], f["hits"][1::2], strict=True)) for f in (first, second)]
    spans = union_of(hits[0] + hits[1])
    begins = [begin for begin, _ in spans]
    best: dict[int, dict] = {}
    for match in sorted(
        first["matches"] + second["matches"], key=lambda m: (-m["length"], m["start"], m["item_id"], m["item_start"])
    ):
        best.setdefault(bisect_right(begins, match["start"]), match)
    return {
        "n_words": second["n_words"],
        "hits": [x for span in spans for x in span],
        "items": sorted({*first["items"], *second["items"]}),
        "matches": [best[span] for span in sorted(best)],
    }


def test_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The different items (item_id as text, text) in blocks of about ``block_bytes``, one at a time on the driver."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string")).distinct()
    # Written, so that repeated rows are removed once and not for the total and every block.
    items = common.stage(items, "benchmark")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [(r["item_id"], r["text"]) for r in chosen.collect()]


def search_documents(docs: DataFrame, items: list, found: str, window: int, shard_words: int, again: bool) -> DataFrame:
    """``docs`` (text and whatever else) with the struct column ``found``; ``again`` merges it with an earlier block's."""
    schema = docs.schema if again else docs.withColumn(found, F.lit(None).cast(FOUND)).schema
    names, out_names = docs.columns, schema.names
    text_at, block = names.index("text"), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests, held, size = built(block, items, window), [], 0

        def shard() -> Iterator[pa.RecordBatch]:
            results = iter(search([t for batch in held for t in batch.column(text_at).to_pylist()], tests))
            for batch in held:
                new = [next(results) for _ in range(batch.num_rows)]
                columns = dict(zip(names, batch.columns, strict=True))
                if again:
                    new = [merged(old, n) for old, n in zip(columns[found].to_pylist(), new, strict=True)]
                columns[found] = pa.array(new, FOUND_ARROW)
                yield pa.record_batch(list(columns.values()), names=out_names)
            held.clear()

        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                held.append(batch)
                size += sum(map(len, filter(None, batch.column(text_at).to_pylist()))) // 5
                if size >= shard_words:
                    yield from shard()
                    size = 0
        yield from shard()

    return docs.mapInArrow(run, schema)


def findings(
    docs: DataFrame, benchmark: DataFrame, found: str, window: int = WINDOW, shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``found``: number of words, hit spans of words (starts and ends), items, and
    the longest match of each span.

    One pass over the documents for each block of the benchmark; later passes start from the written earlier one.
    """
    again = False
    for items in test_blocks(benchmark, block_bytes):
        docs = search_documents(common.stage(docs, "hits") if again else docs, items, found, window, shard_words, again)
        again = True
    return docs


def verdicts(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """Per document: words, hit words, items found, the length of the longest match, and the longest of each hit span."""
    f = F.col("found")
    # Starts and ends alternate: x - a over an even number of them is the sum of ends less the sum of starts.
    n_hit = F.aggregate(f["hits"], F.lit(0).cast("long"), lambda a, x: x - a)
    return findings(docs.select("doc_id", F.col("text").cast("string").alias("text")), benchmark, "found", **options).select(
        "doc_id", f["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", f["items"]), 256).alias("items_sha256"),
        (F.size(f["hits"]) > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform(f["matches"], lambda m: m["length"])), F.lit(0)).alias("longest"),
        f["matches"].alias("matches"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    found = common.fresh("found", docs.columns)
    kept = findings(docs, benchmark, found, **options).filter(F.size(F.col(found)["hits"]) == 0)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
