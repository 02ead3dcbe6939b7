"""Substring dedup by level-wise doubling: passages that an earlier document has too are removed, wherever they stand.

A window is ``words`` consecutive words of one document; each word that lies in a window which also starts in a document
of a smaller doc_id is removed.  The lengths of the levels double up to ``words`` (7, 13 for 13; 7, 13, 25, 50 for 50):

1. At the first length every window of ``words`` words is stood for by one short window inside it, the one of smallest
   hash.  Equal windows choose equal ones, so a window whose choice is in one document only is in one document only.
2. Windows that survive are extended to the next length, at most twice the last, and stood for by one of that length.
3. At the last length the windows themselves are compared; the document of smallest doc_id keeps its words.  Longer
   windows would cover no further word.  A level without survivors is followed by nothing.

Each level is one shuffle of (hash, document).  A task first compares its own documents, so a window sends one row per
task, however many documents have it; what is settled inside a task goes back to its document without a comparison.

Words are maximal runs of other characters than blanks, tabs and line ends, unchanged.  A text without words, null or
empty, has none to remove.  Null doc_ids come after all others, in the order of a hash of their texts.  Rows of one doc_id
take no words from each other, nor do equal texts without doc_id, so repeated rows are all judged alike.  At the last level
windows are told apart by 96 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm import common

WORDS, FIRST = 13, 7
#: Bytes of text that a task compares at once; a longer text is compared alone.
CHUNK_BYTES = 12_000_000
#: Bytes of words that are hashed at a time.
HASHED_BYTES = 1_000_000
#: Words of more bytes are hashed one by one, by a function without weaknesses on long periodic words.
LONG_WORD = 256

#: The bytes between words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False

DRAW = np.random.Generator(np.random.PCG64(5))
BYTE_VALUES = DRAW.integers(0, 2**64, 256, dtype=np.uint64)
#: Odd bases of the rolling hashes of bytes in a word, and of words in a window (two for the last level), with their inverses.
BASES = [int(b) | 1 for b in DRAW.integers(2**60, 2**63, 3)]
INVERSES = [pow(b, -1, 2**64) for b in BASES]
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: ``mark`` tells rows without doc_id apart and is 0 for all others.
OWNER = ["doc", "mark"]
KEYS = "hash long, hash2 long, doc long, mark long, settled binary"
KEYS_ARROW = pa.schema([*((n, pa.int64()) for n in ("hash", "hash2", *OWNER)), ("settled", pa.binary())])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX_A
    x = (x ^ (x >> np.uint64(29))) * MIX_B
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """Hashes of the stretches of ``values`` from each start to its end, all from one running sum."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(BASES[which], n), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(INVERSES[which], n + 1)[starts]


def levels(words: int) -> list[int]:
    """Lengths that at most double from one to the next and end at ``words``."""
    out = [words]
    while out[0] > FIRST:
        out.insert(0, -(-out[0] // 2))
    return out


class Texts:
    """Some texts as one array of bytes, and where their words are."""

    def __init__(self, column: pa.Array) -> None:
        column = column.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        self.bytes = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        inside = IS_WORD[self.bytes]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        #: Text k has the words from bounds[k] to bounds[k + 1].
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def word_hashes(self) -> np.ndarray:
        hashes = np.zeros(len(self.starts), dtype=np.uint64)
        low = 0
        while low < len(self.starts):
            begin = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, begin + HASHED_BYTES, "right")))
            values = BYTE_VALUES[self.bytes[begin : self.ends[high - 1]]]
            hashes[low:high] = rolling(values, self.starts[low:high] - begin, self.ends[low:high] - begin, 0)
            low = high
        for k in np.flatnonzero(self.ends - self.starts > LONG_WORD):
            digest = hashlib.blake2b(self.bytes[self.starts[k] : self.ends[k]].tobytes(), digest_size=8).digest()
            hashes[k] = np.frombuffer(digest, dtype=np.uint64)[0]
        return mix(hashes)


class Windows:
    """The windows of ``words`` words of some texts: ``at`` are their first words, ``text`` the texts they are in."""

    def __init__(self, texts: Texts, words: int) -> None:
        self.words, self.hashes = words, texts.word_hashes()
        counts = np.maximum(np.diff(texts.bounds) - words + 1, 0)
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.at = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts) + texts.bounds[self.text]
        #: Windows of text k are those from first[k] to first[k + 1].
        self.first = np.concatenate([[0], np.cumsum(counts)])

    def keys(self, length: int, which: int = 1) -> np.ndarray:
        """For each window the hash that stands for it at a level: the smallest of its windows of ``length`` words.

        Shorter lengths only rule windows out, for which 48 bits do; so do another 32 behind the first 64 of the last.
        """
        last = len(self.hashes) - length + 1
        if not len(self.at):
            return np.zeros(0, dtype=np.uint64)
        starts = np.arange(last)
        short = mix(rolling(self.hashes, starts, starts + length, which)) >> np.uint64(16 if length < self.words else 32 * (which - 1))
        smallest = short[self.at]
        for step in range(1, self.words - length + 1):
            np.minimum(smallest, short[self.at + step], out=smallest)
        return smallest


def rows_of(owners: np.ndarray, keys: np.ndarray, keys2: np.ndarray | None, text: np.ndarray, earliest: bool) -> pa.RecordBatch:
    """What a task says about its windows: their keys, the texts they are in, and per text (doc, mark).

    One row per key to compare with other tasks, with the document that wants to know; and per document the keys that
    are settled here.  ``earliest``: a key is settled for all but its smallest document, which alone wants to know.
    Otherwise it is settled for all its documents if there are several.
    """
    owners, number = np.unique(owners, axis=0, return_inverse=True)
    docs = number.reshape(-1)[text]
    keys2 = np.zeros(len(keys), dtype=np.uint64) if keys2 is None else keys2
    order = np.lexsort((docs, keys2, keys))
    keys, keys2, docs = keys[order], keys2[order], docs[order]
    new_key = np.ones(len(keys), dtype=bool)
    new_key[1:] = (keys[1:] != keys[:-1]) | (keys2[1:] != keys2[:-1])
    new_doc = new_key.copy()
    new_doc[1:] |= docs[1:] != docs[:-1]
    keys, keys2, docs, new_key = keys[new_doc], keys2[new_doc], docs[new_doc], new_key[new_doc]
    heads = np.flatnonzero(new_key)
    many = np.diff(np.append(heads, len(keys)))
    known, asks = (~new_key, many > 0) if earliest else (np.repeat(many > 1, many), many == 1)
    by_doc = np.argsort(docs[known], kind="stable")
    told, settled = docs[known][by_doc], keys[known][by_doc]
    begins = np.flatnonzero(np.diff(told, prepend=-1))
    ends = np.append(begins, len(told)).astype(np.int64) * settled.itemsize
    packs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(settled.tobytes())]
    ).cast(pa.binary())
    silent = np.concatenate([~asks, np.zeros(len(begins), dtype=bool)])
    speakers = owners[np.concatenate([docs[heads], told[begins]])]
    return pa.record_batch([
        pa.array(np.concatenate([keys[heads].view(np.int64), owners[told[begins], 0]])),
        pa.array(np.concatenate([keys2[heads].view(np.int64), owners[told[begins], 1]])),
        pa.array(speakers[:, 0], mask=silent), pa.array(speakers[:, 1], mask=silent),
        pa.concat_arrays([pa.nulls(len(heads), pa.binary()), packs]),
    ], schema=KEYS_ARROW)


def chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.Table]:
    """Rows in tables of about ``CHUNK_BYTES`` of text, or of one longer text."""
    held, size = [], 0
    for batch in batches:
        lengths = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = lengths[begin - 1] if begin else 0
            end = max(begin + (not held), int(np.searchsorted(lengths, before + CHUNK_BYTES - size, "right")))
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(lengths[end - 1] - before)
                begin = end
            if begin < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)


def survivors_of(answers: pa.Array, packs: pa.Array, windows: Windows, length: int) -> np.ndarray:
    """Which windows have a key that their document was told of at the level of ``length``."""
    keys, told = windows.keys(length), np.zeros(len(windows.at), dtype=bool)
    numbers = answers.cast(pa.large_list(pa.int64()))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(numbers).fill_null(0).to_numpy(zero_copy_only=False))])
    numbers = numbers.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    for k, packed in enumerate(packs.to_pylist()):
        low, high = windows.first[k], windows.first[k + 1]
        if low < high and (packed or ends[k + 1] > ends[k]):
            found = [numbers[ends[k] : ends[k + 1]], *(np.frombuffer(p, dtype=np.uint64) for p in packed or [])]
            told[low:high] = np.isin(keys[low:high], np.concatenate(found))
    return told


def compared(documents: DataFrame, words: int, length: int, before: int | None) -> DataFrame:
    """One level: (doc, mark, answers, packs), the keys of ``length`` words that several documents have; at the last level
    those that an earlier document has.  ``before`` is the length of the level whose answers the rows carry."""
    final = length == words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            windows = Windows(Texts(whole(table.column("text"))), words)
            keys, text = windows.keys(length), windows.text
            keys2 = windows.keys(length, 2) if final else None
            if before is not None:
                told = survivors_of(whole(table.column("answers")), whole(table.column("packs")), windows, before)
                keys, text, keys2 = keys[told], text[told], keys2[told] if final else None
            owners = np.column_stack([table.column(n).to_numpy() for n in OWNER])
            yield rows_of(owners, keys, keys2, text, final)

    # Shuffled before the window adds columns of its own to the rows.
    sent = documents.mapInArrow(run, KEYS).repartition("hash", "hash2")
    key = Window.partitionBy("hash", "hash2", F.col("settled").isNull())
    owner = F.struct(*OWNER)
    told = F.min(owner).over(key) < owner if final else F.count(F.lit(1)).over(key) > 1
    answered = sent.withColumn("told", F.col("settled").isNotNull() | told).filter(F.col("told") & F.col("doc").isNotNull())
    return answered.groupBy(*OWNER).agg(
        F.collect_set(F.when(F.col("settled").isNull(), F.col("hash"))).alias("answers"), F.collect_set("settled").alias("packs"),
    )


def kept_text(texts: Texts, k: int, removed: np.ndarray) -> bytes:
    """The words of text k that are not removed, joined by one space."""
    low, high = texts.bounds[k], texts.bounds[k + 1]
    kept = np.flatnonzero(~removed[low:high]) + low
    if not len(kept):
        return b""
    begin, end = texts.offsets[k], texts.offsets[k + 1]
    change = np.zeros(end - begin + 2, dtype=np.int8)
    np.add.at(change, texts.starts[kept] - begin, 1)
    np.add.at(change, texts.ends[kept] - begin + 1, -1)  # with the byte behind the word
    padded = np.append(texts.bytes[begin:end], np.uint8(0x20))
    chosen = padded[np.cumsum(change[:-1]) > 0]
    return np.where(IS_WORD[chosen], chosen, np.uint8(0x20)).tobytes()[:-1]


def owned(docs: DataFrame, doc: str = "doc", mark: str = "mark", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the columns by which a document is known and ordered."""
    known = F.col(doc_id).isNotNull()
    return docs.withColumn(doc, F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1))).withColumn(
        mark, F.when(known, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(1), F.col("text")))
    )


def passages(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc, mark, answers, packs) per document of ``docs`` (doc, mark, text and what else is to be shuffled with them) that
    loses words: the keys of its windows that an earlier one has."""
    lengths = levels(words)
    found = compared(docs.select(*OWNER, "text"), words, lengths[0], None)
    for before, length in zip(lengths, lengths[1:], strict=False):
        # In one order whatever the shuffle does, so that a task that is run again says the same.
        told = docs.join(found, OWNER).sortWithinPartitions(*OWNER, F.xxhash64("text"))
        found = compared(told, words, length, before)
    return found


def dedup(docs: DataFrame, words: int = WORDS, out: str = "passages") -> DataFrame:
    """``docs`` (doc_id, text and whatever else) with a struct column ``out``: n_words, n_removed, the kept words as a
    text, its digest, and the removed spans of words (starts and ends)."""
    # By place and not by name, as the table may have any; one frame for all joins, so that its rows are shuffled once.
    places = ["text" if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)]
    owners = owned(docs.withColumn("text", F.col("text").cast("string")).toDF(*places), doc_id=places[docs.columns.index("doc_id")])
    found = passages(owners, words).select(*OWNER, F.struct("answers", "packs").alias("lost"))
    rows = owners.join(found, OWNER, "left").select(*places, "lost")
    kind = "struct<n_words:bigint,n_removed:bigint,kept:string,kept_sha256:string,removed:array<bigint>>"
    schema = docs.withColumn(out, F.lit(None).cast(kind)).schema
    arrow = pa.struct([
        ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.int64())),
    ])
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            column = whole(table.column(text_at)).cast(pa.string())
            texts = Texts(column)
            windows = Windows(texts, words)
            told = survivors_of(*whole(table.column("lost")).flatten(), windows, words)
            change = np.zeros(len(texts.starts) + 1, dtype=np.int32)
            np.add.at(change, windows.at[told], 1)
            np.add.at(change, windows.at[told] + words, -1)
            removed = np.cumsum(change[:-1]) > 0
            made = []
            for k in range(len(column)):
                low, high = texts.bounds[k], texts.bounds[k + 1]
                kept, edges = kept_text(texts, k, removed), np.diff(np.concatenate([[0], removed[low:high].astype(np.int8), [0]]))
                made.append({
                    "n_words": high - low, "n_removed": int(removed[low:high].sum()), "kept": kept.decode(),
                    "kept_sha256": hashlib.sha256(kept).hexdigest(), "removed": np.flatnonzero(edges),
                })
            columns = [whole(c) for c in table.columns[:-1]]
            yield pa.record_batch([*columns, pa.array(made, arrow)], names=schema.names)

    return rows.mapInArrow(run, schema)


def verdicts(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document: words, removed words, digest of what is kept, and how many passages were removed."""
    found = dedup(docs.select("doc_id", "text"), words)
    p = F.col("passages")
    return found.select(
        "doc_id", p["n_words"].alias("n_words"), p["n_removed"].alias("n_removed"), p["kept_sha256"].alias("kept_sha256"),
        (F.size(p["removed"]) / 2).cast("long").alias("n_passages"),
    )


def oracle_sql(words: int = WORDS) -> str:
    return f"""
    WITH texts AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
    ),
    windows AS (
        SELECT doc_id, t.i AS i, array_to_string(words[t.i : t.i + {words - 1}], ' ') AS passage
        FROM texts, unnest(range(1, len(words) - {words - 2})) AS t(i)
    ),
    earliest AS (SELECT passage, min(doc_id) AS doc_id FROM windows GROUP BY passage),
    removed AS (
        SELECT DISTINCT w.doc_id, w.i + k.k AS place
        FROM windows w JOIN earliest e ON w.passage = e.passage AND e.doc_id < w.doc_id, range({words}) AS k(k)
    ),
    starts AS (
        SELECT doc_id, place, coalesce(place - lag(place) OVER (PARTITION BY doc_id ORDER BY place), 2) > 1 AS first FROM removed
    ),
    lost AS (SELECT doc_id, list(place) AS places, count(*) AS n, count(*) FILTER (WHERE first) AS n_passages FROM starts GROUP BY doc_id)
    SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(l.n, 0) AS BIGINT) AS n_removed,
           sha256(array_to_string(CASE WHEN l.n IS NULL THEN words ELSE
               list_filter(list_transform(range(1, len(words) + 1), lambda i: CASE WHEN list_contains(l.places, i) THEN NULL ELSE words[i] END),
                           lambda x: x IS NOT NULL) END, ' ')) AS kept_sha256,
           CAST(coalesce(l.n_passages, 0) AS BIGINT) AS n_passages
    FROM texts t LEFT JOIN lost l USING (doc_id)
    """
