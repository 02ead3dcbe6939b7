"""Spelling variants: words that one inserted, deleted or replaced letter makes alike, found by permuterm rotations.

1. Words and their counts.  To have misspellings to find, a fixed share of the runs of each document loses one letter.
2. A word gets a terminator and is rotated to every place.  A rotation that ends in a letter stands, without it, for the
   word with that letter open: ``hallo`` and ``hello`` share ``llo$h``.  The whole rotation of a word without the letter is
   the same string, so ``hllo`` lies there too.  Sorted, rotations that agree but for the edited letter are one range.
3. The ranges are scanned.  Each word of a range hears how many neighbours it has there and which is the most frequent; a
   range holds at most one word per letter and one without, but no pairs are made of them.  An insertion beside equal
   letters counts at the first of them only, so every pair of neighbours meets once.
4. A word's form is its most frequent neighbour, if that is at least ``TIMES`` as frequent; forms are followed to the
   root by doubling steps, of which there are few, as counts double from word to form.

Null and empty texts have no words; a null doc_id counts as empty.  Repeated rows count as often as they stand there.
Rotations of more than ``LONG`` letters are told apart by a 127-bit digest instead of being written out, and such words
go by their first letters and a number, so a long run without blanks costs work in proportion to its length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm import common

LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A form is at least this many times as frequent as its variant.
TIMES = 2
#: One of this many runs loses a letter.
ALTERED = 97
LONG = 64
#: Different (word, count) pairs that a task holds before it hands them on.
HELD = 200_000

#: Letters of words, and the mark of a word's end, which is none of them.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
END = "$"

MODULUS, BASE = 2**127 - 1, 0x5DEECE66D1CE4E5B9BF58476D1CE4E5
#: What a row of the rotations says of its word: it is whole here; a letter is open, which has no equal letter before it;
#: or which has one.
WHOLE, OPEN, OPEN_AGAIN = 0, 1, 2

ROTATIONS = "key string, word string, n long, role int"
HEARD = "word string, n_near long, best_n long, best string"


# --- words -----------------------------------------------------------------------------------------------------------


def altered(prefix_crc: int, run: str) -> str:
    """The run, or for one in ``ALTERED`` of (document, run) the run without one letter."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % ALTERED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_count: int = LEAST_COUNT, alter: bool = True) -> DataFrame:
    """(word, n): words of ``docs`` (doc_id, text) with at least ``LEAST_LETTERS`` letters, by occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                prefix = zlib.crc32(f"{doc.as_py()}:".encode())
                for found, n in Counter(RUN.findall(text.as_py().translate(LOWER))).items():
                    word = altered(prefix, found) if alter else found
                    if len(word) >= LEAST_LETTERS:
                        held[word] += n
                if len(held) >= HELD:
                    yield pa.record_batch([pa.array(held), pa.array(held.values(), pa.int64())], names=["word", "n"])
                    held = Counter()
        yield pa.record_batch([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.filter("text is not null").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def named(words: DataFrame) -> DataFrame:
    """(name, word, n): words by a short name in the same order as themselves; it is the word unless that is long."""
    place = F.row_number().over(Window.partitionBy(F.substring("word", 1, LONG)).orderBy("word"))
    long = words.filter(F.char_length("word") > LONG).select(
        F.concat(F.substring("word", 1, LONG), F.lit("#"), F.lpad(place.cast("string"), 12, "0")).alias("name"), "word", "n"
    )
    return words.filter(F.char_length("word") <= LONG).select(F.col("word").alias("name"), "word", "n").unionByName(long)


# --- rotations -------------------------------------------------------------------------------------------------------


class Digests:
    """Digests of the rotations of one long word, each from two running sums."""

    def __init__(self, word: str) -> None:
        self.sums, self.powers = [0], [1]
        for c in word:
            self.sums.append((self.sums[-1] * BASE + ord(c)) % MODULUS)
            self.powers.append(self.powers[-1] * BASE % MODULUS)

    def rotation(self, begin: int, end: int) -> str:
        """Of the letters from ``begin`` on, the terminator and the letters before ``end``."""
        last = len(self.sums) - 1
        behind = (self.sums[last] - self.sums[begin] * self.powers[last - begin]) % MODULUS
        return f"#{((behind * BASE + ord(END)) * self.powers[end] + self.sums[end]) % MODULUS:032x}"


def rotations(word: str) -> Iterator[tuple[str, int]]:
    """(key, role): the rotation at every place, whole, and without the letter before it, which is then open."""
    digests = Digests(word) if len(word) >= LONG else None
    for at in range(len(word) + 1):
        yield word[at:] + END + word[:at] if len(word) <= LONG else digests.rotation(at, at), WHOLE
    for at, letter in enumerate(word):
        key = word[at + 1 :] + END + word[:at] if len(word) - 1 <= LONG else digests.rotation(at + 1, at)
        yield key, OPEN_AGAIN if at and word[at - 1] == letter else OPEN


def heard(group: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, neighbours here, count of the most frequent, that one) for a range of (word, n, role)."""
    order = lambda m: (-m[1], m[0])
    whole = [m for m in group if m[2] == WHOLE]
    opened = sorted((m for m in group if m[2] != WHOLE), key=order)
    first = [m for m in opened if m[2] == OPEN]
    for m in whole:
        if first:
            yield m[0], len(first), first[0][1], first[0][0]
    for m in opened:
        others = opened[:2] if m is not opened[0] else opened[1:2]
        near = [o for o in others if o is not m] + (whole if m[2] == OPEN else [])
        if near:
            best = min(near, key=order)
            yield m[0], len(opened) - 1 + (len(whole) if m[2] == OPEN else 0), best[1], best[0]


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


ROTATIONS_ARROW = pa.schema([("key", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("role", pa.int32())])
HEARD_ARROW = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def rotated(words: DataFrame) -> DataFrame:
    """Every row of the rotations of ``words`` (name, word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (key, name, n, role)
            for batch in batches
            for name, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for key, role in rotations(word)
        )
        return batches_of(rows, ROTATIONS_ARROW)

    return words.select("name", "word", "n").mapInArrow(run, ROTATIONS)


def neighbours(words: DataFrame) -> DataFrame:
    """(name, n_near, best_n, best) of every word that has a neighbour, from the sorted rotations."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        ranges = (list(group) for _, group in groupby(rows, key=lambda row: row[0]))
        found = (h for group in ranges if len(group) > 1 for h in heard([row[1:] for row in group]))
        return batches_of(found, HEARD_ARROW)

    by_key = rotated(words).repartition("key").sortWithinPartitions("key")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("name")))
    return by_key.mapInArrow(scan, HEARD).groupBy(F.col("word").alias("name")).agg(
        F.sum("n_near").alias("n_near"), best.alias("best")
    ).select("name", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.name").alias("best"))


# --- forms and roots -------------------------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(name, root) for ``forms`` (name, form): the last of the forms that follow each other.  Every round doubles the steps
    taken; it is over when nothing moves, after about the binary logarithm of the longest chain."""
    reached = common.stage(forms.select("name", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("name").alias("root"), F.col("root").alias("next"))
        moved = common.stage(reached.join(further, "root", "left").select("name", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = moved.select("name", "root")
        if moved.filter("moved").isEmpty():
            return reached


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, alter: bool = True) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``docs``."""
    words = common.stage(word_counts(docs, least_count, alter), "words")
    long = not words.filter(F.char_length("word") > LONG).isEmpty()
    words = common.stage(named(words), "names") if long else words.select(F.col("word").alias("name"), "word", "n")
    near = words.select("name", "word", "n").join(neighbours(words), "name", "left")
    has_form = F.col("best_n") >= TIMES * F.col("n")
    judged = common.stage(near.select(
        "name", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n"),
    ), "forms")
    rooted = roots(judged.filter("form is not null").select("name", "form"))
    out = judged.join(rooted, "name", "left").withColumn("root", F.coalesce("root", "name"))
    if not long:
        return out.select("word", "form", "root", "n", "n_near", "form_n")
    return spelled_out(spelled_out(out, words, "form"), words, "root").select("word", "form", "root", "n", "n_near", "form_n")


def spelled_out(rows: DataFrame, words: DataFrame, column: str) -> DataFrame:
    """``rows`` with the words of the names in ``column``; only names of long words are looked up."""
    long = words.filter(F.char_length("word") > LONG).select(F.col("name").alias(column), F.col("word").alias("full"))
    return rows.join(long, column, "left").withColumn(column, F.coalesce("full", column)).drop("full")


def oracle_sql() -> str:
    """The same by counting pairs; the checksum is computed bit by bit."""
    upper, lower = ("".join(map(chr, letters)) for letters in (LOWER.keys(), LOWER.values()))
    return f"""
    WITH RECURSIVE runs AS (
        SELECT id, translate(run, '{upper}', '{lower}') AS run, count(*) AS n
        FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '{RUN.pattern}')) AS run FROM documents)
        GROUP BY ALL
    ),
    coded AS (
        SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128
            THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes FROM runs
    ),
    hashed AS (
        SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST(bytes AS BIGINT[])), lambda h, b: xor(h >> 8,
            list_reduce(list_prepend(xor(h, b) & 255, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))) AS h FROM coded
    ),
    words AS (
        SELECT CASE WHEN h % {ALTERED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
               CAST(sum(n) AS BIGINT) AS n
        FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LETTERS} AND sum(n) >= {LEAST_COUNT}
    ),
    opened AS (
        SELECT word, substr(word, 1, t.i - 1) || '{END}' || substr(word, t.i + 1) AS key FROM words, unnest(range(1, length(word) + 1)) AS t(i)
    ),
    shorter AS (SELECT DISTINCT o.word, w.word AS other FROM opened o JOIN words w ON w.word = replace(o.key, '{END}', '')),
    pairs AS (
        SELECT a.word, b.word AS other FROM opened a JOIN opened b ON a.key = b.key AND a.word <> b.word
        UNION ALL SELECT word, other FROM shorter UNION ALL SELECT other, word FROM shorter
    ),
    near AS (
        SELECT p.word, p.other, w.n, count(*) OVER (PARTITION BY p.word) AS n_near,
               row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.other) AS place
        FROM pairs p JOIN words w ON w.word = p.other
    ),
    forms AS (
        SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= {TIMES} * w.n THEN b.other END AS form,
               CASE WHEN b.n >= {TIMES} * w.n THEN b.n END AS form_n
        FROM words w LEFT JOIN near b ON b.word = w.word AND b.place = 1
    ),
    chain(word, root, step) AS (
        SELECT word, word, 0 FROM forms
        UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
    )
    SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
    FROM forms f JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) c ON c.word = f.word
    """
