"""Near duplicates: MinHash bands find candidates, full sets of word n-grams verify them.

1. Texts with the same set of n-grams are one class (texts without words: the same text), which its hash finds; copies
   cost one small row each from there on.
2. Each class has a signature; band and row counts are chosen for a recall at the similarity asked for.  Classes that
   share a band are tied to the smallest of the band, never to each other, and the ties' components hold all candidates.
3. Inside a component the pairs are verified on full n-gram sets.  Large components are cut into cells of like set size
   (a similarity of s needs sizes within a factor s) and the cells into blocks of bounded size; each pair of blocks is
   one piece of work, which returns for each class how many it is similar to and the smallest it is joined with.  No
   pair leaves that work, none is left out.
4. Classes joined by links form a group, named after its smallest doc_id.

N-grams are of ``SHINGLE_WORDS`` words; a text of fewer words, but not none, is one n-gram.  Words are runs of ASCII
digits, letters (A-Z lower-cased) and non-ASCII characters.  N-grams are told apart by 64-bit hashes, classes by 128 bits.
A null text counts as empty; null doc_ids come last as names of groups.  Repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm import common

RECALL, MOST_HASHES = 0.9995, 128
#: Classes and n-grams of a block.
BLOCK_CLASSES, BLOCK_GRAMS = 512, 400_000
#: Columns of an incidence matrix at a time.
COLUMNS = 4096

SKETCH = "doc_id long, text_hash long, class_key string, n_grams long, bands array<long>"

BASE, MIX_A, MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


# --- n-grams and signatures ----------------------------------------------------------------------------------------


def band_shape(similarity: float = common.SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band for which the recall at ``similarity`` needs at most ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows)))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"a recall of {recall} at {similarity} needs more than {most} hashes")
    return best


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class Grams:
    """Hashes of the word n-grams of texts, by wrapping polynomials over the bytes."""

    def __init__(self, words: int = common.SHINGLE_WORDS) -> None:
        self.words, self.powers, self.inverse = words, np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)
        self.step = np.power(MIX_A, np.arange(words, dtype=np.uint64))

    def grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, 2 * len(self.powers))
            self.powers, self.inverse = (
                np.cumprod(np.array([1, *[int(step)] * (size - 1)], dtype=np.uint64), dtype=np.uint64)
                for step in (BASE, pow(int(BASE), -1, 1 << 64))
            )

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; none for a text without words."""
        letters = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(common.WORD_BYTES), dtype=np.uint8)
        inside = np.concatenate([[False], letters != 0x20, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        self.grow(len(letters) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * self.powers[: len(letters)], dtype=np.uint64)])
        words = mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        n = max(1, len(words) - self.words + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for d in range(min(self.words, len(words))):
            grams += words[d : d + n] * self.step[d]
        return np.unique(mix(grams))


def class_key(grams: np.ndarray, text: str | None) -> str:
    if not len(grams):
        return hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16, person=b"no words").hexdigest()
    return hashlib.blake2b(grams.tobytes(), digest_size=16).hexdigest()


class Signer:
    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows = bands, rows
        draw = np.random.default_rng(20240229)
        self.times = draw.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = draw.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * BASE)
        self.step = np.power(MIX_B, np.arange(rows, dtype=np.uint64))

    def bands_of(self, grams: np.ndarray) -> np.ndarray:
        """A hash for each band; texts without n-grams have none."""
        if not len(grams):
            return np.zeros(0, dtype=np.int64)
        least = np.full(len(self.times), np.iinfo(np.uint64).max, dtype=np.uint64)
        for low in range(0, len(grams), 4096):
            hashes = grams[low : low + 4096, None] * self.times[None, :] + self.plus[None, :]
            np.minimum(least, hashes.min(axis=0), out=least)
        by_band = (mix(least).reshape(self.bands, self.rows) * self.step).sum(axis=1, dtype=np.uint64)
        return mix(by_band + self.salt).view(np.int64)


def sketched(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its class and the bands of its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, signer = Grams(words), Signer(bands, rows)
        for batch in batches:
            keys, sizes, found = [], [], []
            for text in batch.column(2).to_pylist():
                grams = grams_of.of(text)
                keys.append(class_key(grams, text))
                sizes.append(len(grams))
                found.append(signer.bands_of(grams))
            columns = [pa.array(keys), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), *columns], names=["doc_id", "text_hash", "class_key", "n_grams", "bands"]
            )

    return keyed(docs).select("doc_id", "text_hash", "text").mapInArrow(run, SKETCH)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )


# --- components ----------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b): nodes take the least of their neighbourhood as label, the
    graph is contracted to the labels, and so on until no edge is left.  Node ids should be hashes, so that rounds stay
    few whatever the shape.  Every round is written to the shared folder."""
    edges = common.stage(edges.filter("a <> b").distinct(), "edges")
    total: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"))
        near = common.stage(near, "labels")
        far = near.select(F.col("node").alias("label"), F.col("label").alias("farther"))
        labels = near.join(far, "label", "left").select("node", F.coalesce("farther", "label").alias("label"))
        labels = common.stage(labels, "labels")
        if total is None:
            total = labels.select("node", F.col("label").alias("component"))
        else:
            step = labels.select(F.col("node").alias("component"), "label")
            total = total.join(step, "component", "left").select("node", F.coalesce("label", "component").alias("component"))
        total = common.stage(total, "components")
        left, right = (labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
        edges = edges.join(left, "a").join(right, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
        edges = common.stage(edges.filter("a <> b").distinct(), "edges")
    if total is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return total


# --- verification --------------------------------------------------------------------------------------------------


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    _, inverse, counts = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    column = np.where(counts > 1, shared, -1)[inverse]
    row = np.repeat(np.arange(len(left) + len(right)), [len(g) for g in left + right])
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(shared[-1]) + 1 if len(shared) else 0, COLUMNS):
        begin, end = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(left) + len(right), COLUMNS), dtype=np.float32)
        part[row[begin:end], column[begin:end] - low] = 1
        out += np.rint(part[: len(left)] @ part[len(left) :].T).astype(np.int64)
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which left and right sets are at least so similar."""
    if len(left) == len(right) == 1:
        counts = np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    else:
        counts = common_counts(left, right)
    sizes = np.array([len(g) for g in left])[:, None] + np.array([len(g) for g in right])[None, :]
    return counts >= similarity * (sizes - counts) - 1e-9


def joined(links: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix, the first node of its component."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(axis=1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(rows: list[tuple[str, str, np.ndarray]], similarity: float) -> list[tuple[str, int, str]]:
    """(class, links, smallest class joined with) of one piece of work; rows: (class, side, n-grams).

    All pairs count if the side is "all", else those of a "left" and a "right" row.
    """
    rows = sorted({(key, side): (key, side, grams) for key, side, grams in rows}.values(), key=lambda r: r[:2])
    left, right = [r for r in rows if r[1] == "left"], [r for r in rows if r[1] != "left"]
    nodes = [r[0] for r in left + right]
    links = np.zeros((len(nodes), len(nodes)), dtype=bool)
    if rows[0][1] != "all":
        if not left or not right:
            return []
        found = linked([r[2] for r in left], [r[2] for r in right], similarity)
        links[: len(left), len(left) :] = found
        links[len(left) :, : len(left)] = found.T
    elif len(right) == 2:
        links[0, 1] = links[1, 0] = linked([right[0][2]], [right[1][2]], similarity)[0, 0]
    elif len(right) > 2:
        links = linked([r[2] for r in right], [r[2] for r in right], similarity)
        np.fill_diagonal(links, False)
    degrees, first = links.sum(axis=1), joined(links)
    return [(nodes[i], int(degrees[i]), nodes[first[i]]) for i in np.flatnonzero(degrees)]


def work(classes: DataFrame, similarity: float) -> DataFrame:
    """Per class of a candidate component: the pieces of work it belongs to, as (work, side).

    Sizes of sets so similar are a factor of 1 / similarity apart at most, which is the width of a cell.
    """
    # A hair more keeps rounding from parting a pair at the very limit.
    width = math.log(1 / similarity) * (1 + 1e-9)
    size_class = F.floor(F.log("n_grams") / width).cast("int")
    blocks = lambda n, grams: F.greatest(F.ceil(n / BLOCK_CLASSES), F.ceil(grams / BLOCK_GRAMS)).cast("int")
    cells = classes.groupBy("component", size_class.alias("cell")).agg(
        F.count("*").alias("n"), F.sum("n_grams").alias("grams")
    )
    by_component = cells.groupBy("component").agg(
        blocks(F.sum("n"), F.sum("grams")).alias("in_all"),
        F.map_from_entries(F.collect_list(F.struct("cell", blocks(F.col("n"), F.col("grams"))))).alias("in_cell"),
    )
    own = F.pmod(F.xxhash64("class_key"), F.element_at("in_cell", F.col("cell"))).cast("int")
    name = lambda a, i, b, j: F.concat_ws("/", F.col("component").cast("string"), a, i, b, j)

    def others(cell):  # pieces with the blocks of a cell, if there is such a cell
        n = F.coalesce(F.element_at("in_cell", cell), F.lit(0))
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    i, c = F.col("own"), F.col("cell")
    same = F.transform(others(c), lambda j: F.struct(name(c, F.least(i, j), c, F.greatest(i, j)).alias("work"), F.when(i < j, "left").when(i > j, "right").otherwise("all").alias("side")))
    after = F.transform(others(c + 1), lambda j: F.struct(name(c, i, c + 1, j).alias("work"), F.lit("left").alias("side")))
    before = F.transform(others(c - 1), lambda j: F.struct(name(c - 1, j, c, i).alias("work"), F.lit("right").alias("side")))
    whole = F.array(F.struct(F.col("component").cast("string").alias("work"), F.lit("all").alias("side")))
    return (
        classes.join(by_component, "component").withColumn("cell", size_class).withColumn("own", own)
        .withColumn("works", F.when(F.col("in_all") == 1, whole).otherwise(F.concat(same, after, before)))
        .select("class_key", "doc_id", "text_hash", "works")
    )


def verified(docs: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """(class_key, links, joined) of the classes that have links, a row for each piece of work."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of = Grams(words)
        for batch in batches:
            sets = [grams_of.of(text).tobytes() for text in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=["class_key", "works", "grams"]
            )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def results() -> pa.RecordBatch:
            found = list(zip(*compare(rows, similarity), strict=True)) or [(), (), ()]
            return pa.record_batch(
                [pa.array(found[0], pa.string()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.string())],
                names=["class_key", "links", "joined"],
            )

        for batch in batches:
            for name, side, key, stored in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if name != current:
                    if len(rows) > 1:
                        yield results()
                    current, rows = name, []
                rows.append((key, side, np.frombuffer(stored, dtype=np.uint64)))
        if len(rows) > 1:
            yield results()

    # Keys of plain equality; what a missing doc_id stands for does not matter beside the hash of the text.
    known = lambda df: df.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    sets = (
        known(work(classes, similarity)).join(known(keyed(docs)), ["doc_id", "text_hash"]).select("class_key", "works", "text")
        .mapInArrow(grams, "class_key string, works array<struct<work:string,side:string>>, grams binary")
    )
    return (
        sets.select(F.explode("works").alias("w"), "class_key", "grams")
        .select("w.work", "w.side", "class_key", "grams")
        .repartition("work").sortWithinPartitions("work")
        .mapInArrow(pairs, "class_key string, links long, joined string")
    )


# --- the join ------------------------------------------------------------------------------------------------------


def groups(docs: DataFrame, similarity: float = common.SIMILARITY, words: int = common.SHINGLE_WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): class_id, the smallest doc_id of its group; n_links, the number of other
    classes (different texts) at least so similar to its own; n_copies, the rows of its own class; and the key of its
    row (text_hash) and group."""
    docs = docs.select("doc_id", "text")
    bands, rows = band_shape(similarity)
    sketches = common.stage(sketched(docs, words, bands, rows), "sketches")
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    classes = common.stage(
        sketches.groupBy("class_key").agg(
            F.min(row).alias("first"), F.count("*").alias("n_copies"), F.max("n_grams").alias("n_grams"),
            F.first("bands").alias("bands"),
        ).select("class_key", "first", "n_copies", "n_grams", "bands", F.xxhash64("class_key").alias("node")),
        "classes",
    )
    banded = classes.select("node", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    ties = banded.join(leaders, "band").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    candidates = common.stage(
        classes.join(components(ties), "node").select(
            "class_key", F.col("first")["doc_id"].alias("doc_id"), F.col("first")["text_hash"].alias("text_hash"),
            "n_grams", "component",
        ),
        "candidates",
    )
    links = common.stage(verified(docs, candidates, words, similarity), "links")
    degree = links.groupBy("class_key").agg(F.sum("links").alias("n_links"))
    joined_with = components(links.select(F.col("class_key").alias("a"), F.col("joined").alias("b")))
    grouped = (
        classes.join(degree, "class_key", "left").join(joined_with.withColumnRenamed("node", "class_key"), "class_key", "left")
        .select("class_key", "first", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "class_key").alias("group"))
    )
    grouped = common.stage(grouped, "grouped")
    firsts = grouped.groupBy("group").agg(F.min("first").alias("group_first"))
    named = grouped.join(firsts, "group").select(
        "class_key", "group", "n_copies", "n_links", F.col("group_first")["doc_id"].alias("class_id"),
        F.col("group_first")["text_hash"].alias("first_hash"),
    )
    return sketches.select("doc_id", "text_hash", "class_key").join(named, "class_key")


def keep_one(docs: DataFrame, similarity: float = common.SIMILARITY, words: int = common.SHINGLE_WORDS) -> DataFrame:
    """One document of each group, the one of the smallest doc_id, with all its columns."""
    chosen = (
        groups(docs, similarity, words)
        .filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("first_hash")))
        .select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k_id"), F.col("text_hash").alias("k_hash")).distinct()
    )
    names = [common.fresh(n, docs.columns) for n in ("k_id", "k_hash", "k_row")]
    chosen = common.stage(chosen.toDF(*names[:2]), "kept")
    held = docs.withColumns({
        names[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), names[1]: F.xxhash64(F.col("text").cast("string")),
    })
    repeated = Window.partitionBy(*names[:2]).orderBy(names[0])
    return (
        held.join(chosen, names[:2]).withColumn(names[2], F.row_number().over(repeated)).filter(F.col(names[2]) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
