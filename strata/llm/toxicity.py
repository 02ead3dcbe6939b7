"""Toxicity: gradient-boosted trees over dense features of a whole text, calibrated by isotonic regression.

Features are densities of fixed and of learned lexicon words, as written and after undoing obfuscation, how near they
stand to words of the second person, and the rates of capitals, punctuation and obfuscated words.  Trees and calibration
learn from labelled documents only, at most about ``LABELLED`` of them; the label, language, source and id of a document
are no features.  One fifth of the labelled documents, by crc32 of doc_id, is held out of all learning, and of the others
every fourth is kept from the trees for the calibration.

Null and empty texts have features of zero and a score like any other.  Without labels of both kinds every score is the
share of toxic labels.  Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common

#: Labelled documents to learn from, about; trees, their depth and rate; weight of the margin that orders equal scores.
LABELLED, TREES, DEPTH, RATE, TIE_WEIGHT = 20_000, 20, 3, 0.2, 0.001
#: Learned lexicon, of word beginnings of so many bytes: most entries, least share of the toxic documents with one,
#: least ratio of its shares in toxic and in other documents.
STEM_BYTES = range(3, 13)
LEARNED_STEMS, LEARNED_SHARE, LEARNED_RATIO = 500, 0.02, 12.0
#: Words between a lexicon word and one of the second person that still count as near.
NEAR = 5

#: Insults, threats and slurs-free profanity in the languages met most.
LEXICON = frozenset(
    b"idiot idiots moron morons stupid dumb loser losers pathetic worthless trash garbage scum clown disgusting ugly hate "
    b"fool fools imbecile dumbass bastard bitch asshole crap shit fuck fucking damn jerk creep freak pig filth filthy vermin "
    b"parasite coward liar die kill dummkopf trottel depp arschloch scheisse abschaum versager widerlich connard salaud "
    b"imb\xc3\xa9cile ordure d\xc3\xa9bile abruti merde nul pourri minable idiota est\xc3\xbapido est\xc3\xbapida imb\xc3\xa9cil basura "
    b"mierda cabr\xc3\xb3n pendejo asqueroso in\xc3\xbatil".split()
)
#: Words of the second person.
SECOND_PERSON = frozenset(
    b"you your yours yourself youre u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre usted ustedes tuyo".split()
)

UPPER = bytes(range(0x41, 0x5B))
LETTERS = UPPER + UPPER.lower()
MARKS = b".,;:?-'\"()"
SYMBOLS = b"#$%&*@^~|<>_=+/\\"
#: A word with digits or marks between its letters, and letters set apart.
MIXED = re.compile(rb"[A-Za-z]+(?:[0-9@$!*.\-_]+[A-Za-z]+)+")
APART = re.compile(rb"(?<![A-Za-z])(?:[A-Za-z][ .\-_*]){3,}[A-Za-z](?![A-Za-z])")
PLAIN = bytes.maketrans(b"0134578@$!", b"oieastbasi")
DROPPED = b"*.-_ "

FEATURES = (
    "fixed", "learned", "fixed_plain", "learned_plain", "near_second_person", "second_person", "capitals", "shouts",
    "marks", "symbols", "digits", "mixed", "apart", "distinct", "log_words", "any_fixed", "any_learned",
)


def plain(word: bytes) -> bytes:
    """A word without obfuscation: look-alike digits and marks replaced, separators and repeated letters dropped."""
    return re.sub(rb"(.)\1{2,}", rb"\1", word.translate(PLAIN, DROPPED).lower())


def stems(word: bytes) -> list[bytes]:
    return [word[:n] for n in STEM_BYTES if n <= len(word)]


class Lexicon:
    """Learned beginnings of words."""

    def __init__(self, entries: frozenset[bytes]) -> None:
        self.entries, self.sizes = entries, sorted({len(e) for e in entries})

    def __contains__(self, word: bytes) -> bool:
        return any(word[:n] in self.entries for n in self.sizes)


def features(text: str | None, learned: Lexicon) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(common.WORD_BYTES).split()
    n, size = max(1, len(words)), max(1, len(raw))
    known = set(words)
    hits = {w for w in known if w in LEXICON or w in learned}
    fixed = learnt = near = 0
    if hits:
        places = [i for i, w in enumerate(words) if w in hits]
        fixed = sum(words[i] in LEXICON for i in places)
        learnt = sum(words[i] in learned for i in places)
        near = sum(any(w in SECOND_PERSON for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in places)
    mixed, apart = MIXED.findall(raw), APART.findall(raw)
    undone = [plain(w) for w in mixed + apart]
    count = lambda marks: (len(raw) - len(raw.translate(None, marks))) / size
    return [
        100 * fixed / n, 100 * learnt / n,
        100 * sum(w in LEXICON for w in undone) / n, 100 * sum(w in learned for w in undone) / n,
        near / max(1, fixed + learnt), 100 * sum(map(words.count, known & SECOND_PERSON)) / n,
        count(UPPER), count(b"!"), count(MARKS), count(SYMBOLS), count(b"0123456789"),
        100 * len(mixed) / n, 100 * len(apart) / n, len(known) / n, math.log1p(len(words)),
        float(fixed + sum(w in LEXICON for w in undone)), float(learnt + sum(w in learned for w in undone)),
    ]


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 5; documents of remainder 0 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, fold) of the labels to learn from: all, or by hash of doc_id about ``LABELLED`` of them.

    Of labels of one document that disagree the majority counts; where they are even, it is not learned from.
    """
    marks = labels.select("doc_id", F.col("toxic").cast("double").alias("toxic")).dropna().groupBy("doc_id").agg(F.avg("toxic").alias("toxic"))
    usable = marks.filter(F.col("toxic") != 0.5).withColumn("toxic", (F.col("toxic") > 0.5).cast("double"))
    usable = usable.filter(remainder(F.col("doc_id")) != 0)
    share = LABELLED / max(LABELLED, usable.count())
    drawn = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) < int(share * (1 << 30))
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(4))
    return common.stage(usable.filter(drawn).withColumn("fold", fold), "toxic-labels")


def stem_counts(texts: DataFrame, among: frozenset[bytes] | None = None) -> DataFrame:
    """(stem, n): documents of ``texts`` with each stem, or with each of some; the empty stem is in all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = {s for word in set(common.words_of(text)) for s in stems(word)}
                counts.update({*(found if among is None else found & among), b""})
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        yield pa.record_batch(columns, names=["stem", "n"])

    return texts.select("text").mapInArrow(count, "stem binary, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def learned_lexicon(texts: DataFrame) -> Lexicon:
    """Word beginnings that many toxic and few other documents of (text, toxic) hold.

    The driver gets those of a least share of the toxic documents: no more than a document's stems divided by that share.
    """
    counts = common.stage(stem_counts(texts.filter("toxic = 1")), "toxic-stems")
    n_toxic = counts.filter(F.length("stem") == 0).first()
    if n_toxic is None:
        return Lexicon(frozenset())
    often = counts.filter(F.col("n") >= max(5, LEARNED_SHARE * n_toxic["n"])).collect()
    toxic = {bytes(r["stem"]): r["n"] for r in often}
    other = {bytes(r["stem"]): r["n"] for r in stem_counts(texts.filter("toxic = 0"), frozenset(toxic)).collect()}
    n_other = other.get(b"", 0)
    ratios = {s: (n / n_toxic["n"]) / ((other.get(s, 0) + 1) / (n_other + 1)) for s, n in toxic.items() if s}
    best = sorted((s for s, r in ratios.items() if r >= LEARNED_RATIO), key=lambda s: (-toxic[s], s))
    shortest = [s for s in best if not any(s[:n] in ratios and ratios[s[:n]] >= LEARNED_RATIO for n in STEM_BYTES if n < len(s))]
    return Lexicon(frozenset(shortest[:LEARNED_STEMS]))


def measured(docs: DataFrame, learned: Lexicon) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text, learned) for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, features array<double>"
    )


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, score and predicted, as ``labels`` (doc_id, toxic) mark toxicity."""
    chosen = labelled(docs, labels)
    # At most about LABELLED rows of two numbers, whatever the corpus.
    known = common.stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxic-known")
    learned = learned_lexicon(known.filter("fold > 0").select("text", "toxic"))
    staged = common.stage(measured(docs, learned), "toxic-features")
    vectors = staged.withColumn("vector", array_to_vector("features"))
    learn = common.stage(staged.join(F.broadcast(chosen), "doc_id"), "toxic-learn").withColumn("vector", array_to_vector("features"))
    classes = {(r["toxic"], r["fold"] > 0): r["n"] for r in learn.groupBy("toxic", (F.col("fold") > 0).alias("fold")).agg(F.count("*").alias("n")).collect()}
    if all(classes.get((label, trees)) for label in (0.0, 1.0) for trees in (False, True)):
        trees = GBTClassifier(
            featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=7, predictionCol="tree_class"
        ).fit(learn.filter("fold > 0"))
        margin = vector_to_array("probability")[1]
        held = trees.transform(learn.filter("fold = 0")).withColumn("margin", margin)
        steps = IsotonicRegression(featuresCol="margin", labelCol="toxic", predictionCol="calibrated").fit(held)
        scored = steps.transform(trees.transform(vectors).withColumn("margin", margin))
        score = (1 - TIE_WEIGHT) * F.col("calibrated") + TIE_WEIGHT * F.col("margin")
    else:
        total = sum(classes.values())
        scored, score = staged, F.lit(sum(n for (label, _), n in classes.items() if label) / total if total else 0.0)
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
