"""Every operator against a brute-force version, an exact round trip or held-out accuracy, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (
    common, contamination, huffman, licenses, main_text, near_duplicates, packing, personal_data, quality, tokens, toxicity,
    url_filter,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(draw, n):
    return " ".join("".join(draw.choices(["ka", "lo", "mi", "é", "ne", "ru", "Sa"], k=draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    base = prose(draw, 60)
    near = base.replace(base.split()[30], "other", 1)
    return [
        None, "", " ", "\n \t", "!!!", "one", base, base, base.upper(), near, base + " tail", prose(draw, 20_000),
        "same line here\n" * 12, "a b c d e a b c d e x", "\x1c odd\u00a0space  double ", "mail me at jo.doe@mail.example.com or +1 (415) 555-2671",
        "host 10.0.0.1, card 4539 1488 0343 6467!", "<|endoftext|> # $ %",
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[6], (None, "no id at all", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df, *names):
    """The table with more columns, named like those that operators make."""
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df


def whole_ids(text):
    return tokens.encoder(tokens.default_tokenizer()).tokenizer.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# --- tokens and packing ----------------------------------------------------------------------------------------


def test_ids_are_those_of_the_whole_text(texts):
    draw = random.Random(1)
    odd = ["".join(draw.choices(" \n'\t.,ab é1#sS|\x1c\x85漢ʰ", k=draw.randint(0, 30))) for _ in range(2000)]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    for text in [*texts, *odd]:
        assert list(np.frombuffer(encoder.encode(text), dtype="<u4")) == whole_ids(text)[:-1]


def test_added_tokens_are_those_of_the_file_as_loaded(texts):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(tokens.default_tokenizer())
    encoder = tokens.Encoder(tokens.default_tokenizer())
    end, draw = "<|endoftext|>", random.Random(2)
    odd = ["".join(draw.choices([end, " ", "\n", "ab", ".", "é", "<|", "|>", "endoftext"], k=draw.randint(0, 12))) for _ in range(2000)]
    assert list(np.frombuffer(encoder.encode(f"x {end} y"), dtype="<u4")) == [87, 220, 50256, 331]
    for text in [*texts, *odd, end, end * 3, f" {end} \n{end}", f"a{end} b {end}"]:
        assert list(np.frombuffer(encoder.encode(text), dtype="<u4")) == loaded.encode(text or "", add_special_tokens=False).ids, text


def test_cuts():
    for n in (1, 2, 9, 10, 11, 20, 25):
        parts = list(packing.cut(n, 10))
        assert sum(length for _, length in parts) == n and all(length == 10 for _, length in parts[1:])
        assert [s for s, _ in parts] == [sum(length for _, length in parts[:i]) for i in range(len(parts))]


@pytest.mark.parametrize("capacity", [1, 2, 10, 64, 1024])
def test_plans_hold_every_piece_and_are_close_to_the_bound(capacity):
    draw = random.Random(capacity)
    for n in (0, 1, 7, 300, 3000):
        counts = Counter(draw.randint(1, capacity) for _ in range(n))
        runs = packing.plan(dict(counts), capacity)
        held = Counter()
        for bins, content in runs:
            assert bins > 0 and sum(a * b for a, b in content) <= capacity
            for length, times in content:
                held[length] += bins * times
        assert held == counts
        assert sum(bins for bins, _ in runs) <= 1.03 * -(-sum(counts.elements()) // capacity) + 2


def test_large_pieces_are_placed_by_configurations():
    draw = random.Random(5)
    counts = Counter(min(1023, int(draw.lognormvariate(6, 0.7)) + 1) for _ in range(12_000))
    runs, rest = packing.scheme(dict(counts), 1024, packing.GROUPS)
    small = 1024 * packing.SMALL_SHARE
    large = sum(n for length, n in counts.items() if length > small)
    placed = sum(bins * times for bins, content in runs for length, times in content if length > small)
    assert placed == large - sum(n for length, n in rest.items() if length > small) and placed >= 0.99 * large
    # Rounding up within groups costs at most the bins of one group, each of a piece of its own.
    bound = -(-sum(counts.elements()) // 1024) + -(-large // packing.GROUPS)
    assert sum(bins for bins, _ in packing.plan(dict(counts))) <= bound


def fewest_bins(lengths, capacity):
    """The optimum of a few pieces: over subsets, the fewest bins and then the fullest last one's least content."""
    best = {0: (0, capacity)}
    for chosen in range(1, 1 << len(lengths)):
        options = []
        for i, length in enumerate(lengths):
            if chosen >> i & 1:
                bins, last = best[chosen ^ (1 << i)]
                options.append((bins, last + length) if last + length <= capacity else (bins + 1, length))
        best[chosen] = min(options)
    return best[(1 << len(lengths)) - 1][0]


def test_plans_of_a_few_pieces_are_near_the_optimum():
    draw = random.Random(6)
    exact = 0
    for _ in range(60):
        lengths = [draw.randint(1, 20) for _ in range(draw.randint(1, 9))]
        bins = sum(n for n, _ in packing.plan(dict(Counter(lengths)), 20))
        optimum = fewest_bins(lengths, 20)
        assert optimum <= bins <= optimum + 1
        exact += bins == optimum
    assert exact >= 54


def test_packing(spark, docs, nothing):
    packed = packing.packed_documents(clashing(docs, "piece", "offset", "start")).collect()
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append(whole_ids(r["text"]))
    for r in packed:
        assert any(r["ids_crc32"] == crc(i[r["start"] : r["start"] + r["length"]]) for i in ids[r["doc_id"]])
    assert sum(r["length"] for r in packed) == sum(len(i) for many in ids.values() for i in many)
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.packed_documents(nothing).count() == 0


# --- Huffman files ---------------------------------------------------------------------------------------------


def test_codes_are_limited_and_complete():
    counts = np.array([2**i for i in range(30)])
    for bits in (5, 8, 20):
        lengths = huffman.code_lengths(counts, bits)
        assert lengths.max() <= bits and (2.0 ** -lengths.astype(float)).sum() == 1
    free = huffman.code_lengths(np.array([5, 9, 12, 13, 16, 45]), 20)
    assert (free * np.array([5, 9, 12, 13, 16, 45])).sum() == 224  # the well-known optimum
    assert huffman.code_lengths(np.array([0, 3])).tolist() == [0, 1]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, dtype=int), 3)


def test_streams_round_trip():
    draw = np.random.default_rng(4)
    for n in (1, 2, 511, 512, 513, 5000):
        ids = draw.zipf(1.3, n) % 3000
        lengths = huffman.code_lengths(np.bincount(ids))
        bits, checkpoints = huffman.encode_ids(ids, huffman.canonical_codes(lengths), lengths)
        again = huffman.decode_blocks([(bits, checkpoints, n)] * 3, huffman.decode_table(lengths))
        assert (again == np.tile(ids, 3)).all()


def test_files_round_trip_in_order(spark, docs, nothing):
    path = common.scratch_path(spark, "test")
    huffman.write_ids(clashing(docs, "before", "segment", "ids"), path)
    found = sorted(huffman.read_ids(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    numbers = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert numbers == sorted(numbers)
    expected = sorted(crc(whole_ids(r["text"])) for r in docs.collect())
    assert sorted(r["ids_crc32"] for r in found) == expected == sorted(zlib.crc32(bytes(r["ids"])) for r in found)
    path = common.scratch_path(spark, "test")
    huffman.write_ids(nothing, path)
    assert huffman.read_ids(spark, path).count() == 0


# --- quality ---------------------------------------------------------------------------------------------------


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for many in places.values() if len(many) > 1 for i in many for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_quality_measures(docs, nothing):
    found = quality.verdicts(clashing(docs, "n_words", "quality_measures")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in found) == Counter(brute_quality(r["text"]) for r in docs.collect())
    assert not any(r["kept"] for r in found if r["base_failed"])
    kept = quality.keep_fit(clashing(docs, "quality_measures"))
    assert kept.columns == [*docs.columns, "quality_measures"]
    assert kept.count() == sum(r["kept"] for r in found)
    assert quality.keep_fit(nothing).count() == 0


def test_votes_against_mean_unfit():
    good, bad = (1, 1, 1, 1), [(-1, 1, 1, 1), (1, -1, 1, 1), (1, 1, -1, 1)]
    prior, odds = quality.estimate({good: 900, **dict.fromkeys(bad, 30), (0, 0, 0, 0): 10}, 4)
    score = lambda votes: prior + sum(odds[r][v] for r, v in enumerate(votes))
    assert score(good) > 0 and all(score(b) < 0 for b in bad)


def test_quality_agrees_with_labels(spark):
    found = quality.verdicts(common.read_table(spark, SF, "documents")).select("doc_id", "kept")
    labels = common.read_table(spark, SF, "labels")
    hits = Counter((r["quality"], r["kept"]) for r in found.join(labels, "doc_id").collect())
    assert hits[0, False] >= 0.9 * (hits[0, True] + hits[0, False])
    assert hits[1, True] >= 0.9 * (hits[1, True] + hits[1, False])


# --- contamination ---------------------------------------------------------------------------------------------


def common_run(words, at, item, start):
    """How many words agree from two places on."""
    n = 0
    while at + n < len(words) and start + n < len(item) and words[at + n] == item[start + n]:
        n += 1
    return n


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("options", [{}, {"block_bytes": 300, "shard_words": 200}])
def test_contamination(spark, options):
    draw = random.Random(8)
    items = [prose(draw, n) for n in (30, 12, 10, 9, 3, 1)] + [None, "", "...", prose(draw, 40)]
    items.append(items[0])
    plain = [prose(draw, 50) for _ in range(30)]
    planted = [f"{plain[i]} {' '.join(items[0].split()[i : i + 9 + i % 4])} {plain[i + 1]}" for i in range(8)]
    docs = [*plain, *planted, None, "", items[3].upper() + "! " + items[1], items[4], items[5], items[9] * 3]
    rows = [(i, t) for i, t in enumerate(docs)] + [(2, docs[2])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    windows = {}
    for i, item in enumerate(items):
        words = brute_words(item)
        for at in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[at : at + 10]), set()).add(str(i))
    expected = Counter()
    for i, text in rows:
        words, hit, found = brute_words(text), set(), set()
        for at in range(len(words)):
            for size in range(1, 11):
                if (key := tuple(words[at : at + size])) in windows and len(key) == size:
                    hit |= set(range(at, at + size))
                    found |= windows[key]
        expected[i, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = contamination.verdicts(clashing(table, "found", "hits"), bench, **options).collect()
    assert Counter(tuple(r[n] for n in names) for r in got) == expected
    for r in got:
        words = brute_words(dict(rows)[r["doc_id"]])
        for m in r["matches"]:
            item = brute_words(items[int(m["item_id"])])
            assert words[m["start"] : m["start"] + m["length"]] == item[m["item_start"] : m["item_start"] + m["length"]]
            brute = max(
                (n for i in items for a in range(len(brute_words(i))) for n in [common_run(words, m["start"], brute_words(i), a)]), default=0
            )
            assert m["length"] == brute
    kept = contamination.remove_contaminated(clashing(table, "found"), bench, **options)
    assert kept.columns == ["doc_id", "text", "found"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k[0] for k, n in expected.items() if not k[5] for _ in range(n))
    assert contamination.verdicts(table.limit(0), bench).count() == 0
    assert not any(r["contaminated"] for r in contamination.verdicts(table, bench.limit(0)).collect())


def test_frequent_lines_give_one_match_for_each_span():
    line = prose(random.Random(8), 12)
    items = [(str(k), f"start{k} {line} end{k}") for k in range(300)]
    tests = contamination.Tests(items, 10)
    found = contamination.search([" ".join(f"{line} between{k}" for k in range(50)), None, line], tests)
    n = len(brute_words(line))
    assert [len(f["matches"]) for f in found] == [50, 0, 1] and [len(f["items"]) for f in found] == [300, 0, 300]
    assert {(m["length"], m["item_id"], m["item_start"]) for f in found for m in f["matches"]} == {(n, "0", 1)}
    assert [m["start"] for m in found[0]["matches"]] == [k * (n + 1) for k in range(50)]


def test_copies_of_a_benchmark_row_do_not_fill_a_block(spark):
    items = [(0, "one item that is repeated " * 4)] * 200 + [(i, f"item {i} " * 10) for i in range(1, 20)]
    table = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(contamination.test_blocks(table, 500))
    assert sorted(row for block in blocks for row in block) == sorted({(str(i), t) for i, t in items})
    assert len(blocks) <= 10


# --- near duplicates -------------------------------------------------------------------------------------------


def brute_groups(rows):
    sets = {}
    for k, (_, text) in enumerate(rows):
        words = brute_words(text)
        sets[k] = frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else text or ""
    classes = {}
    for k, s in sets.items():
        classes.setdefault(s, []).append(k)
    parent = dict.fromkeys(sets)
    root = lambda k: k if parent[k] is None else root(parent[k])
    def join(a, b):
        if root(a) != root(b):
            parent[root(a)] = root(b)
    for many in classes.values():
        for k in many[1:]:
            join(k, many[0])
    degree, keys = Counter(), [s for s in classes if isinstance(s, frozenset)]
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(a & b) >= 0.8 * len(a | b) - 1e-9:
                degree[a] += 1
                degree[b] += 1
                join(classes[a][0], classes[b][0])
    least = {}
    for k in sets:
        name = rows[k][0]
        best = least.get(root(k))
        least[root(k)] = name if best is None else best if name is None else min(best, name)
    return Counter((rows[k][0], least[root(k)], degree[sets[k]], len(classes[sets[k]])) for k in sets)


@pytest.mark.parametrize("blocks", [(512, 400_000), (4, 300)])
def test_near_duplicates(spark, docs, nothing, blocks, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_CLASSES", blocks[0])
    monkeypatch.setattr(near_duplicates, "BLOCK_GRAMS", blocks[1])
    draw = random.Random(6)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    base = prose(draw, 120).split()
    for i in range(40):  # a chain of edits: neighbours are near, the ends are not
        base[(7 * i) % len(base)] = f"edit{i}"
        rows.append((1000 + i, " ".join(base)))
    other = prose(draw, 80)
    rows += [(2000 + i, other) for i in range(15)] + [(2100 + i, f"{other} end{i}") for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.groups(clashing(table, "class_id", "node"))
    assert Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in found.collect()) == brute_groups(rows)
    kept = near_duplicates.keep_one(clashing(table, "k_id", "class_key"))
    assert kept.columns == ["doc_id", "text", "k_id", "class_key"]
    assert kept.count() == found.select("group").distinct().count()
    assert near_duplicates.groups(nothing).count() == 0 == near_duplicates.keep_one(nothing).count()


def test_cells_follow_the_similarity_asked_for(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_CLASSES", 4)
    words = prose(random.Random(16), 4000).split()
    sizes = [204 + 8 * i for i in range(26)]  # prefixes of one text: similarity is the ratio of their numbers of n-grams
    table = spark.createDataFrame([(n, " ".join(words[:n])) for n in sizes], "doc_id long, text string")
    found = {r["doc_id"]: r["n_links"] for r in near_duplicates.groups(table, similarity=0.5).collect()}
    assert found == {a: sum(min(a, b) - 4 >= 0.5 * (max(a, b) - 4) for b in sizes if b != a) for a in sizes}


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.8, 0.9):
        bands, rows = near_duplicates.band_shape(similarity, recall=0.99, most=256)
        assert 1 - (1 - similarity**rows) ** bands >= 0.99 and bands * rows <= 256


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    draw = random.Random(2)
    names = dict(zip(range(300), draw.sample(range(10**6), 300), strict=True))
    table = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    found = {r["node"]: r["component"] for r in near_duplicates.components(table).collect()}
    assert len({found[names[i]] for i in range(61)}) == 1 and len({found[names[i]] for i in range(100, 130)}) == 1
    assert found[names[0]] != found[names[100]] and names[200] not in found


# --- toxicity --------------------------------------------------------------------------------------------------


def test_obfuscation_is_undone():
    learned = toxicity.Lexicon(frozenset())
    at = toxicity.FEATURES.index("fixed_plain")
    for text in ("you id1ot now", "you st.up1d thing", "you i.d.i.o.t now", "such a m-o-r-o-n he"):
        assert toxicity.features(text, learned)[at] > 0
    assert toxicity.features(None, learned) == toxicity.features("", learned) and len(toxicity.features("x", learned)) == len(toxicity.FEATURES)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = common.read_table(spark, sf, "documents"), common.read_table(spark, sf, "labels")
    found = toxicity.scores(docs, labels)
    rows = found.join(labels, "doc_id").filter("held_out").select("toxic", "score").collect()
    pairs = [(a["score"], b["score"]) for a in rows if a["toxic"] for b in rows if not b["toxic"]]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) >= 0.75 * len(pairs)
    assert found.filter("score < 0 or score > 1 or score is null").isEmpty()
    assert found.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0)).isEmpty()


def test_toxicity_without_labels(spark, docs, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.scores(clashing(docs, "score", "features"), labels).collect()
    assert len(found) == docs.count() and {(r["score"], r["predicted"]) for r in found} == {(0.0, 0)}
    assert toxicity.scores(nothing, labels).count() == 0


# --- personal data ---------------------------------------------------------------------------------------------


def brute_spans(text):
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    out = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2 and not (14 <= len(digits) <= 19 and personal_data.luhn(digits)):
                continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_plain_spans():
    draw = random.Random(9)
    odd = ["".join(draw.choices("1234567890 .@-+()ab%_", weights=[3] * 10 + [2] * 11, k=60)) for _ in range(3000)]
    fixed = ["a@b.c@d.e", "..@x.y", "1.2.3.4.5.6.7.8", "0001.2.3.4", "+1 (415) 555-2671", "4539 1488 0343 6467", "é@x.y", "@@a.b", "a@b"]
    for text in odd + fixed:
        assert personal_data.listed(personal_data.base_spans(text)) == brute_spans(text), text


@pytest.fixture(scope="module")
def pii_model(spark):
    parts = [r["text"] for r in common.read_table(spark, "/root/testdata/sf0.01", "documents").collect()]
    return personal_data.train([t[max(0, a - 40) : b + 40] for t in parts if t for a, b in personal_data.regions(t)])


def test_the_model_adds_what_patterns_miss(pii_model):
    for text, kind in (("write to jane at example dot com please", "email"), ("call (974) 555-3436 today", "phone")):
        assert [k for _, _, k in personal_data.added_spans(text, personal_data.base_spans(text), pii_model)] == [kind]
    for text in ('token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72" and', "on 2019-03-04 12 30 45 we met", "he was at the dot. Com"):
        assert personal_data.added_spans(text, personal_data.base_spans(text), pii_model) == []


def test_addresses_with_any_host_end_are_found(pii_model):
    for address in (
        "jane [at] firma [dot] pl", "jane(at)example.ca", "jane at mail dot example dot jp", "jo.doe [at] mail [dot] example [dot] co [dot] uk",
        "jane[at]firma[dot]museum", "jane at example.com",
    ):
        text = f"mail {address} please"
        assert personal_data.email_regions(text) and personal_data.added_spans(text, [], pii_model) == [(5, 5 + len(address), "email")], address
    for text in ("we look at the dot on the map", "point at the dot in the middle", "stay at home.We left", "available at example.com today"):
        assert personal_data.added_spans(text, [], pii_model) == [], text


def test_a_region_does_not_depend_on_the_rest_of_its_text():
    for rest in ("", " and a@b.example", " (at)", " a dot b"):
        assert (5, 24) in personal_data.email_regions("mail jane at example.com" + rest)


def test_personal_data_tables(docs, nothing, pii_model):
    found = personal_data.find(clashing(docs, "spans"), pii_model).collect()
    assert Counter(r["base_sha256"] for r in found) == Counter(hashlib.sha256(brute_spans(r["text"] or "").encode()).hexdigest() for r in docs.collect())
    clean = personal_data.redact(clashing(docs, "spans"), pii_model)
    assert clean.columns == [*docs.columns, "spans"]
    by_text = [r["text"] for r in clean.collect()]
    assert "mail me at [EMAIL] or [PHONE]" in by_text and "host [IP], card [CARD]!" in by_text
    assert clean.filter(F.col("n_chars") != F.char_length("text")).isEmpty()
    assert personal_data.find(nothing).count() == 0 == personal_data.redact(nothing).count()


# --- pages -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def page_model(spark):
    return main_text.train([r["html"] for r in common.read_table(spark, SF, "pages").collect()])


def test_main_text(page_model):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/a>Home</a></ul></nav>"
        "<article><h1>A &amp; B</h1><p><b>First  line.<br><p>Second&nbsp;one, it goes on and on.<script>var x='</p>';</script>"
        "<div class=comments><p>I like it, thanks.</p></div></article><aside>More to read</aside><footer>&copy; x</footer></body>"
    )
    assert main_text.extract(page, page_model) == "A & B\nFirst line.\nSecond one, it goes on and on."
    assert main_text.extract(None, page_model) == main_text.extract("", page_model) == main_text.extract("<p", page_model).strip("<p") == ""


def test_unclosed_elements_take_no_later_text(page_model):
    body = lambda inside: f"<html><body><article><h1>Of it</h1><p>First of it, and more.</p>{inside}<p>Later text of it, and more of it, is here.</p></article></body></html>"
    plain = "Of it\nFirst of it, and more.\nLater text of it, and more of it, is here."
    for tag in "button select svg canvas audio video object iframe template noscript".split():
        for inside in (f"<{tag}>", f"<div><{tag}>hidden words</div>", f"<{tag}>hidden<p>words</p></{tag}>", f"<{tag}>a</{tag}><{tag}>hidden", f"<{tag}>" * 50):
            assert main_text.extract(body(inside), page_model) == plain, (tag, inside)
    assert main_text.extract(body("").replace("First of it", "First <a href=/x><svg><path d=x></a> of it"), page_model) == plain
    formula = main_text.extract(body("").replace("First of it", "If <math><mi>x</mi><mo>=</mo><mn>2</mn></math>"), page_model)
    assert formula == plain.replace("First of it", "If x=2")
    assert main_text.extract(body("<script>var x"), page_model) == "Of it\nFirst of it, and more."


def test_marginals_are_exact():
    draw = random.Random(12)
    model = main_text.Model()
    model.weights = {f: draw.uniform(-2, 2) for f in ("any", "tag div", "tag p", "tag body", "no text", "links 0")}
    model.pairs = {t: [[draw.uniform(-2, 2) for _ in range(2)] for _ in range(2)] for t in (False, True)}
    nodes, _ = main_text.parse("<body><div><p>one</p><div><p>two</p></div></div><p>three</p></body>")
    own = [model.own(main_text.node_features(n)) for n in nodes]
    total, ones = 0.0, [0.0] * len(nodes)
    for state in range(1 << len(nodes)):
        y = [state >> i & 1 for i in range(len(nodes))]
        score = sum(o * v for o, v in zip(own, y, strict=True))
        score += sum(model.pairs[n.tag in main_text.TEXT_TAGS][y[n.parent]][y[i]] for i, n in enumerate(nodes) if i)
        weight = np.exp(score)
        total += weight
        ones = [a + weight * v for a, v in zip(ones, y, strict=True)]
    assert np.allclose(model.marginals(nodes), [a / total for a in ones])


def test_pages_held_out(page_model):
    draw = random.Random(77)
    right = wrong = 0
    for _ in range(60):
        nodes, blocks = main_text.parse(main_text.composed_page(draw))
        labels = main_text.composed_labels(nodes)
        for n in nodes:
            n.names = re.sub(r"(?:^| )[01](?= |$)", "", n.names)
        likely = page_model.marginals(nodes)
        right += sum((likely[n] >= 0.5) == bool(labels[n]) for n, _ in blocks)
        wrong += sum((likely[n] >= 0.5) != bool(labels[n]) for n, _ in blocks)
    assert right >= 0.93 * (right + wrong)


def test_page_tables(spark, page_model):
    page = "<html><body><nav><a href=/a>Home</a></nav><article><h1>Of it</h1><p>Text of it, and more of it, is here.</p></article></body>"
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (3, "v", "")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    found = main_text.main_texts(table, page_model).collect()
    assert sorted((r["text"], r["n_chars"]) for r in found) == [("", 0), ("", 0)] + [("Of it\nText of it, and more of it, is here.", 42)] * 2
    assert main_text.main_texts(table.limit(0)).count() == 0


# --- urls ------------------------------------------------------------------------------------------------------


def brute_url(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"(?s)[^/?#]*", rest)[0]
        path = re.match(r"(?s)[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    blocked = url is not None and any(re.search(p, url.lower()) for p, _ in url_filter.PATTERN_RULES)
    return host, path, None, "block" if blocked else "allow"


def test_urls(spark):
    urls = [
        None, "", "no scheme", "a://", "http://Example.COM/en/1", "http://www.example.com/en/1", "http://x.net/fr/a?b#c", "http://net/es/", "http://xnet/es/",
        "http://free-bets.example.org/q", "http://m.cheap-pills.example.org?x=1", "http://freebets.example.org/", "http://a.org?u=http://b.com/x", "ftp://é.com/ü",
        "http://example.com/en", "http://a.org/wp-login.php", "http://a.org/\n://b", "http://casino.example.org", "http://a.org/?affiliate_id=3",
    ]
    table = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 2)], "page_id long, url string").withColumn("host", F.lit("x"))
    found = url_filter.verdicts(table).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found) == Counter((i, *brute_url(u)) for i, u in enumerate(urls * 2))
    assert url_filter.verdicts(table.limit(0)).count() == 0


def test_urls_match_sql(spark):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cursor = connection.execute(url_filter.oracle_sql())
    names = [d[0] for d in cursor.description]
    found = url_filter.verdicts(common.read_table(spark, SF, "pages")).select(*names).collect()
    assert Counter(map(tuple, found)) == Counter(cursor.fetchall())


def test_literals_are_tokens_of_what_their_rule_fits():
    fitting = [
        "http://free-bets.x.org", "http://a.cheap-pills.x/", "http://casino.x", "http://poker.x", "http://bets-bonus.x", "http://adult-cams.x", "http://xxx.y",
        "http://porn.x", "http://payday-loan.x", "http://replica-watches.x", "http://download-free-crack.x", "http://warez.x", "http://keygen.x", "http://ads-server.x",
        "http://x/wp-login.php", "http://x/?affiliate_id=1",
    ]
    for pattern, literals in url_filter.PATTERN_RULES:
        hits = [u for u in fitting if re.search(pattern, u)]
        assert hits and all(t in re.split("[^a-z0-9]+", u) for u in hits for t in literals)


# --- licences --------------------------------------------------------------------------------------------------


def test_licenses(spark, nothing):
    mit = "Copyright (c) 2020 Jo Doe\n\n" + licenses.MIT.replace("granted, free", "granted --\n free").upper()
    rows = [(1, mit), (2, licenses.MIT + " more"), (3, "prose\nReleased under the MIT Licence\nLicensed under CC BY-NC 4.0."), (4, None), (5, ""), (3, "x"), (None, licenses.ISC)]
    found = licenses.scan(clashing(spark.createDataFrame(rows, "doc_id long, text string"), "row", "digest")).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["license"]) for r in found if r["license"]} == {(1, "MIT"), (None, "ISC")}
    assert {(r["doc_id"], r["notices"]) for r in found if r["notices"]} == {(3, "CC-BY-NC-4.0,MIT")}
    assert licenses.scan(nothing).count() == 0


def test_whole_licences_and_their_notices(spark):
    folder = "/usr/share/common-licenses"
    names = {
        "Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0",
        "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause",
    }
    rows, expected = [], {}
    for name, licence in names.items():
        text = open(f"{folder}/{name}").read()
        texts = [text, "BSD 3-Clause License\n\n" + text] if name == "BSD" else [text, text.strip().split("\n", 1)[1], text.split("END OF TERMS")[0]]
        rows += [(len(rows) + i, t) for i, t in enumerate(texts)]
        expected |= {n: licence for n in range(len(expected), len(rows))}
    bsd = licenses.BSD_HEAD + licenses.BSD_THIRD + licenses.BSD_TAIL
    for text in ("BSD 3-Clause License\n\nCopyright (c) 2020, Jo\n" + bsd, bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")):
        expected[len(rows)] = "BSD-3-Clause"
        rows.append((len(rows), text))
    notices = {
        "Released under the BSD License.": "BSD", "Licensed under the MPL 2.0": "MPL-2.0", "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1",
        licenses.MPL_NOTICE: "MPL-2.0", "Distributed under the GNU General Public License v3.0": "GPL-3.0", "Released under the MPL.": "MPL",
    }
    rows += [(1000 + n, f"prose\n{line}") for n, line in enumerate(notices)] + [(2000, rows[0][1] + " more")]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {n: r["license"] for n, r in found.items() if r["license"]} == expected
    assert [found[1000 + n]["notices"] for n in range(len(notices))] == list(notices.values())


def test_normal_form_of_licences(spark):
    apache, gpl = (open(f"/usr/share/common-licenses/{n}").read() for n in ("Apache-2.0", "GPL-3"))
    bsd = licenses.BSD_HEAD + licenses.BSD_THIRD + licenses.BSD_TAIL
    owner = bsd.replace("copyright holder", "copyright owner").replace("COPYRIGHT HOLDERS", "COPYRIGHT OWNERS")
    heads = [
        "Copyright Joyent, Inc. and other Node contributors.", "Copyright <YEAR> <HOLDER>", "Copyright [yyyy] [name of copyright owner]", "(c) Jane Doe", "Copyright: Jo Doe",
        "// Copyright The Authors", "(C) 2020-2024 Jo, Doe", "© Jo", "Copyright by Jane Doe. All rights reserved.", "(c) Jane Doe, Jo Roe and contributors. All rights reserved.",
    ]
    rows = [(head + "\n\n" + licenses.MIT, "MIT") for head in heads]
    rows += [("\n".join(licenses.MIT.replace("NONINFRINGEMENT", "NON INFRINGEMENT").split()), "MIT"), ("\n".join(bsd.split()), "BSD-3-Clause")]
    for width in (30, 47, 63, 90):
        wrapped = lambda text: re.sub(rf"(.{{{width}}}\S*) ", r"\1\n", " ".join(text.split()))  # noqa: E731, B023
        rows += [(wrapped(licenses.MIT), "MIT"), (wrapped(bsd), "BSD-3-Clause"), (wrapped(bsd).upper(), "BSD-3-Clause")]
    # Lines that begin with (c) or copyright but name nobody are text of the licence.
    rows += [(apache.replace("You must retain, in the Source form", "You must never retain"), None), ("(c) Jane Doe\nMIT License\n\n" + licenses.MIT, "MIT")]
    rows += [(apache.replace("Copyright [yyyy]", "Copyright 2020"), "Apache-2.0"), (re.sub("(?<=copyright) ", "\n", licenses.MIT), "MIT")]
    rows += [(re.sub("(?<= )copyright ", "\ncopyright ", gpl), "GPL-3.0"), (re.sub("(?i) (copyright )", r"\n\1", owner), "BSD-3-Clause")]
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.scan(table).collect()}
    wrong = [(t[:80], licence, found[i]) for i, (t, licence) in enumerate(rows) if found[i] != licence]
    assert not wrong, wrong
    twice = [licenses.scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).first()["digest"] for t in ("licence licence x", "license license x")]
    assert twice[0] == twice[1]


# --- pipeline --------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = common.read_table(spark, SF, "documents").withColumn("extra", F.lit(1))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stage(stage(spark, docs, SF), name)
        assert docs.columns == columns
        assert docs.select("doc_id").distinct().count() == docs.count() > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_pipeline_on_awkward_tables(spark, docs, nothing):
    import corpus_pipeline

    for table in (docs, nothing):
        for name, stage in corpus_pipeline.STAGES:
            table = common.stage(stage(spark, table, SF), name)
