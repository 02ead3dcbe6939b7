"""Personal data in whole texts: fixed patterns, and a semi-Markov conditional random field for what they miss.

Patterns find emails, ip addresses, cards and phones in their plain form; these spans always stay.  What the patterns
miss (a phone without its plus, an email with its at and dot spelled out) is searched in the regions of a text that hold
enough digits or an at sign.  There the model scores whole candidate spans, of at most ``MOST_DIGITS`` digits, from
features of the whole span (digits, groups, marks, checksum, shape, words before it), and dynamic programming chooses
boundaries and kinds together.

The model is trained on a bounded sample of the documents: plain spans are its positive examples, each also in forms
with the plain mark removed, and all else in their regions is negative, as are made-up
dates, ranges and quantities.  Addresses with other ways to write their marks and other host ends are made up, as is prose
with an at and a dot.  What the table itself spells out is not used: nobody has labelled it.

Whether a name, an at and a host in a row are an address is the model's decision; a host may end in any label of letters.

A null text counts as empty.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds, in the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone")

#: The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: The same for searching: no match of it begins inside a run of digits, as each ends with one.
IP_FROM_RUN = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Where the model looks: runs of digits and marks, and spelled-out emails.
DIGIT_REGION = re.compile(r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9])*")
LEAST_DIGITS = 7
AT, DOT = r"(?:@|\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s)", r"(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s)"
AT_MARK = re.compile(AT, re.IGNORECASE)
DOT_MARK = re.compile(DOT, re.IGNORECASE)
NAME_BEFORE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*\Z")
#: A host's last part may be any letters, two at least, or an encoded international one.
HOST_AFTER = re.compile(
    rf"[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}})*{DOT}(?:xn--[A-Za-z0-9-]{{1,59}}|[A-Za-z]{{2,63}})(?![A-Za-z0-9-])",
    re.IGNORECASE,
)
MORE_HOST = re.compile(rf"{DOT}[A-Za-z0-9-]", re.IGNORECASE)
#: Fixed values, for features only: well-known last parts of hosts, and words that are seldom parts of an address.
HOST_ENDS = frozenset("com net org edu gov mil int info biz io dev app co de fr es uk eu ch at it nl be pl ca jp cn in ru br au se no dk fi cz pt ie us kr nz za mx ar tr ua gr hu ro il sg".split())
PROSE_WORDS = frozenset(
    "a all an and any are as be but by each every first for from had has he her here his home if in is it its last least look looked "
    "me met midnight my night no noon of on once one or our she so some that the their them then there these they this those to up us "
    "was we were what when which who will with you your aim are arrive arrived available browse buy found go hosted is live look more "
    "now online page point published read see site sold start stared stay visit website work works".split()
)
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
CUE = re.compile(r"(tel|phone|call|fax|mobile|card|visa|credit|ip|host|address|server|mail|contact)\W*\Z", re.IGNORECASE)

MAIL_CUE = re.compile(r"(?:mail|contact|reach|write|ask|address|send)(?:\s+(?:me|us|him|her|them|to|is))*\W*\Z", re.IGNORECASE)

#: Digits of a candidate span without an at: no kind has more.  Parts of an address are candidates up to so many tokens
#: (spelled marks take five each), a whole one whatever its length.
MOST_DIGITS, MOST_PART_TOKENS = 19, 64
#: Documents and regions to learn from, rounds, rate, penalty; score by which a span must beat leaving it out.
SAMPLE, REGIONS, ROUNDS, LEARNING_RATE, PENALTY, MARGIN = 4000, 600, 15, 0.3, 1e-3, 1.0

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Plain spans: per kind leftmost and not overlapping, those that fail their test dropped."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        # A match with this sign begins where its run of local characters does, or after the match before.
        low = at
        while low > done and EMAIL_LOCAL.match(text[low - 1]):
            low -= 1
        found = EMAIL.match(text, low) if low < at else None
        if found:
            out.append((found.start(), found.end(), "email"))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    for m in IP_FROM_RUN.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=order)


def order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- regions and features --------------------------------------------------------------------------------------


def email_regions(text: str) -> list[tuple[int, int]]:
    """Where a name, an at and a host stand in a row, plain or spelled out; whatever else the text holds."""
    out, at, done = [], 0, 0
    while mark := AT_MARK.search(text, at):
        at = mark.start() + 1
        if host := HOST_AFTER.match(text, mark.end()):
            low = mark.start()
            while low > done and EMAIL_LOCAL.match(text[low - 1]):
                low -= 1
            if name := NAME_BEFORE.search(text, low, mark.start()):
                out.append((name.start(), host.end()))
                at = done = host.end()
    return out


def regions(text: str) -> list[tuple[int, int]]:
    out = [m.span() for m in DIGIT_REGION.finditer(text) if m.end() - m.start() >= LEAST_DIGITS and len(digits_of(m[0])) >= LEAST_DIGITS]
    return merge(out + email_regions(text))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def span_features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole candidate span."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    n = sum(map(len, groups))
    letters = re.sub(r"(?i)\b(?:at|dot)\b", "", span)
    before, after = text[start - 1 : start], text[end : end + 1]
    out = [
        "any", f"digits{min(n, 20)}", f"groups{min(len(groups), 6)}", "shape" + "-".join(str(min(len(g), 9)) for g in groups[:6]),
        f"plus{span[0] == '+'}", f"parens{'(' in span}", f"marks{''.join(sorted(set(re.sub(r'[A-Za-z0-9]', '', span)) & set(' .-/')))}",
        f"letters{any(c.isalpha() for c in letters)}", f"at{bool(re.search(AT, span, re.I))}{bool(re.search(DOT, span, re.I))}",
        f"dots{len(re.findall(DOT, span, re.I))}",
        f"inside{before.isalnum() or after.isalnum() or before in '=.@' and bool(before)}",
    ]
    if 14 <= n <= 19:
        out.append(f"luhn{luhn(''.join(groups))}")
    if len(groups) == 4 and n <= 12:
        out.append(f"bytes{all(int(g) <= 255 for g in groups)}")
    if cue := CUE.search(text[max(0, start - 16) : start]):
        out.append(f"cue{cue[1].lower()}")
    if mark := AT_MARK.search(span):
        out += address_features(text, start, end, mark)
    return out


def spelling(mark: str) -> str:
    """How an at or a dot is written: plain, in brackets or as a word."""
    return "plain" if mark in "@." else "bracket" if mark.strip()[0] in "[({<" else "word"


def address_features(text: str, start: int, end: int, mark: re.Match) -> list[str]:
    """Features of a candidate span as an address: its marks, the host's end, words of prose, what it leaves out."""
    name, host = text[start : start + mark.start()], text[start + mark.end() : end]
    marks, labels = DOT_MARK.findall(host), [label.lower() for label in DOT_MARK.split(host)]
    formed = bool(NAME_BEFORE.match(name)) and HOST_AFTER.fullmatch(host) is not None
    at, dot = spelling(mark[0]), "-".join(sorted({spelling(m) for m in marks}))
    last = labels[-1]
    ending = "known" if last in HOST_ENDS else "prose" if last in PROSE_WORDS else "two" if len(last) == 2 else "letters"
    prose = sum(part in PROSE_WORDS for part in (name.lower(), *labels[:-1]))
    marked = not name.isalpha()
    more = bool(MORE_HOST.match(text, end))
    return [
        f"formed{formed}", f"address {at} {dot}", f"address {at} {dot} {marked}", f"ending {ending}", f"ending {at} {dot} {ending}",
        f"prose{min(prose, 2)}", f"prose {at} {dot} {prose > 0 or ending == 'prose'}", f"more{more}", f"more {ending} {more}",
        f"cut{text[start - 1 : start] in {*'._%+-'} if start else False}", f"mailcue {at} {dot} {bool(MAIL_CUE.search(text[max(0, start - 24) : start]))}",
        f"sentence {last != text[end - len(last) : end] and dot == 'plain' and at == 'word'}",
    ]


def candidates(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Boundaries of the tokens of a region, and the candidate spans as pairs of numbers of boundaries."""
    tokens = list(TOKEN.finditer(text, start, end))
    bounds = [t.start() for t in tokens] + [end]
    content = [t[0][0].isalnum() for t in tokens]
    digits = np.cumsum([0, *(len(t[0]) if t[0][0].isdigit() else 0 for t in tokens)])
    out = []
    whole = (0, len(tokens)) if tokens and AT_MARK.search(text, start, end) else None
    for i, token in enumerate(tokens):
        if not (content[i] or token[0] in "+("):
            continue
        for j in range(i + 1, len(tokens) + 1):
            n = digits[j] - digits[i]
            if (n > MOST_DIGITS if whole is None else j > i + MOST_PART_TOKENS):
                break
            if content[j - 1] and (
                LEAST_DIGITS <= n <= MOST_DIGITS
                or whole is not None and AT_MARK.search(text, bounds[i], bounds[j])
            ):
                out.append((i, j))
    if whole is not None and content[-1] and content[0] and whole not in out:
        out.append(whole)
    return bounds, out


# --- the model -------------------------------------------------------------------------------------------------


class Model:
    """Weights of (kind, feature) and of consecutive kinds; label 0 is "nothing", the others are KINDS."""

    def __init__(self) -> None:
        self.weights: dict[tuple[int, str], float] = {}
        self.steps = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def scores(self, features: list[str]) -> list[float]:
        """Score of each kind; an email needs a name, an at and a host, an address its three dots."""
        get = self.weights.get
        able = ("formedTrue" in features, "dots3" in features, True, True)
        return [sum(get((k, f), 0.0) for f in features) if ok else -np.inf for k, ok in enumerate(able, 1)]

    def best(self, n: int, spans: list[tuple[int, int]], scores: list[list[float]]) -> list[tuple[int, int, int]]:
        """The best segmentation of n tokens: tokens of nothing, and spans (from, to, label)."""
        ending: dict[int, list[int]] = {}
        for s, (_, j) in enumerate(spans):
            ending.setdefault(j, []).append(s)
        labels = len(KINDS) + 1
        value = np.full((n + 1, labels), -np.inf)
        value[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            entry = value[j - 1] + self.steps[:, 0]
            value[j, 0], back[j, 0] = entry.max(), (j - 1, int(entry.argmax()))
            for s in ending.get(j, ()):
                i = spans[s][0]
                for k in range(1, labels):
                    entry = value[i] + self.steps[:, k]
                    total = entry.max() + scores[s][k - 1] - MARGIN
                    if total > value[j, k]:
                        value[j, k], back[j, k] = total, (i, int(entry.argmax()))
        out, j, k = [], n, int(value[n].argmax())
        while j:
            i, before = back[j, k]
            if k:
                out.append((i, j, k))
            j, k = i, before
        return out[::-1]

    def update(self, n: int, spans: list[tuple[int, int]], features: list[list[str]], gold: dict[tuple[int, int], int], rate: float) -> None:
        """One ascent step of the log-likelihood of the gold segmentation (span to label), by forward and backward sums."""
        labels = len(KINDS) + 1
        scores = [[0.0, *self.scores(f)] for f in features]
        segments = [(j - 1, j, 0, None) for j in range(1, n + 1)]
        segments += [(i, j, k, s) for s, (i, j) in enumerate(spans) for k in range(1, labels)]
        segments.sort(key=lambda x: x[1])
        ahead = np.full((n + 1, labels), -np.inf)
        ahead[0, 0] = 0
        for i, j, k, s in segments:
            ahead[j, k] = np.logaddexp(ahead[j, k], np.logaddexp.reduce(ahead[i] + self.steps[:, k]) + (scores[s][k] if k else 0))
        behind = np.full((n + 1, labels), -np.inf)
        behind[n] = 0
        for i, j, k, s in sorted(segments, key=lambda x: -x[0]):
            behind[i] = np.logaddexp(behind[i], self.steps[:, k] + (scores[s][k] if k else 0) + behind[j, k])
        total = np.logaddexp.reduce(ahead[n])
        if not np.isfinite(total):
            return
        inner = {(i, j): k for (i, j), k in gold.items()}
        covered = {t for i, j in inner for t in range(i, j)}
        path, at, before = [], 0, 0
        while at < n:
            j, k = next(((j, k) for (i, j), k in inner.items() if i == at), (at + 1, 0)) if at in covered else (at + 1, 0)
            path.append((before, k))
            at, before = j, k
        slopes = np.zeros_like(self.steps)
        for before, k in path:
            slopes[before, k] += 1
        for i, j, k, s in segments:
            weight = np.exp(ahead[i] + self.steps[:, k] + (scores[s][k] if k else 0) + behind[j, k] - total)
            slopes[:, k] -= weight
            if k:
                slope = (inner.get((i, j)) == k) - float(weight.sum())
                if abs(slope) > 1e-6:
                    for f in features[s]:
                        w = self.weights.get((k, f), 0.0)
                        self.weights[k, f] = w + rate * (slope - PENALTY * w)
        self.steps += rate * (slopes - PENALTY * self.steps)


def views(text: str, start: int, end: int, kind: str) -> list[tuple[str, int, int]]:
    """A plain span in its text, and in forms without the mark that makes it plain; (text, start, end)."""
    span = text[start:end]
    forms = [span]
    if kind == "email":
        name, host = span.rsplit("@", 1)
        forms += [f"{name} [at] {host.replace('.', ' [dot] ')}", f"{name}(at){host}", f"{name} at {host.replace('.', ' dot ')}"]
    elif kind == "phone":
        forms += [span[1:], re.sub(r"^\+[0-9]+ ?", "", span), re.sub(r"[()]", "", span[1:]).replace(" ", "-")]
    elif kind == "card" and len(span) == 16:
        forms.append("/".join(span[i : i + 4] for i in range(0, 16, 4)))
    return [(text[:start] + form + text[end:], start, start + len(form)) for form in forms if form]


def plain_numbers(draw: random.Random) -> tuple[str, int, int, None]:
    """A date, time, range or list of quantities in a text: digits that name nobody."""
    d = draw.randint
    form = draw.choice([
        f"{d(1900, 2040)}-{d(1, 12):02}-{d(1, 28):02} {d(0, 23):02} {d(0, 59):02} {d(0, 59):02}", f"{d(1900, 2040)}{d(1, 12):02}{d(1, 28):02}",
        f"{d(1, 28):02}.{d(1, 12):02}.{d(1900, 2040)}", f"{d(1900, 2040)}-{d(1900, 2040)}", f"{d(1, 99)} {d(100, 999)} {d(100, 999)}",
        f"{d(1, 28):02}/{d(1, 12):02}/{d(1900, 2040)} {d(0, 23):02}.{d(0, 59):02}", f"{d(0, 9)}.{d(1000000, 9999999)}",
        f"{d(1, 99)} {d(1, 99)} {d(1, 99)} {d(1, 99)} {d(1, 99)} {d(1, 99)}",
    ])
    return f"and then {form} of it", 9, 9 + len(form), None


def spelled_address(draw: random.Random) -> tuple[str, int, int, str]:
    """A made-up address in a text, with its marks written in one of many ways and any host's end."""
    syllables = "ka lo mi ne ru sa te vi zo dan per lis mor en ti ga".split()
    word = lambda low=1: "".join(draw.choices(syllables, k=draw.randint(low, 3)))
    end = draw.choice([draw.choice(sorted(HOST_ENDS)), "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=2)), word(2)])
    name = draw.choice([word(2), f"{word()}.{word()}", f"{word()}{draw.randint(1, 99)}", f"{word()}_{word()}"])
    at, dot = draw.choice([
        (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "(dot)"), ("(at)", "."), (" [at] ", "."), ("@", " dot "), (" {at} ", " {dot} "),
        (" at ", " dot "), (" at ", " dot "), (" at ", " dot "), (" AT ", " DOT "), (" at ", "."), (" at ", "."),
    ])
    address = name + at + dot.join([word(2) for _ in range(draw.choice([1, 1, 2, 3]))] + [end])
    before = draw.choice(["mail me: ", "mail ", "write to ", "contact ", "and then ", "by ", "", f"{word()} "])
    return before + address + draw.choice([" please", ". We", ", or", "", "\n", f" {word()}"]), len(before), len(before) + len(address), "email"


def plain_words(draw: random.Random) -> tuple[str, int, int, None]:
    """Prose with an at and a dot that is no address."""
    word = lambda many: draw.choice(many.split())
    verb, thing = word("look looked met arrived arrive stay was available hosted aim point stared found see live visit online"), word("home noon night work school example github lunch")
    form = draw.choice([
        f"{verb} at {word('the a this that each every')} dot {word('in on of and com to the at is for matrix product')}",
        f"{verb} at {thing}.{word('Then We It The He They In And So')}", f"{verb} at {thing}.{word('com org net de pl ca')}",
        f"{verb} at {word('one first once last')} dot {word('and in of then')}",
    ])
    return f"and then {form} of it", 9, 9 + len(form), None


def spelled_out(text: str) -> bool:
    """Whether a region may be a spelled-out address; nobody has said if it is one, so it teaches nothing."""
    mark = AT_MARK.search(text)
    return mark is not None and (spelling(mark[0]) != "word" or any(spelling(m) != "plain" for m in DOT_MARK.findall(text, mark.end())))


def train(texts: list[str]) -> Model:
    """Fit a model to the regions of some texts; at most ``REGIONS`` of them with and as many without plain spans."""
    draw = random.Random(11)
    with_span, without = [], []
    for text in texts:
        base = base_spans(text)
        for low, high in regions(text):
            inside = [s for s in base if low <= s[0] and s[1] <= high]
            crossing = any(s[0] < high and low < s[1] for s in base)
            if len(inside) == 1:
                start, end, kind = inside[0]
                local = text[max(0, low - 30) : high + 30]
                shift = max(0, low - 30)
                with_span += [(t, a, b, kind) for t, a, b in views(local, start - shift, end - shift, kind)]
            elif not crossing and not spelled_out(text[low:high]):
                shift = max(0, low - 30)
                without.append((text[shift : high + 30], low - shift, high - shift, None))
    draw.shuffle(with_span)
    without = [plain_numbers(draw) for _ in range(REGIONS // 3)] + without
    draw.shuffle(without)
    made = [make(draw) for make in (spelled_address, plain_words) for _ in range(REGIONS // 2)]
    examples = []
    for text, start, end, kind in with_span[:REGIONS] + without[:REGIONS] + made:
        low, high = next(((a, b) for a, b in regions(text) if a <= start and end <= b), (start, end))
        bounds, spans = candidates(text, low, high)
        gold = {(i, j): KINDS.index(kind) + 1 for i, j in spans if kind and (bounds[i], bounds[j]) == (start, end)}
        if kind is None or gold:
            examples.append((len(bounds) - 1, spans, [span_features(text, bounds[i], bounds[j]) for i, j in spans], gold))
    model = Model()
    for n in range(ROUNDS if examples else 0):
        draw.shuffle(examples)
        for example in examples:
            model.update(*example, LEARNING_RATE / (1 + n))
    return model


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Spans that the model finds in the parts of regions that plain spans leave free."""
    if not model.weights:
        return []
    out: list[Span] = []
    taken = merge([(start, end) for start, end, _ in base])
    for low, high in regions(text):
        at = low
        for start, end in [*((s, e) for s, e in taken if s < high and e > low), (high, high)]:
            if start - at >= LEAST_DIGITS:
                bounds, spans = candidates(text, at, start)
                if spans:
                    scores = [model.scores(span_features(text, bounds[i], bounds[j])) for i, j in spans]
                    out += [(bounds[i], bounds[j], KINDS[k - 1]) for i, j, k in model.best(len(bounds) - 1, spans, scores)]
            at = max(at, end)
    return out


# --- on tables -------------------------------------------------------------------------------------------------


def fitted(docs: DataFrame) -> Model:
    """A model from about ``SAMPLE`` documents that hold a digit or an at sign, drawn by hash of their text."""
    some = docs.select(F.col("text").cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    n = some.count()
    share = SAMPLE / max(SAMPLE, n)
    drawn = some.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                text[max(0, low - 40) : high + 40]
                for text in batch.column(0).to_pylist() for low, high in regions(text) if high - low <= 200
            ]
            yield pa.record_batch([pa.array(parts, pa.string())], names=["part"])

    # Only what stands around the regions of the sample reaches the driver: a few hundred characters each.
    parts = drawn.mapInArrow(cut, "part string").distinct().orderBy(F.xxhash64("part"), "part").limit(2 * SAMPLE)
    return train([r["part"] for r in parts.collect()])


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): plain spans counted and digested, and all spans."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = model or fitted(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                counts = [sum(s[2] == kind for s in base) for kind in KINDS]
                spans = sorted(base + added_spans(text or "", base, model), key=order)
                rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.record_batch([batch.column(0), *arrays], names=["doc_id", *FOUND.replace(" long", "").replace(" string", "").split(", ")])

    return docs.mapInArrow(run, "doc_id long, " + FOUND)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span, or group of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for start, end in merge([(s, e) for s, e, _ in spans]):
        kind = next(k for s, _, k in sorted(spans, key=order) if start <= s < end)
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind; a whole number ``n_chars`` follows a changed text."""
    model = model or fitted(docs)
    names, schema = docs.columns, docs.schema
    text_at = names.index("text")
    whole = "n_chars" in names and isinstance(schema["n_chars"].dataType, (T.IntegerType, T.LongType))
    sizes_at = names.index("n_chars") if whole else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = []
            for text in columns[text_at].to_pylist():
                base = base_spans(text) if text else []
                spans = base + added_spans(text, base, model) if text else []
                texts.append(redacted(text, spans) if spans else text)
            if sizes_at is not None:
                old, sizes = columns[text_at].to_pylist(), columns[sizes_at].to_pylist()
                new = [n if n is None or a == b else len(b) for n, a, b in zip(sizes, old, texts, strict=True)]
                columns[sizes_at] = pa.array(new, columns[sizes_at].type)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.record_batch(columns, names=names)

    return docs.mapInArrow(run, schema)
