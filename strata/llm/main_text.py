"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node that is content or not.  A node's own potential comes from its tag, its names and its text;
a potential for each parent and child says how their states go together.  Messages up and down the tree (sum-product)
give each node its exact marginal, and the blocks of nodes that are likely content make the text.  The weights maximise
the exact likelihood of labelled pages: composed ones, whose parts are known, and a bounded sample of the table's own pages
that mark their article.

Scripts, styles, form controls, embedded media, comments in the markup and the page's head are never text; formulas are.
A control or media element without its closing tag takes nothing with it beyond the next block or its parent's end.  Character references are
decoded, white space inside a block becomes one space, and blocks are joined by a newline in page order.  Null and empty
pages have the empty text.  Unclosed and stray tags are taken as browsers mostly do: a new block ends an open paragraph.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages to learn from: composed, and of the table at most; rounds, rate, penalty.
COMPOSED, SAMPLED, ROUNDS, RATE, PENALTY = 300, 100, 10, 0.1, 1e-3

#: Elements by how they take part in the text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr "
    "math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mmultiscripts mprescripts mpadded mphantom "
    "mspace mstyle mtable mtr mlabeledtr mtd menclose merror maction semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text has no markup and ends at their closing tag only, or with the page.
RAW = frozenset("script style title textarea".split())
#: Dropped with all they hold: see hidden_end for those without a closing tag.  An annotation is a formula's source, not shown.
HIDDEN = frozenset("noscript template iframe object svg select button canvas audio video annotation annotation-xml".split())
#: Of these one cannot hold another: the second ends the first.
NOT_NESTED = frozenset("button select".split())
#: What ends an element of HIDDEN that has no closing tag.
BLOCKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 article section main aside nav header footer form ul ol dl li dt dd table blockquote pre figure figcaption "
    "address details summary fieldset center body".split()
)
#: Parts of a formula that stand apart.
APART = frozenset("br mtr mtd mspace".split())
#: Elements that a start tag ends when they are open: by the starting element.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
#: What ends the search for an element to be ended.
SCOPES = frozenset("ul ol dl table article section div main aside nav header footer form body blockquote td th".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
NAMES = re.compile(r"""(?:class|id|role|itemprop|data-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
NAME_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])|[01]")

#: Name words by what they stand for.
NAMED = {
    "content": "article content entry post story main body text prose hentry article-body markdown",
    "menu": "nav menu navbar breadcrumb breadcrumbs toc pagination pager tabs skip topbar",
    "frame": "header footer masthead copyright colophon banner head foot legal imprint site",
    "side": "sidebar side aside related recommended recommendations widget more popular trending tags links rail teaser",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe promo signup disclaimer warning",
    "advert": "ad ads advert advertisement adsense sponsor sponsored dfp banner promo promotion",
    "comment": "comment comments reply replies respond disqus discussion commentlist reader",
    "form": "form search login signin register contact share social toolbar buttons controls",
}
WORD_KINDS: dict[str, tuple[str, ...]] = {}
for _kind, _words in NAMED.items():
    for _word in _words.split():
        WORD_KINDS[_word] = (*WORD_KINDS.get(_word, ()), _kind)


class Node:
    __slots__ = ("tag", "parent", "names", "within", "blocks", "size", "linked", "marks")

    def __init__(self, tag: str, parent: int, names: str, within: bool = False) -> None:
        self.tag, self.parent, self.names, self.within = tag, parent, names, within or tag in ("article", "main")
        self.blocks, self.size, self.linked, self.marks = 0, 0, 0, 0


class Closings:
    """Where closing tags are, found as they are asked for: positions asked for do not go down."""

    def __init__(self, page: str) -> None:
        self.page, self.nexts, self.ends = page, {}, {}

    def after(self, tag: str, at: int) -> int:
        """The next closing tag, or the page's length."""
        known = self.nexts.get(tag, -1)
        if known < at:
            found = re.compile(rf"</{re.escape(tag)}(?![^\s/>])", re.IGNORECASE).search(self.page, at)
            known = self.nexts[tag] = found.start() if found else len(self.page)
        return known


def raw_end(page: str, at: int, tag: str) -> int:
    found = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
    return found.end() if found else len(page)


def hidden_end(page: str, at: int, tag: str, parents: set[str], closings: Closings) -> int:
    """Where an element of HIDDEN ends whose start tag ends at ``at``: behind its closing tag; without one in its parent
    before the first block in it, or where its parent ends."""
    close = closings.after(tag, at)
    # Known from an earlier one of its kind: no closing tag before the end of the parent.
    closable = close < len(page) and not at < closings.ends.get(tag, 0) <= close
    opened, first = [tag], None
    while found := MARKUP.search(page, at):
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            if name in opened:
                while opened.pop() != name:
                    pass
                if not opened:
                    return at
            elif name in parents:
                closings.ends[tag] = found.start()
                return found.start() if first is None else first
        elif name == tag and tag in NOT_NESTED:
            return found.start() if first is None else first
        elif name in BLOCKS and first is None and not closable:
            return found.start()
        elif not (found[3] or found[6] or "").rstrip().endswith("/") and name not in VOID:
            if name in RAW and tag != "svg":
                at = raw_end(page, at, name)
                continue
            if name in BLOCKS and first is None:
                first = found.start()
            opened.append(name)
    closings.ends[tag] = len(page)
    return len(page) if first is None else first


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block elements of a page in document order, and its text blocks as (node, text)."""
    nodes, blocks = [Node("", -1, "")], []
    stack = [0]
    buffer: list[str] = []
    in_link, linked, at = 0, 0, 0
    inline: list[str] = []
    closings = Closings(page)

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                node = nodes[stack[-1]]
                node.blocks += 1
                node.size += len(text)
                node.linked += min(len(text), linked)
                node.marks += text.count(".") + text.count(",") + text.count("!") + text.count("?")
                blocks.append((stack[-1], text))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = entities.unescape(text) if "&" in text else text
            buffer.append(text)
            if in_link:
                linked += len(text.strip())

    while found := MARKUP.search(page, at):
        add(page[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            if found[0].startswith("<![CDATA["):
                add(found[0][9:].removesuffix("]]>"))
            continue
        tag, closing, rest = tag.lower(), bool(found[1] or found[4]), found[3] or found[6] or ""
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag in APART:
                buffer.append(" ")
            if closing:
                if tag in inline:
                    while inline.pop() != tag:
                        pass
            elif tag not in VOID and len(inline) < 64:
                inline.append(tag)
            continue
        if tag in RAW or tag in HIDDEN:
            if not closing and not rest.rstrip().endswith("/"):
                if tag in RAW:
                    at = raw_end(page, at, tag)
                else:
                    at = hidden_end(page, at, tag, {nodes[n].tag for n in stack[1:]}.union(inline), closings)
            buffer.append(" ")
            continue
        flush()
        inline.clear()
        in_link = 0
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
                if tag == "p" and nodes[stack[depth]].tag in SCOPES:
                    break
            continue
        if nodes[stack[-1]].tag == "p":
            stack.pop()
        ended = ENDED_BY.get(tag, ())
        while len(stack) > 1 and (nodes[stack[-1]].tag in ended or nodes[stack[-1]].tag == "p" and ended):
            stack.pop()
        if tag in VOID:
            continue
        names = " ".join(m.strip("\"'") for m in NAMES.findall(rest)) if rest else ""
        nodes.append(Node(tag, stack[-1], names, nodes[stack[-1]].within))
        if not rest.rstrip().endswith("/"):
            stack.append(len(nodes) - 1)
    add(page[at:])
    flush()
    return nodes, blocks


def node_features(node: Node) -> list[str]:
    out = ["any", "tag " + node.tag, f"within {node.within}"]
    if node.names:
        out += sorted({f"name {kind}" for word in NAME_WORD.findall(node.names) for kind in WORD_KINDS.get(word.lower(), ())})
    if node.size:
        each = node.size // node.blocks
        out.append(f"size {min(8, each.bit_length())}")
        out.append(f"links {4 * node.linked // node.size}")
        out.append(f"marks {min(4, 100 * node.marks // node.size)}")
    else:
        out.append("no text")
    return out


TEXT_TAGS = frozenset("p li h1 h2 h3 h4 h5 h6 td th dt dd pre blockquote figcaption tr caption".split())


def log_add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def chance(odds: float) -> float:
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


class Model:
    """Log-linear potentials: of a node's features, and of the states of parent and child by kind of child."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.pairs = {text: [[0.0, 0.0], [0.0, 0.0]] for text in (False, True)}

    def own(self, features: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def messages(self, nodes: list[Node], own: list[float]) -> tuple[list[float], list[float], list[float]]:
        """Log-odds of each node with its subtree, of the messages to its parent, and with the whole tree."""
        up, sent = list(own), [0.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            (p00, p01), (p10, p11) = self.pairs[nodes[i].tag in TEXT_TAGS]
            sent[i] = log_add(p11 + up[i], p10) - log_add(p01 + up[i], p00)
            up[nodes[i].parent] += sent[i]
        full = [up[0], *[0.0] * (len(nodes) - 1)]
        for i in range(1, len(nodes)):
            (p00, p01), (p10, p11) = self.pairs[nodes[i].tag in TEXT_TAGS]
            rest = full[nodes[i].parent] - sent[i]
            full[i] = up[i] + log_add(p11 + rest, p01) - log_add(p10 + rest, p00)
        return up, sent, full

    def marginals(self, nodes: list[Node]) -> list[float]:
        return [chance(odds) for odds in self.messages(nodes, [self.own(node_features(n)) for n in nodes])[2]]

    def update(self, nodes: list[Node], features: list[list[str]], labels: list[int], rate: float) -> None:
        """One ascent step of the log-likelihood of a labelled page: observed less expected features."""
        up, sent, full = self.messages(nodes, [self.own(f) for f in features])
        slopes = {text: [[0.0, 0.0], [0.0, 0.0]] for text in (False, True)}
        for i, node in enumerate(nodes):
            slope = labels[i] - chance(full[i])
            for f in features[i]:
                w = self.weights.get(f, 0.0)
                self.weights[f] = w + rate * (slope - PENALTY * w)
            if i:
                text, rest = node.tag in TEXT_TAGS, full[node.parent] - sent[i]
                pair = self.pairs[text]
                joint = [[pair[p][c] + p * rest + c * up[i] for c in (0, 1)] for p in (0, 1)]
                top = max(map(max, joint))
                weight = [[math.exp(x - top) for x in row] for row in joint]
                total = sum(map(sum, weight))
                for p in (0, 1):
                    for c in (0, 1):
                        slopes[text][p][c] += (labels[node.parent] == p and labels[i] == c) - weight[p][c] / total
        for text, table in slopes.items():
            for p in (0, 1):
                for c in (0, 1):
                    w = self.pairs[text][p][c]
                    self.pairs[text][p][c] = w + rate * (max(-5.0, min(5.0, table[p][c])) - PENALTY * w)


# --- labelled pages --------------------------------------------------------------------------------------------


def composed_page(draw: random.Random) -> str:
    """A page of parts that are known to be content (data-label 1) or not (0)."""
    syllables = "ka lo mi ne ru sa te vi zo dan per lis mor en ti ga".split()
    word = lambda: "".join(draw.choices(syllables, k=draw.randint(1, 4)))
    words = lambda low, high: " ".join(word() for _ in range(draw.randint(low, high)))
    sentence = lambda low=4, high=20: words(low, high).capitalize() + draw.choice(".....!?")
    text = lambda n: " ".join(sentence() + "," * draw.randint(0, 1) for _ in range(draw.randint(1, n)))
    pick = draw.choice
    links = lambda n: "<ul>" + "".join(f"<li><a href=/x>{words(1, 3)}</a></li>" for _ in range(n)) + "</ul>"

    def part(tag: str, names: str, inside: str, label: int) -> str:
        named = pick([f' class="{pick(names.split())}"', f' id="{pick(names.split())}"']) if names and draw.random() < 0.7 else ""
        return f'<{tag}{named} data-label="{label}">{inside}</{tag}>'

    def comments() -> str:
        each = "".join(f"<{pick(['div', 'li', 'p', 'article'])} class={pick(['comment', 'reply', 'comment-body'])}><p>{text(2)}</p></div>" for _ in range(draw.randint(1, 5)))
        return f'<{(t := pick(["section", "div", "ol"]))} {pick(["class", "id"])}="{pick(["comments", "comment-list", "replies", "disqus_thread", "respond"])}" data-label="0"><h3>{words(1, 3)}</h3>{each}</{t}>'

    around = [
        part("nav", "menu navbar", links(draw.randint(2, 8)), 0),
        part(pick(["header", "div"]), "header masthead site-header", f"<h1>{words(1, 4)}</h1><p>{words(2, 8)}</p>" + links(draw.randint(0, 5)), 0),
        part(pick(["aside", "div"]), "sidebar related widget", f"<h3>{words(1, 3)}</h3>" + pick([links(4), f"<p>{text(2)}</p>"]), 0),
        f'<div class="{pick(["ad", "ads", "advert", "sponsored", "ad-slot"])}" data-label="0">{pick([sentence(), f"<p>{text(2)}</p>"])}</div>',
        f'<div {pick(["class", "id"])}="{pick(["cookie-notice", "consent", "newsletter", "alert", "popup"])}" data-label="0"><p>{text(2)}</p></div>',
        f'<form {pick(["", "class=search", "class=login"])} data-label="0">{words(1, 3)} <input name=q> <p>{sentence(2, 6)}</p></form>',
    ]
    body = [f"<h1>{words(3, 9).capitalize()}</h1>"] * draw.randint(0, 1)
    for _ in range(pick([1, 2, 3, 5, 9])):
        body.append(pick([
            f"<p>{text(6)}</p>", f"<p>{text(4)}</p>", f"<p><b>{sentence()}<br><p>{text(3)}</p>", f"<p>{sentence(1, 5)}</p>", f"<div>{text(4)}</div>",
            f"<h2>{words(1, 6)}</h2>", f"<h3>{words(1, 6)}</h3>", f"<blockquote><p>{text(2)}</p></blockquote>", "<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(3)) + "</ul>",
            f"<table><tr><td>{words(1, 3)}<td>{words(1, 4)}</tr></table>", f"<p>{sentence()} <a href=/y>{words(1, 4)}</a> {sentence()}</p>", f"<pre>{words(3, 30)}</pre>",
        ]))
        if draw.random() < 0.15:
            body.append(pick(around[2:]))
    if draw.random() < 0.3:
        body.append(comments())
    main = part(pick(["article", "article", "main", "div", "section"]), "content post entry article-body", "".join(body), 1)
    if draw.random() < 0.3:
        main = f'<div data-label="1" class="{pick(["wrap", "container", "main"])}">{main}</div>'
    before = draw.sample(around, draw.randint(0, 4))
    after = [comments()] * (draw.random() < 0.4) + draw.sample(around, draw.randint(0, 3))
    after.append(part(pick(["footer", "footer", "div"]), "footer copyright", f"&copy; {words(1, 3)} &middot; {pick([sentence(), links(3)])}", 0))
    return f"<html><head><title>x</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def composed_labels(nodes: list[Node]) -> list[int]:
    labels = [0]
    for node in nodes[1:]:
        marked = re.search(r"(?:^| )([01])(?: |$)", node.names)
        labels.append(int(marked[1]) if marked else labels[node.parent])
    return labels


#: Elements and kinds of names that are no content within an article that is marked as such.
OTHER_TAGS = frozenset("nav aside footer header form".split())
OTHER_KINDS = frozenset({"name menu", "name advert", "name comment", "name notice", "name side", "name form"})


def marked_labels(nodes: list[Node]) -> list[int] | None:
    """Labels of a page that marks its article; none if it marks none."""
    labels, marked = [0], False
    for node in nodes[1:]:
        inside = labels[node.parent] or node.tag in ("article", "main")
        marked |= node.tag in ("article", "main")
        labels.append(int(inside and node.tag not in OTHER_TAGS and not OTHER_KINDS.intersection(node_features(node))))
    return labels if marked else None


def train(pages: list[str]) -> Model:
    """Fit a model to composed pages and to those of ``pages`` that mark their article."""
    draw = random.Random(5)
    examples = []
    for page in (composed_page(draw) for _ in range(COMPOSED)):
        nodes, _ = parse(page)
        examples.append((nodes, composed_labels(nodes)))
    for page in pages:
        nodes, _ = parse(page)
        if labels := marked_labels(nodes):
            examples.append((nodes, labels))
    for nodes, _ in examples:
        for node in nodes:
            node.names = re.sub(r"(?:^| )[01](?= |$)", "", node.names)
    featured = [(nodes, [node_features(n) for n in nodes], labels) for nodes, labels in examples]
    model = Model()
    for n in range(ROUNDS):
        draw.shuffle(featured)
        for example in featured:
            model.update(*example, RATE / (1 + 0.3 * n))
    return model


# --- extraction ------------------------------------------------------------------------------------------------


def extract(page: str | None, model: Model) -> str:
    if not page:
        return ""
    nodes, blocks = parse(page)
    if not blocks:
        return ""
    likely = model.marginals(nodes)
    return "\n".join(text for node, text in blocks if likely[node] >= 0.5)


def fitted(pages: DataFrame) -> Model:
    """A model from composed pages and at most ``SAMPLED`` pages of up to 200,000 characters, drawn and ordered by a hash of
    their html, so that the same pages in another layout give the same model."""
    some = pages.select(F.col("html").cast("string").alias("html")).filter(F.length("html").between(1, 200_000))
    share = SAMPLED / max(SAMPLED, some.count())
    drawn = some.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(2 * share * (1 << 30)))
    drawn = drawn.orderBy(F.xxhash64("html"), "html").limit(SAMPLED)
    return train([r["html"] for r in drawn.collect()])


def main_texts(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    model = model or fitted(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, model) for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
