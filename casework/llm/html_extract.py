"""Main text of web pages by a tree-structured graphical model.

Every DOM node (element or text) has a hidden state, content or not. Potentials
connect each node with its parent (how often a content parent has a content
child, by kind of child) and with what is seen of it (tag, class and id words,
length of a text, whether it is within a link). Sum-product messages go from
the leaves to the root and back; a text is kept when its marginal says content.

The potentials are trained by counting on a bounded sample of labelled pages:
those with an ``article`` or ``main`` landmark, whose content is the landmark
without the parts that name themselves boilerplate. Pages without a landmark
are then decided by the same model. Fixed prior counts stand for words that
the sample may lack.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import record_batch, table

TRAIN_PAGES = 2_000       # labelled pages counted, about
MOST_FEATURES = 20_000    # features kept of the counts, the most frequent ones
PRIOR = 20.0              # prior count of a parent-child potential and of a content word
SURE = 40.0               # log-odds of a word or tag that names boilerplate or a landmark
IN_LINK = 20.0            # prior count of a text in a link as boilerplate
SMOOTH = 0.5

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe select option".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr math mi mn mo ms mrow mtext msub msup mfrac msqrt semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# fixed values: words that name boilerplate and content in tags, classes, ids and roles
LANDMARK_TAGS = frozenset(("article", "main"))
BOILERPLATE_TAGS = frozenset("aside button dialog footer form head header menu nav".split())
BOILERPLATE_WORDS = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer header login "
                              "masthead menu nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored subscribe "
                              "toolbar widget".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")


class Dom:
    """Nodes in document order: parent, what is seen, text (None: an element)."""

    __slots__ = ("parent", "seen", "text", "kind", "gap")

    def __init__(self):
        self.parent: list[int] = [-1]
        self.kind: list[str] = ["#root"]
        self.seen: list[tuple[str, ...]] = [("t=#root",)]
        self.text: list[str | None] = [None]
        self.gap: list[tuple[int, str]] = []   # (node, text or block border) in page order


def parse(page: str) -> Dom:
    """A forgiving parse: void and raw elements, implied ends of paragraphs,
    list items and cells; an end tag without its start is dropped."""
    dom = Dom()
    stack, names, open_ = [0], ["#root"], Counter(["#root"])
    unclosed: set[str] = set()
    links = 0

    def pop() -> str:
        nonlocal links
        stack.pop()
        name = names.pop()
        open_[name] -= 1
        links -= name == "a"
        return name

    def add_text(raw: str):
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if text.isspace():
            dom.gap.append((-1, " "))
            return
        n = len(text.split())
        marks = sum(text.count(c) for c in ".,;:!?")
        dom.gap.append((len(dom.parent), text))
        dom.parent.append(stack[-1])
        dom.kind.append("#text")
        dom.text.append(text)
        dom.seen.append((f"n={min(n.bit_length(), 8)}", f"a={links > 0}", f"m={min((8 * marks) // max(n, 1), 8)}", f"in={'h' if names[-1] in HEADINGS else names[-1]}"))

    def border(name: str):
        if name not in INLINE:
            dom.gap.append((-1, " "))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            add_text(page[at:])
            break
        add_text(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if open_[name]:
                while True:
                    last = pop()
                    border(last)
                    if last == name:
                        break
            elif name not in INLINE:
                dom.gap.append((-1, " "))
            continue
        border(name)
        if name in CLOSES_P and open_["p"]:
            while pop() != "p":
                pass
        elif name in SIBLINGS:
            ends, scope = SIBLINGS[name]
            if any(open_[e] for e in ends):
                k = len(names) - 1
                while names[k] not in ends and names[k] not in scope and k:
                    k -= 1
                if names[k] in ends:
                    while len(names) > k:
                        pop()
        words = {w for _, v in _ATTRIBUTE.findall(m[3]) for w in _WORDS.findall(v.lower())} if m[3] else ()
        dom.parent.append(stack[-1])
        dom.kind.append(name)
        dom.text.append(None)
        dom.seen.append((f"t={'h' if name in HEADINGS else name}", *sorted(f"c={w}" for w in words)))
        if name in VOID:
            continue
        if name in RAW:
            # a name that isn't closed once isn't closed later either
            close = None if name in unclosed else re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if close is None:
                unclosed.add(name)
            if close:
                at = page.find(">", close.end())
                at = end if at < 0 else at + 1
            elif name in ("script", "style", "title", "textarea", "iframe"):
                at = end
            continue
        if m[3].endswith("/") and name in ("path", "g", "use"):
            continue
        stack.append(len(dom.parent) - 1)
        names.append(name)
        open_[name] += 1
        links += name == "a"
    return dom


def labelled(dom: Dom) -> tuple[list[int], list[bool]] | None:
    """(state of each node by its landmarks, is it within boilerplate); None
    for a page without a landmark."""
    state, barred, any_ = [0] * len(dom.parent), [False] * len(dom.parent), False
    for i in range(1, len(dom.parent)):
        p = dom.parent[i]
        words = {s[2:] for s in dom.seen[i] if s.startswith("c=")}
        barred[i] = barred[p] or dom.kind[i] in BOILERPLATE_TAGS or bool(words & BOILERPLATE_WORDS)
        landmark = dom.kind[i] in LANDMARK_TAGS
        any_ |= landmark
        state[i] = int((state[p] or landmark) and not barred[i])
    return (state, barred) if any_ else None


class TreeModel:
    """Log-potentials from counts of (feature, state) and (kind, parent, child)."""

    def __init__(self, counts: dict[str, tuple[float, float]]):
        seen = {k: list(v) for k, v in counts.items() if not k.startswith(">")}
        fixed = [("c", CONTENT_WORDS, 1, PRIOR), ("t", {"p", "h", "blockquote", "pre"}, 1, 1.0), ("a", {"True"}, 0, IN_LINK), ("in", {"a"}, 0, IN_LINK)]
        for kind, names, state, weight in fixed:
            for w in names:
                seen.setdefault(f"{kind}={w}", [0.0, 0.0])[state] += weight
        # log-odds of content where a feature is seen
        self.odds = {k: math.log((yes + SMOOTH) / (no + SMOOTH)) for k, (no, yes) in seen.items()}
        for k in self.odds:
            if not k.startswith("c="):  # tags, and what is seen of a text, say little each
                self.odds[k] /= 4 if k.startswith("t=") else 6
        for kind, names, odds in (("c", BOILERPLATE_WORDS, -SURE), ("t", BOILERPLATE_TAGS, -SURE), ("t", LANDMARK_TAGS, SURE)):
            self.odds.update({f"{kind}={w}": odds for w in names})
        # probability of a content child: [kind of child][parent state]
        self.edge = {}
        for kind, start in (("#text", 0.001), ("#element", 0.05)):
            rows = []
            for parent, prior in ((0, start), (1, 0.9)):
                no, yes = counts.get(f">{kind}{parent}", (0.0, 0.0))
                rows.append((yes + PRIOR * prior) / (no + yes + PRIOR))
            self.edge[kind] = rows

    def marginals(self, dom: Dom) -> list[float]:
        """Log-odds of content of every node."""
        n = len(dom.parent)
        odds = [sum(self.odds.get(s, 0.0) for s in dom.seen[i]) for i in range(n)]
        odds[0] = -20.0
        edges = [self.edge["#text" if t is not None else "#element"] for t in dom.text]
        up, total = [0.0] * n, odds[:]
        # messages to the parent: log-odds, children come after their parents
        for i in range(n - 1, 0, -1):
            x = math.exp(max(-60.0, min(60.0, total[i])))
            q0, q1 = edges[i]
            up[i] = math.log((q1 * x + 1 - q1) / (q0 * x + 1 - q0))
            total[dom.parent[i]] += up[i]
        for i in range(1, n):
            rest = math.exp(max(-60.0, min(60.0, total[dom.parent[i]] - up[i])))
            q0, q1 = edges[i]
            total[i] += math.log((q1 * rest + q0) / ((1 - q1) * rest + 1 - q0))
        return total


def main_text(page: str | None, model: TreeModel) -> str:
    """Texts whose marginal says content, in page order; the white space
    within and between blocks becomes one space."""
    if not page:
        return ""
    dom = parse(page)
    odds = model.marginals(dom)
    return " ".join("".join(text if i < 0 or odds[i] > 0 else " " for i, text in dom.gap).split())


def train(pages: DataFrame, body_col: str = "html", rows: int = TRAIN_PAGES) -> TreeModel:
    """Counts of about ``rows`` labelled pages, chosen by hash."""
    marked = pages.where(F.col(body_col).rlike(r"(?i)<(?:article|main)[\s>]")).select(F.col(body_col))
    count = marked.count()
    part = marked.where(F.pmod(F.xxhash64(body_col), F.lit(1 << 20)) < int(min(1.0, rows / max(count, 1)) * (1 << 20)) + 1)

    def run(batches):
        schema = pa.schema([("feature", pa.string()), ("no", pa.int64()), ("yes", pa.int64())])
        for b in batches:
            counts: dict[str, list[int]] = {}
            for page in b.column(0).to_pylist():
                dom = parse(page or "")
                found = labelled(dom)
                state, barred = found or ([], [])
                for i in range(1, len(state)):
                    kind = "#text" if dom.text[i] is not None else "#element"
                    # within boilerplate a node is explained by its ancestor, not by what it looks like
                    seen = () if barred[dom.parent[i]] else dom.seen[i]
                    edge = () if dom.kind[i] in LANDMARK_TAGS else (f">{kind}{state[dom.parent[i]]}",)
                    for f in (*seen, *edge):
                        counts.setdefault(f, [0, 0])[state[i]] += 1
            if counts:
                yield record_batch(schema, list(counts), *zip(*counts.values()))

    found = part.mapInArrow(run, "feature string, no long, yes long").groupBy("feature").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    top = found.orderBy(F.desc(F.col("no") + F.col("yes")), "feature").limit(MOST_FEATURES).collect()
    return TreeModel({r["feature"]: (float(r["no"]), float(r["yes"])) for r in top})


def extract(pages: DataFrame, model: TreeModel | None = None, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    The whole page is read. A null or empty page, and one without content, has
    the empty text. Rows with equal or null ids stay rows of their own; other
    columns are ignored; an empty table gives no row.
    """
    model = model or train(pages, body_col)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in batches:
            texts = [main_text(p.as_py(), shared.value) for p in b.column(2)]
            yield record_batch(schema, b.column(0), b.column(1), texts, list(map(len, texts)))

    return (pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(body_col))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
