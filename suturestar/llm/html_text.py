"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks: the runs of text between block-level tags, each with the path of elements
above it.  A bidirectional LSTM in numpy reads one vector per block (hashed tags, classes and ids of the path; hashed
words; a few shares) and labels every block with the whole page in view.  Blocks labelled as main text are joined.

No page is labelled, so the labeller is trained on what mark-up says by itself: pages with an article or main element
whose other parts are named (navigation, asides, forms, comments and so on; see TEACHER).  At most `pages` of them,
all different and drawn by a hash, are used as they are and rearranged: their blocks are put into other containers and parts of other
names are set around and into them, so that the labeller learns the names and the surroundings, not one template.
It never sees the teacher's verdict on the page it labels.

Character references are decoded, white space inside a block becomes one space, empty blocks go.  Comments, scripts,
styles, templates, the head, and closed noscript, svg, iframe, object and canvas elements hold no text; never closed,
the latter and templates hide nothing.  The head ends at the first tag or text that cannot stand in it.  Unclosed and stray tags are closed as browsers do for paragraphs, list
items and table cells.  Null, empty or textless pages give the empty text.  Repeated rows are labelled each; input
columns named like an output column are replaced.  Without any page to learn from all blocks count as main text.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.frames import read

PAGES = 240
PATH_BUCKETS = 192
WORD_BUCKETS = 32
SHARES = 8
SIZE = PATH_BUCKETS + WORD_BUCKETS + SHARES
HIDDEN = 24
EPOCHS = 8
BATCH = 24
RATE = 0.01
LONGEST_TRAINED = 160
LABEL_CELLS = 6_000

# Element names.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre search section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template noscript svg iframe object canvas".split())
IN_HEAD = frozenset("head html title meta link base basefont bgsound style script noscript noframes template".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table div section article aside nav main body form select".split())
# What names say about a part (fixed values).
TEACHER_TAGS = frozenset("nav aside footer form button select label dialog menu search".split())
TEACHER_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer "
    "form gdpr login menu modal nav navbar navigation newsletter notice popup promo promoted related reply respond share sharing "
    "sidebar signup social sponsor sponsored subscribe toc toolbar widget".split()
)
# A quote counts only right after an attribute's equals sign.
VALUES = r"""(?>[^>=]++|=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)|=)*+"""
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)({VALUES})>", re.S)
SKIPPED_TAG = re.compile(rf"<(/?)(template|noscript|svg|iframe|object|canvas)(?=[\s/>])({VALUES})>", re.I)
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "title")}
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


@dataclass
class Block:
    path: tuple[tuple[str, tuple[str, ...]], ...]
    text: str
    linked: int


def _names(attributes: str) -> tuple[str, ...]:
    """The words of an element's classes, id and role."""
    if not attributes or "=" not in attributes:
        return ()
    found = []
    for _, value in ATTRIBUTE.findall(attributes):
        found += re.findall(r"[a-z]+", value.lower())
    return tuple(found)


def _ends(page: str) -> dict[int, int]:
    """Where each skipped element that is closed ends, by where it starts."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in SKIPPED_TAG.finditer(page):
        above = opened.setdefault(m[2].lower(), [])
        if not m[1]:
            if not m[3].endswith("/"):
                above.append(m.start())
        elif above:
            out[above.pop()] = m.end()
    return out


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order."""
    page = page or ""
    out: list[Block] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(tuple(e for e in path if e[0] in BLOCKS or e[1]), text, linked))
            parts.clear()
        linked = 0

    def close(names, until=frozenset()) -> None:
        """Close the innermost element of one of the names, if it is above any of `until`."""
        for i in range(len(path) - 1, -1, -1):
            if path[i][0] in names:
                flush()
                del path[i:]
                return
            if path[i][0] in until:
                return

    at, head, ends = 0, False, None
    while m := TAG.search(page, at):
        if m.start() > at:
            head = head and not page[at : m.start()].strip()
            if not head:
                parts.append(page[at : m.start()])
                linked += links and m.start() - at
        at = m.end()
        if m[2] is None:
            continue
        tag, ending = m[2].lower(), m[1] == "/"
        if tag == "head":
            flush()
            head = not ending
            continue
        # The first tag that cannot stand in the head ends it, also without </head> and <body>.
        head = head and (tag in IN_HEAD or ending and tag != "body")
        if tag in ("script", "style") or head and tag == "title":
            if not ending and not m[3].endswith("/"):
                stop = RAW_END[tag].search(page, at)
                at = stop.end() if stop else at if tag == "title" else len(page)
            continue
        if tag in SKIPPED:
            if not ending and not m[3].endswith("/"):
                ends = _ends(page) if ends is None else ends
                # One that is never closed is read on as if its tag were not there.
                at = ends.get(m.start(), at)
            continue
        if head:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 0 if ending else 1
        elif ending:
            if tag in BLOCKS:
                flush()
            if any(e[0] == tag for e in path):
                close({tag}) if tag in BLOCKS else _drop(path, tag)
        elif tag in BLOCKS:
            flush()
            close({"p"}, HOLDS)
            if tag in CLOSES:
                close(CLOSES[tag], HOLDS)
            if tag not in VOID:
                path.append((tag, _names(m[3])))
        elif tag not in VOID:
            names = _names(m[3])
            path.append((tag, names))
    if at < len(page) and not (head and not page[at:].strip()):
        parts.append(page[at:])
    flush()
    return out


def _drop(path: list, tag: str) -> None:
    """Remove the innermost inline element of a name, unless a block was opened in it."""
    for i in range(len(path) - 1, -1, -1):
        if path[i][0] == tag:
            del path[i]
            return
        if path[i][0] in BLOCKS:
            return


# ---------------------------------------------------------------- vectors


@cache
def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % PATH_BUCKETS


@cache
def _path_vector(path: tuple) -> np.ndarray:
    out = np.zeros(PATH_BUCKETS, np.float32)
    for tag, names in path:
        out[_bucket(tag)] = 1
        for n in names:
            out[_bucket("." + n)] = 1
    if path:
        out[_bucket("leaf " + path[-1][0])] = 1
    return out


class _Words(dict):
    def __missing__(self, w: str) -> int:
        if len(self) > 300_000:
            self.clear()
        b = self[w] = zlib.crc32(w.encode("utf-8", "replace")) % WORD_BUCKETS
        return b


_words = _Words()


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block."""
    if _path_vector.cache_info().currsize > 20_000:
        _path_vector.cache_clear()
        _bucket.cache_clear()
    out = np.zeros((len(page), SIZE), np.float32)
    if not page:
        return out
    heard: list[int] = []
    counts, shares = [], []
    for i, b in enumerate(page):
        out[i, :PATH_BUCKETS] = _path_vector(b.path)
        text, ws = b.text, b.text.split()
        n, m = len(text), len(ws)
        heard.extend(map(_words.__getitem__, ws))
        counts.append(m)
        shares.append(
            (
                math.log1p(m) / 5,
                min(1.0, b.linked / n),
                text.count(".") / m,
                text.count(",") / m,
                text[-1] in ".!?",
                i / len(page),
                len(b.path) / 10,
                n / m / 10,
            )
        )
    cell = np.repeat(np.arange(len(page)) * WORD_BUCKETS, counts) + heard
    bags = np.bincount(cell, minlength=len(page) * WORD_BUCKETS).reshape(len(page), WORD_BUCKETS)
    out[:, PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = bags / (np.sqrt((bags * bags).sum(1, keepdims=True)) + 1e-6)
    out[:, -SHARES:] = shares
    return out


# ---------------------------------------------------------------- the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _start() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(11)
    out = {}
    for d in "fb":
        out[f"x{d}"] = rng.normal(0, 1 / np.sqrt(SIZE), (SIZE, 4 * HIDDEN))
        out[f"h{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        out[f"c{d}"] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
    return out | {"w": rng.normal(0, 0.2, 2 * HIDDEN), "v": np.zeros(1)}


def _pass(p: dict, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
    """States of one direction; with `keep` also what the gradient needs.  Masked steps carry the state on."""
    n, steps, _ = x.shape
    pre = x @ p[f"x{d}"] + p[f"c{d}"]
    h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
    out, trace = np.zeros((n, steps, HIDDEN), x.dtype), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = pre[:, t] + h @ p[f"h{d}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[:, t : t + 1]
        c2 = f * c + i * g
        s = np.tanh(c2)
        if keep:
            trace.append((t, i, f, o, g, c, s, h, m))
        c = m * c2 + (1 - m) * c
        h = m * (o * s) + (1 - m) * h
        out[:, t] = h
    return out, trace


def _back(p: dict, d: str, x: np.ndarray, dout: np.ndarray, trace: list, grad: dict) -> None:
    n = len(x)
    dz_all = np.zeros((n, x.shape[1], 4 * HIDDEN), x.dtype)
    dh, dc = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
    for t, i, f, o, g, c, s, h, m in reversed(trace):
        dh = dh + dout[:, t]
        live = dh * m
        dc2 = dc * m + live * o * (1 - s * s)
        dz = np.concatenate((dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), live * s * o * (1 - o), dc2 * i * (1 - g * g)), 1)
        dz_all[:, t] = dz
        grad[f"h{d}"] += h.T @ dz
        dh = dh * (1 - m) + dz @ p[f"h{d}"].T
        dc = dc * (1 - m) + dc2 * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    grad[f"x{d}"] += x.reshape(-1, x.shape[2]).T @ flat
    grad[f"c{d}"] += flat.sum(0)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, SIZE), np.float32), np.zeros((len(pages), steps), np.float32)
    for k, v in enumerate(pages):
        x[k, : len(v)], mask[k, : len(v)] = v, 1
    return x, mask


def probabilities(p: dict, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Each block's probability of being main text, for pages labelled together by similar length."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    while order:
        # The last one is the longest; the padded batch stays below LABEL_CELLS blocks, or is one page.
        group = order[-max(1, LABEL_CELLS // len(pages[order[-1]])) :]
        del order[-len(group) :]
        x, mask = _padded([pages[k] for k in group])
        hidden = np.concatenate([_pass(p, d, x, mask, False)[0] for d in "fb"], 2)
        chance = _sigmoid(hidden @ p["w"] + p["v"])
        for row, k in enumerate(group):
            out[k] = chance[row, : len(pages[k])]
    return out


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Adam over padded batches of pages of similar length."""
    p = {k: v.astype(np.float32) for k, v in _start().items()}
    one, two = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    rng, t = np.random.default_rng(12), 0
    order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            x, mask = _padded([pages[k] for k in batches[b]])
            y = np.zeros_like(mask)
            for row, k in enumerate(batches[b]):
                y[row, : len(labels[k])] = labels[k]
            both = [_pass(p, d, x, mask, True) for d in "fb"]
            hidden = np.concatenate([s for s, _ in both], 2)
            error = (_sigmoid(hidden @ p["w"] + p["v"]) - y) * mask / mask.sum()
            grad = {k: np.zeros_like(v) for k, v in p.items()}
            grad["w"] += np.einsum("bt,bth->h", error, hidden)
            grad["v"] += error.sum()
            down = error[:, :, None] * p["w"]
            for k, d in enumerate("fb"):
                _back(p, d, x, down[:, :, k * HIDDEN : (k + 1) * HIDDEN], both[k][1], grad)
            t += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k in p:
                g = grad[k] / max(1.0, norm)
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.999 * two[k] + 0.001 * g * g
                p[k] -= (RATE * (one[k] / (1 - 0.9**t)) / (np.sqrt(two[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return p


# ---------------------------------------------------------------- what to learn from


def teacher(page: list[Block]) -> np.ndarray | None:
    """Labels that the mark-up's names give; None where it names no main part."""
    labels, named = np.zeros(len(page), np.float32), False
    for i, b in enumerate(page):
        inside = outside = False
        for tag, names in b.path:
            inside |= tag in ("article", "main")
            outside |= tag in TEACHER_TAGS or any(n in TEACHER_NAMES for n in names)
        named |= inside
        labels[i] = inside and not outside
    return labels if named else None


# Parts to set around or into a page's own blocks; {} takes words (fixed values).
PARTS = (
    '<header class="site-header"><div class="logo">{}</div><p class="tagline">{}</p></header>',
    '<header><a href="/">{}</a><nav><a>{}</a> <a>{}</a></nav></header>',
    '<ul class="menu"><li><a>{}</a></li><li><a>{}</a></li><li><a>{}</a></li></ul>',
    '<div class="breadcrumbs"><a>{}</a> / <a>{}</a></div>',
    '<aside><h3>{}</h3><p>{} {} {}.</p></aside>',
    '<aside class="sidebar"><h3>{}</h3><ul><li><a>{} {}</a></li><li><a>{} {}</a></li></ul></aside>',
    '<div class="sidebar"><p>{} {} {} {}.</p><p>{} {}.</p></div>',
    '<div class="cookie-notice"><p>{} {} {} {} {}.</p><button>{}</button></div>',
    '<div class="notice">{} {} {}.</div>',
    '<div class="advert">{} {} {} {}.</div>',
    '<div class="ads banner"><p>{} {} {}.</p></div>',
    '<div class="ad">{} {} {}</div>',
    '<form action="/s"><label>{}</label><input name="q"><button>{}</button></form>',
    '<form class="newsletter signup"><p>{} {} {}.</p><input type="email"><button>{}</button></form>',
    '<section class="comments" id="comments"><h2>{}</h2><div class="comment"><p>{} {} {} {} {}.</p></div><div class="comment"><p>{} {} {}.</p></div></section>',
    '<div id="comments"><p>{} {} {} {}.</p><p>{} {} {} {} {} {}.</p></div>',
    '<div class="comment-list"><article class="comment"><p>{} {} {} {}.</p></article></div>',
    '<div class="related-posts"><h3>{}</h3><ul><li><a>{} {}</a></li><li><a>{} {}</a></li></ul></div>',
    '<div class="share social">{} {}</div>',
    '<div class="popup modal"><p>{} {} {}.</p></div>',
    '<footer><p>&copy; {} {}</p><ul><li><a>{}</a></li><li><a>{}</a></li></ul></footer>',
    '<div id="footer" class="site-footer">&copy; {} {} {}</div>',
)
CONTAINERS = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div id="content"><article>{}</article></div>',
    '<div class="wrapper"><main class="main">{}</main></div>', '<div class="page"><article class="post entry"><div class="post-body">{}</div></article></div>',
    '<div class="content article-body">{}</div>', '<div id="main-content">{}</div>', '<section class="story">{}</section>',
)
INNER = ("<p>{}</p>",) * 8 + ("<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", "<pre>{}</pre>", "<div>{}</div>", "<p><b>{}</b></p>", "<table><tr><td>{}</td></tr></table>", "<figure><figcaption>{}</figcaption></figure>")
MARK = "\u0001"


def rearranged(page: list[Block], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page's main blocks in another container, with parts around and among them, and the labels."""
    words = " ".join(b.text for b in page).split()

    def part() -> str:
        shape = PARTS[rng.integers(len(PARTS))]
        fill = [" ".join(words[int(k) : int(k) + int(rng.integers(1, 8))]) for k in rng.integers(0, len(words), shape.count("{}"))]
        return shape.format(*map(html.escape, fill))

    body = []
    for k, b in enumerate(b for b, y in zip(page, labels) if y):
        shape = "<h1>{}</h1>" if k == 0 and rng.random() < 0.7 else INNER[rng.integers(len(INNER))]
        body.append(shape.format(html.escape(b.text) + MARK))
        if rng.random() < 0.08:
            body.append(part())
    around = [part() for _ in range(int(rng.integers(1, 5)))], [part() for _ in range(int(rng.integers(1, 5)))]
    inside = CONTAINERS[rng.integers(len(CONTAINERS))].format("".join(body))
    made = blocks("<body>" + "".join(around[0]) + inside + "".join(around[1]) + "</body>")
    new = np.array([MARK in b.text for b in made], np.float32)
    return [Block(b.path, b.text.replace(MARK, "").strip() or "-", b.linked) for b in made], new


def lesson(pages: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors and labels to train on."""
    rng = np.random.default_rng(13)
    xs, ys = [], []
    for page in pages:
        own = blocks(page)
        labels = teacher(own)
        if labels is None or not len(own):
            continue
        made = [(own, labels)]
        if labels.any():
            made += [rearranged(own, labels, rng) for _ in range(2)]
        for b, y in made:
            for at in range(0, len(b), LONGEST_TRAINED):
                xs.append(vectors(b)[at : at + LONGEST_TRAINED])
                ys.append(y[at : at + LONGEST_TRAINED])
    return xs, ys


def fit(pages: DataFrame, limit: int = PAGES, page: str = "html") -> dict[str, np.ndarray] | None:
    """A labeller trained on at most `limit` pages, which bounds what the driver takes."""
    able = pages.select(F.col(page).alias("html"), F.xxhash64(page).alias("h")).filter(F.col("html").rlike(r"(?i)<(article|main)[\s/>]"))
    # Copies and pages that name no main part take no place; tasks send hashes only.
    drawn = [r.h for r in able.select("h").distinct().orderBy("h").limit(limit).collect()]
    rows = sorted(able.filter(F.col("h").isin(drawn)).groupBy("h").agg(F.min("html").alias("html")).collect())
    xs, ys = lesson([r.html for r in rows])
    return train(xs, ys) if xs else None


def main_texts(p: dict | None, pages: list[str | None]) -> list[str]:
    found = [blocks(page) for page in pages]
    if p is None:
        return ["\n\n".join(b.text for b in page) for page in found]
    chances = probabilities(p, [vectors(page) for page in found])
    return ["\n\n".join(b.text for b, c in zip(page, chance) if c >= 0.5) for page, chance in zip(found, chances)]


def extracted(page: Column, model: dict | None) -> Column:
    @F.arrow_udf("string")
    def text(pages: pa.Array) -> pa.Array:
        rows, out = pages.to_pylist(), []
        for at in range(0, len(rows), 512):
            out += main_texts(model, rows[at : at + 512])
        return pa.array(out, pa.string())

    return text(page)


def op6_recurrent_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = pages.select("page_id", "url", extracted(F.col("html"), fit(pages)).alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
