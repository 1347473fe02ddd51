"""HTML extraction: a bidirectional LSTM labels every leaf block of a page."""

from __future__ import annotations

import html
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from mergewell.llm.blocks import Block, blocks_of
from mergewell.llm.rows import with_computed

FIT_PAGES = 160  # pages, chosen by hash, whose blocks the labeller is trained on
FIT_CHARS = 65_536  # longer pages are not used for training
LAYOUTS = 4  # times that the blocks of a page are set in another layout for training
LAYOUT_BLOCKS = 30  # blocks of a page, of the article and of the rest, that a layout is made of
BARE = 0.25  # of the layouts: pages of a few blocks
PATH, WORDS, SHAPE, HIDDEN = 256, 64, 8, 16
EPOCHS, BATCH, RATE = 14, 32, 0.01
KEPT_PATHS = 20_000


def _bucket(word: str, n: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % n


class Features:
    """Vectors of blocks: tag path, hashed words, and the shape of the text."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        known = self.paths.get(path)
        if known is None:
            if len(self.paths) >= KEPT_PATHS:
                self.paths.clear()
            known = np.zeros(PATH, np.float32)
            for word in path:
                known[_bucket(word, PATH)] = 1.0
            if path:
                known[_bucket("last " + path[-1], PATH)] = 1.0
            self.paths[path] = known
        return known

    def text(self, text: str) -> np.ndarray:
        words = text.split(" ")
        known = self.words
        if len(known) > 200_000:
            known.clear()
        places = []
        for word in words:
            bucket = known.get(word)
            if bucket is None:
                bucket = known[word] = _bucket(word.lower(), WORDS)
            places.append(bucket)
        counts = np.log1p(np.bincount(places, minlength=WORDS).astype(np.float32))
        return counts / max(1.0, float(np.sqrt((counts ** 2).sum())))

    def page(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), PATH + WORDS + SHAPE), np.float32)
        for i, block in enumerate(blocks):
            text = block.text
            out[i, :PATH] = self.path(block.path)
            out[i, PATH:PATH + WORDS] = self.text(text)
            out[i, PATH + WORDS:] = (
                np.log1p(len(text)) / 8, block.in_links, text[-1] in ".!?…", i / len(blocks),
                i == 0, text[:1].isupper(), min(1.0, len(block.path) / 16), 1.0)
        return out


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class Labeller:
    """Two LSTMs, one from each end of the page, and a logistic output for every block."""

    def __init__(self, seed: int = 5):
        random = np.random.default_rng(seed)
        n = PATH + WORDS + SHAPE
        draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.weights = {}
        for side in "fb":
            self.weights["x" + side] = draw(n, 4 * HIDDEN) * np.float32(0.5)
            self.weights["h" + side] = draw(HIDDEN, 4 * HIDDEN)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1.0  # remember at first
            self.weights["c" + side] = bias
        self.weights["out"] = draw(2 * HIDDEN, 1)
        self.weights["skip"] = np.zeros((n, 1), np.float32)

    def _side(self, side: str, x: np.ndarray, mask: np.ndarray):
        pages, length, _ = x.shape
        u = self.weights["h" + side]
        drive = x.reshape(-1, x.shape[2]) @ self.weights["x" + side] + self.weights["c" + side]
        drive = drive.reshape(pages, length, -1)
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        states, memory = np.zeros((pages, length, HIDDEN), np.float32), {}
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            z = drive[:, t] + h @ u
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            memory[t] = (h, c, i, f, o, g, squashed)
            c = m * new + (1 - m) * c
            h = m * (o * squashed) + (1 - m) * h
            states[:, t] = h
        return states, memory

    def scores(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits (pages, blocks); with keep also what learning needs."""
        forward, fm = self._side("f", x, mask)
        backward, bm = self._side("b", x, mask)
        both = np.concatenate([forward, backward], axis=2)
        logits = (both @ self.weights["out"] + x @ self.weights["skip"])[:, :, 0]
        return (logits, both, fm, bm) if keep else logits

    def gradients(self, x, mask, labels):
        logits, both, fm, bm = self.scores(x, mask, keep=True)
        error = ((_sigmoid(logits) - labels) * mask / mask.sum()).astype(np.float32)[:, :, None]
        grads = {"out": np.tensordot(both, error, ((0, 1), (0, 1))),
                 "skip": np.tensordot(x, error, ((0, 1), (0, 1)))}
        back = error @ self.weights["out"].T
        for side, memory, part in (("f", fm, back[:, :, :HIDDEN]), ("b", bm, back[:, :, HIDDEN:])):
            u = self.weights["h" + side]
            pages, length, n = x.shape
            steps = np.zeros((pages, length, 4 * HIDDEN), np.float32)
            gu = np.zeros_like(u)
            dh = np.zeros((pages, HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t in range(length - 1, -1, -1) if side == "f" else range(length):
                h, c, i, f, o, g, squashed = memory[t]
                m = mask[:, t, None]
                dh = dh + part[:, t]
                do = dh * m * squashed
                dn = dc * m + dh * m * o * (1 - squashed ** 2)
                dz = np.concatenate([dn * g * i * (1 - i), dn * c * f * (1 - f),
                                     do * o * (1 - o), dn * i * (1 - g ** 2)], axis=1)
                steps[:, t] = dz
                gu += h.T @ dz
                dh = dz @ u.T + dh * (1 - m)
                dc = dn * f + dc * (1 - m)
            grads["h" + side] = gu
            grads["x" + side] = x.reshape(-1, n).T @ steps.reshape(-1, 4 * HIDDEN)
            grads["c" + side] = steps.sum((0, 1))
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 6) -> Labeller:
        """Adam on batches of pages of similar length, in an order fixed by the seed."""
        random = np.random.default_rng(seed)
        pages = sorted(pages, key=lambda p: len(p[1]))
        batches = [padded(pages[i:i + BATCH]) for i in range(0, len(pages), BATCH)]
        mean = {k: np.zeros_like(w) for k, w in self.weights.items()}
        square = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step = 0
        for _ in range(EPOCHS):
            for b in random.permutation(len(batches)):
                step += 1
                for k, g in self.gradients(*batches[b]).items():
                    np.clip(g, -1, 1, out=g)
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.01 * (g * g - square[k])
                    up = (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
                    self.weights[k] -= (RATE * up).astype(np.float32)
        return self


def padded(pages):
    length = max(1, max((len(x) for x, _ in pages), default=1))
    x = np.zeros((len(pages), length, PATH + WORDS + SHAPE), np.float32)
    mask, labels = np.zeros((len(pages), length), np.float32), np.zeros((len(pages), length), np.float32)
    for i, (vectors, marks) in enumerate(pages):
        x[i, :len(vectors)], labels[i, :len(marks)], mask[i, :len(vectors)] = vectors, marks, 1.0
    return x, mask, labels


# Training data: the words of class and id that pages use for their parts.
MAIN = ['article', 'main', 'article class="post"', 'div class="content"', 'div class="post-body"',
        'div id="article"', 'div class="entry-content"', 'section class="story"', 'div id="main-content"',
        'div class="article-text"', 'main id="content"', 'div class="body text"']
#: Containers whose names say nothing: the article has to be known by its blocks and place.
UNNAMED = ['div', 'div class="x1"', 'div class="col"', 'section', 'div id="c7"', 'td', 'div class="row"']
MENU = ['nav', 'nav class="menu"', 'div class="menu"', 'div id="navigation"', 'ul class="nav"', 'div class="breadcrumb"',
        'header', 'header class="site-header"', 'div class="header"', 'div class="topbar"', 'div class="tags"']
SIDE = ['aside', 'aside class="sidebar"', 'div class="sidebar"', 'div class="widget"', 'div class="related"',
        'div id="sidebar"', 'section class="recommended"', 'div class="share social"']
ADVERT = ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'aside class="ad"',
          'div class="sponsored"', 'div class="promo"', 'div class="banner"', 'section class="ad-slot"']
NOTICE = ['div class="notice"', 'div class="cookie-notice"', 'div class="cookies"', 'div class="alert"',
          'div class="popup"', 'div class="newsletter"', 'div class="consent"', 'div role="alert"']
FORM = ['form', 'form class="search"', 'div class="login"><form', 'form id="subscribe"']
COMMENTS = ['section class="comments"', 'div class="comments"', 'div id="comments"', 'ol class="comment-list"',
            'div class="comment"', 'section id="discussion"', 'div class="replies"']
FOOTER = ['footer', 'footer class="site-footer"', 'div id="footer"', 'div class="footer"', 'div class="copyright"',
          'div class="legal"']


def _wrapped(opening: str, body: str, label: str) -> str:
    first, *more = opening.split("><")
    tags = [x.split(" ")[0] for x in (first, *more)]
    return f'<{first} data-label="{label}">' + "".join(f"<{x}>" for x in more) + body + "".join(
        f"</{t}>" for t in reversed(tags))


def layout(random, main: list[str], other: list[str]) -> str:
    """A page that sets the texts of `main` as its article and those of `other` around it.

    Some pages are bare: a few blocks, short ones too, without heading or anything around them;
    some articles are in a container without a telling name.
    """
    bare = random.random() < BARE
    if bare and main:
        start = random.integers(len(main))
        main = main[start:start + 1 + random.integers(3)]
        if random.random() < 0.3:
            main = [" ".join(m.split()[:1 + random.integers(8)]) for m in main]
    pick = lambda options: options[random.integers(len(options))]
    some = lambda: html.escape(pick(other)) if other else ""
    text = lambda: html.escape(pick(main)) if main and random.random() < 0.5 else some()

    def article():
        parts = []
        for k, words in enumerate(main):
            words = html.escape(words)
            kind = random.random()
            if k == 0 and not (bare and random.random() < 0.8):
                parts.append(f"<h1>{words}</h1>")
            elif kind < 0.75:
                parts.append(f"<p>{words}</p>")
            elif kind < 0.8:
                parts.append(f"<h2>{words}</h2>")
            elif kind < 0.85:
                parts.append(f"<ul><li>{words}</li></ul>")
            elif kind < 0.9:
                parts.append(f"<blockquote><p>{words}</p></blockquote>")
            elif kind < 0.95:
                parts.append(f"<div>{words}</div>")
            else:
                parts.append(f"<table><tr><td>{words}</td></tr></table>")
            if random.random() < 0.06:
                parts.append(_wrapped(pick(ADVERT + SIDE + NOTICE), f"<p>{text()}</p>", "other"))
        long = main and np.median([len(m) for m in main]) > 60
        return _wrapped(pick(UNNAMED if long and random.random() < 0.4 else MAIN), "".join(parts), "main")

    def menu():
        items = "".join(f'<li><a href="/">{some()}</a></li>' for _ in range(random.integers(2, 8)))
        return _wrapped(pick(MENU), f"<ul>{items}</ul>" if random.random() < 0.8 else items, "other")

    def loose(options):
        body = f"<p>{text()}</p>" if random.random() < 0.5 else text()
        return _wrapped(pick(options), body, "other")

    def remarks():
        body = "".join(f'<div class="comment"><p>{text()}</p></div>' if random.random() < 0.5 else
                       f"<li><p>{text()}</p></li>" for _ in range(random.integers(1, 5)))
        return _wrapped(pick(COMMENTS), ("<h3>" + some() + "</h3>" if random.random() < 0.4 else "") + body, "other")

    def entry():
        return _wrapped(pick(FORM), f"<label>{some()}</label><input><button>{some()}</button>", "other")

    before = [menu] + [p for p in (menu, lambda: loose(ADVERT), lambda: loose(NOTICE), entry, lambda: loose(SIDE))
                       if random.random() < 0.4]
    after = [p for p in (remarks, lambda: loose(SIDE), entry, lambda: loose(ADVERT), lambda: loose(NOTICE))
             if random.random() < 0.4] + [lambda: loose(FOOTER)]
    random.shuffle(before)
    if bare:
        before, after = before[:random.integers(2)], after[:random.integers(2)]
    frame = (lambda x: f'<div class="{pick(["page", "wrapper", "container"])}">{x}</div>') if random.random() < 0.3 else (lambda x: x)
    head = f"<head><title>{html.escape(main[0]) if main else ''}</title></head>"
    return f'<html data-label="other">{head}<body>' + frame(
        "".join(part() for part in before) + article() + "".join(part() for part in after)) + "</body></html>"


SECTIONS = frozenset("nav header footer aside form head button label figcaption".split())
ASIDE_WORDS = frozenset(
    x for options in (MENU, SIDE, ADVERT, NOTICE, FORM, COMMENTS, FOOTER) for o in options
    for b in blocks_of(f"<{o}>x") for x in b.path if x.startswith(".")) - {".site", ".list", ".section", ".slot"}


def weak_label(block: Block) -> bool | None:
    """What the tags themselves say of a block: part of the article, or not; None if nothing."""
    tags = {x for x in block.path if not x.startswith(".")}
    if tags & SECTIONS or ASIDE_WORDS & set(block.path):
        return False
    return True if tags & {"article", "main"} else None


def training_pages(pages: list[str], seed: int = 4):
    """Labelled block sequences: the pages where tags say which blocks are the article, and
    their texts set anew in other layouts."""
    random = np.random.default_rng(seed)
    features, out, texts = Features(), [], []
    for page in pages:
        blocks = blocks_of(page)
        labels = [weak_label(b) for b in blocks]
        main = [b.text for b, m in zip(blocks, labels) if m or m is None and not b.in_links]
        other = [b.text for b, m in zip(blocks, labels) if m is False]
        texts.append((main[:LAYOUT_BLOCKS], other[:LAYOUT_BLOCKS]))
        if blocks and None not in labels:
            out.append((features.page(blocks), np.array(labels, np.float32)))
    if not texts:  # no page to learn from: placeholder words, so that the tag paths are learnt
        words = [f"word{i} " * (3 + i % 7) for i in range(24)]
        texts = [(words[:12], words[12:])] * 40
    for main, other in texts:
        for _ in range(LAYOUTS):
            blocks = blocks_of(layout(random, main, other or ["menu", "home"]))
            out.append((features.page(blocks), np.array([b.label == "main" for b in blocks], np.float32)))
    return out


def fit_labeller(df: DataFrame, page_id: str = "page_id", html_column: str = "html") -> Labeller:
    """Train on FIT_PAGES pages, chosen by hash among those of at most FIT_CHARS letters."""
    usable = df.select(F.col(page_id).cast("string").alias("id"), F.col(html_column).alias("html")).filter(
        F.length("html").between(1, FIT_CHARS))
    n = usable.count()
    every = max(1, n // FIT_PAGES)
    picked = usable.filter(F.pmod(F.xxhash64("id", "html"), F.lit(every)) == 0).orderBy(
        F.xxhash64("id", "html"), "id", "html").limit(FIT_PAGES)
    return Labeller().fit(training_pages([r["html"] for r in picked.collect()]))


def main_text(pages: list[str | None], labeller: Labeller, features: Features) -> list[str]:
    """The article of each page; pages of similar length are labelled together."""
    blocks = [blocks_of(page) for page in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if blocks[i]), key=lambda i: len(blocks[i]))
    while order:
        take, padding = 0, 0
        while take < len(order) and (take == 0 or (take + 1) * len(blocks[order[take]]) <= 4096):
            take += 1
        part, order = order[:take], order[take:]
        x, mask, _ = padded([(features.page(blocks[i]), ()) for i in part])
        logits = labeller.scores(x, mask)
        for row, i in enumerate(part):
            out[i] = "\n\n".join(b.text for b, s in zip(blocks[i], logits[row]) if s > 0)
    return out


def extract_text(
    df: DataFrame, labeller: Labeller, html_column: str = "html", text: str = "text", chars: str = "n_chars",
) -> DataFrame:
    """df with the main text of each page and its number of code points.

    A missing or empty page, or one without text, has an empty text.  Broken markup is read as
    far as it goes.  Pages are independent: repeated rows get equal texts, an empty table stays
    empty, and columns named like a result are replaced.  The labeller is a few hundred
    kilobytes whatever the data.
    """
    shared = df.sparkSession.sparkContext.broadcast(labeller)

    def make():
        features = Features()

        def compute(pages):
            return [(found, len(found)) for found in main_text(pages, shared.value, features)]
        return compute

    return with_computed(df, [html_column], [
        T.StructField(text, T.StringType()), T.StructField(chars, T.LongType())], make, together=True)
