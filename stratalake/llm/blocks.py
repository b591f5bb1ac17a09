r"""HTML main text by a recurrent block labeller.

A page is cut into blocks, the runs of text between block-level tags, each with the path of open elements. A
bidirectional LSTM in numpy reads the page's blocks in order, each as a hashed vector of its tag path, a hashed vector
of its words and a few rates, and labels every block with the whole page as context. The text is what is labelled as
article, joined by ``joint``: one line feed, two in the query.

The labeller is trained on a bounded sample of pages (``SAMPLE`` pages, ``TRAIN_BLOCKS`` blocks of each): those with
an article element, which gives the labels, and variants of them in other layouts, with menus, notices, adverts, forms,
sidebars and reader comments around or inside the article. Without such pages a layout rule labels the blocks.

Null and empty pages have an empty text. Scripts, styles, comments and other invisible content are no blocks.
Character references are decoded, white space in a block becomes one blank, and blocks without text do not count.
Broken markup is read as browsers do: unclosed elements end with their parent, unclosed comments, tags and scripts with the
page. Other elements without text (pictures, players, objects) that are closed at once, or never, hide nothing but themselves.
Quotes only count after an equals sign. Formulas (``math``) are text. Every row is labelled for itself; repeated rows repeat results, an input column with an output's name is
replaced.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm import wordhash

SAMPLE = 200
TRAIN_BLOCKS = 200
VARIANTS = 4

PATH, WORDS, RATES, HIDDEN = 96, 24, 8, 24
EPOCHS, BATCH, RATE = 8, 32, 0.01

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""", re.I)
_NAME = re.compile("[a-z]+")

#: Fixed values of HTML: elements whose content is no text, those of them that go on to the end of a page that does not
#: close them, elements without content, inline elements.
RAW = frozenset("script style noscript template svg iframe object canvas textarea select datalist video audio annotation annotation-xml".split())
ENDLESS = frozenset("script style iframe textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img input button "
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot munder mover munderover mstyle mspace mtable mtr mtd semantics".split()
)
#: Elements that end an open element of the same group.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}}


@dataclass
class Block:
    text: str
    path: str
    linked: int


def cut(page: str) -> list[Block]:
    """The blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    state = {"links": 0, "linked": 0}

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append(Block(text, "/".join(s for _, s in stack), state["linked"]))
        parts.clear()
        state["linked"] = 0

    def add(piece: str) -> None:
        if piece:
            parts.append(piece)
            if state["links"]:
                state["linked"] += len(piece)

    at, size = 0, len(page)
    never_closed: set[str] = set()
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name or not found[4]:
            continue
        closing = bool(found[1])
        if name in RAW and not closing:
            alone = name not in ENDLESS and (found[3].endswith("/") or name in never_closed)
            end = None if alone else re.compile(f"</{name}\\b[^>]*(?:>|\\Z)", re.I).search(page, at)
            if end:
                at = end.end()
            elif name in ENDLESS:
                at = size
            elif not alone:
                never_closed.add(name)
        elif name == "br":
            add(" ")
        elif name == "a":
            state["links"] = 0 if closing else 1
        elif name in INLINE:
            continue
        elif name in VOID:
            flush()
        elif closing:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    state["links"] = 0
                    break
        else:
            flush()
            ended = _ENDS.get(name, {"p"})
            if stack and stack[-1][0] in ended:
                stack.pop()
            names = [name]
            for key, a, b, c in _ATTRIBUTE.findall(found[3]):
                names += [f"{key.lower()[0]}:{n}" for n in _NAME.findall((a or b or c).lower())]
            stack.append((name, " ".join(names)))
    flush()
    return out


_paths: dict[str, np.ndarray] = {}


def _path_vector(path: str) -> np.ndarray:
    """Signed hashes of the path's elements, names and attribute words; inner ones weigh more."""
    known = _paths.get(path)
    if known is None:
        known = np.zeros(PATH, np.float32)
        elements = path.split("/") if path else []
        for depth, element in enumerate(reversed(elements)):
            for name in element.split():
                for key, weight in ((name, 1.0), (f"{depth}>{name}", 0.5 if depth < 2 else 0.0)):
                    h = zlib.crc32(key.encode())
                    known[h % PATH] += weight * (1 if h & 0x10000 else -1)
        if len(_paths) > 50_000:
            _paths.clear()
        _paths[path] = known
    return known


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row per block: path, words, rates."""
    blocks = [b for page in pages for b in page]
    if not blocks:
        return np.zeros((0, PATH + WORDS + RATES), np.float32)
    data, rows = wordhash.buffer(pa.array([b.text for b in blocks], pa.large_string()))
    words, before, _, _ = wordhash.hash_words(data, rows, ~wordhash.SPACES)
    count = np.diff(before)
    row = np.repeat(np.arange(len(blocks)), count)
    bucket = (words % np.uint64(WORDS)).astype(np.int64)
    sign = np.where((words >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    bag = np.bincount(row * WORDS + bucket, sign, len(blocks) * WORDS).reshape(-1, WORDS)
    bag = bag / np.sqrt(np.maximum(count, 1))[:, None]
    length = np.array([len(b.text) for b in blocks], float)
    linked = np.array([b.linked for b in blocks], float)
    place = np.concatenate([(np.arange(len(p)) + 0.5) / len(p) for p in pages if p])
    kinds = np.concatenate([[0], np.cumsum(np.isin(data, [ord(c) for c in ".!?"]))])
    ends = kinds[rows[1:]] - kinds[rows[:-1]]
    rates = [np.log1p(length) / 6, np.minimum(linked / np.maximum(length, 1), 1), place, np.log1p(count) / 4]
    rates += [np.minimum(ends / np.maximum(count, 1), 1), (ends > 0) * 1.0, place < 0.1, place > 0.9]
    paths = np.stack([_path_vector(b.path) for b in blocks])
    return np.concatenate([paths, bag, np.stack(rates, 1)], 1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def fresh(seed: int = 5) -> Labeller:
        rng = np.random.default_rng(seed)
        width = PATH + WORDS + RATES
        w = {"out": rng.normal(0, 0.1, (2 * HIDDEN, 1)), "bias": np.zeros(1)}
        for d in "fb":
            w[f"x{d}"] = rng.normal(0, 0.5 / np.sqrt(width), (width, 4 * HIDDEN))
            w[f"h{d}"] = rng.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"c{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        return Labeller({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (step, sequence, unit) of one direction; with the tape if asked."""
        steps, count, _ = x.shape
        gates = (x.reshape(steps * count, -1) @ self.w[f"x{d}"]).reshape(steps, count, -1) + self.w[f"c{d}"]
        h = np.zeros((count, HIDDEN), np.float32)
        c = np.zeros_like(h)
        states = np.zeros((steps, count, HIDDEN), np.float32)
        tape = []
        for t in range(steps):
            z = gates[t] + h @ self.w[f"h{d}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            old, c = c, f * c + i * g
            tanh = np.tanh(c)
            before, h = h, o * tanh
            states[t] = h
            if keep:
                tape.append((i, f, o, g, old, tanh, before))
        return states, tape

    @staticmethod
    def _turned(size: np.ndarray, steps: int) -> np.ndarray:
        """Step that stands at each step when every sequence is read from its end."""
        t = np.arange(steps)[:, None]
        return np.where(t < size, size - 1 - t, t)

    def scores(self, x: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Probabilities (step, sequence) for padded input (step, sequence, feature)."""
        turned = self._turned(size, len(x))
        column = np.arange(x.shape[1])
        forward, _ = self._run(x, "f", False)
        backward, _ = self._run(x[turned, column], "b", False)
        both = np.concatenate([forward, backward[turned, column]], 2)
        return _sigmoid(both @ self.w["out"] + self.w["bias"])[:, :, 0]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For every page the labels of its blocks."""
        rows = vectors(pages)
        size = np.array([len(p) for p in pages], np.int64)
        start = np.concatenate([[0], np.cumsum(size)])
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [i for i in np.argsort(size, kind="stable") if size[i]]
        while order:
            # pages of about equal length, so many that the padded input stays small
            take = max(1, min(len(order), 8192 // int(size[order[-1]])))
            group, order = order[-take:], order[:-take]
            steps = int(size[group].max())
            at = np.minimum(start[group] + np.arange(steps)[:, None], len(rows) - 1)
            likely = self.scores(rows[at], size[group])
            for k, i in enumerate(group):
                out[i] = likely[: size[i], k] >= 0.5
        return out

    def train(self, pages: list[list[Block]], labels: list[np.ndarray], seed: int = 6) -> None:
        rng = np.random.default_rng(seed)
        size = np.array([len(p) for p in pages])
        rows, start = vectors(pages), np.concatenate([[0], np.cumsum(size)])
        truth = np.concatenate(labels).astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(EPOCHS):
            pace = RATE * (1 - 0.9 * epoch / EPOCHS)
            # batches of about equal length in a new order
            order = np.argsort(size + rng.random(len(size)) * 8)
            batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
            rng.shuffle(batches)
            for group in batches:
                steps = int(size[group].max())
                at = np.minimum(start[group] + np.arange(steps)[:, None], len(rows) - 1)
                mask = np.arange(steps)[:, None] < size[group]
                grads = self._gradients(rows[at], size[group], truth[at], mask)
                step += 1
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g**2
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.w[k] = (self.w[k] - pace * move).astype(np.float32)

    def _gradients(self, x: np.ndarray, size: np.ndarray, truth: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        turned = self._turned(size, len(x))
        column = np.arange(x.shape[1])
        flipped = x[turned, column]
        forward, tape_f = self._run(x, "f", True)
        backward, tape_b = self._run(flipped, "b", True)
        both = np.concatenate([forward, backward[turned, column]], 2)
        likely = _sigmoid(both @ self.w["out"] + self.w["bias"])[:, :, 0]
        error = ((likely - truth) * mask / mask.sum()).astype(np.float32)
        grads = {"out": np.einsum("tnh,tn->h", both, error)[:, None], "bias": error.sum(keepdims=True).reshape(1)}
        wide = error[:, :, None] * self.w["out"][:, 0]
        self._back(grads, "f", x, tape_f, wide[:, :, :HIDDEN])
        self._back(grads, "b", flipped, tape_b, wide[:, :, HIDDEN:][turned, column])
        return grads

    def _back(self, grads: dict[str, np.ndarray], d: str, x: np.ndarray, tape: list, wide: np.ndarray) -> None:
        steps, count, width = x.shape
        dz = np.zeros((steps, count, 4 * HIDDEN), np.float32)
        dh = np.zeros((count, HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        deep = np.zeros_like(self.w[f"h{d}"])
        for t in range(steps - 1, -1, -1):
            i, f, o, g, old, tanh, before = tape[t]
            dh = dh + wide[t]
            dc = dc + dh * o * (1 - tanh**2)
            dz[t] = np.concatenate(
                [dc * g * i * (1 - i), dc * old * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g**2)], 1
            )
            dc = dc * f
            deep += before.T @ dz[t]
            dh = dz[t] @ self.w[f"h{d}"].T
        grads[f"h{d}"] = deep
        grads[f"x{d}"] = x.reshape(steps * count, width).T @ dz.reshape(steps * count, -1)
        grads[f"c{d}"] = dz.sum((0, 1))


#: Words in tags, classes and ids that stand for other things than the article, and tags that do.
OTHER = frozenset(
    "nav menu header footer aside sidebar form ad ads advert banner promo sponsor cookie consent notice comment comments "
    "reply share social related breadcrumb newsletter subscribe login search".split()
)
OTHER_TAGS = OTHER | {"head", "title"}


def teacher(blocks: list[Block]) -> np.ndarray | None:
    """Labels by layout: inside an article element and outside of everything else; None without an article."""
    if not any("article" in re.split("[ /]", b.path) for b in blocks):
        return None
    out = []
    for b in blocks:
        names = {n.split(":")[-1] for e in b.path.split("/") for n in e.split()}
        tags = {e.split()[0] for e in b.path.split("/") if e}
        out.append("article" in names and not names & OTHER and not tags & OTHER_TAGS)
    return np.array(out, bool)


_WRAPS = (
    ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="main">', "</div>"), ('<div class="post-body">', "</div>"),
    ('<section class="entry">', "</section>"), ("<div>", "</div>"), ('<main><div class="article-body">', "</div></main>"),
    ('<div class="story text">', "</div>"), ("<main><article>", "</article></main>"), ('<div id="page"><article class="post">', "</article></div>"),
    ('<div class="container"><div class="row"><div class="col">', "</div></div></div>"), ("<table><tr><td>", "</td></tr></table>"),
    ('<div id="wrapper"><main id="content">', "</main></div>"), ('<div role="main">', "</div>"), ('<div class="page"><section>', "</section></div>"),
    ('<article><div class="body">', "</div></article>"), ("", ""),
)
#: Parts around the article: {l} are links in a list, {s} a few words, {t} a text.
_AROUND = (
    '<nav class="menu"><ul>{l}</ul></nav>', '<header><h2>{s}</h2><p>{t}</p></header>', '<div class="header"><p>{s}</p></div>',
    '<div class="menu"><ul>{l}</ul></div>', '<div class="breadcrumb">{l}</div>', '<header><a href="/">{s}</a><ul>{l}</ul></header>',
    '<div class="cookie-notice"><p>{t}</p><button>{s}</button></div>', '<div class="ad">{t}</div>', '<div class="advert sponsored"><p>{t}</p></div>',
    '<div id="cookie-banner">{t}</div>', '<div class="notice">{t}</div>', '<p class="notice">{t}</p>', '<div role="alert"><p>{t}</p></div>',
    '<div class="gdpr consent"><p>{t}</p><p>{s}</p></div>', '<div class="banner">{t}</div>', '<div class="masthead"><h1>{s}</h1></div>',
    '<div id="top"><ul>{l}</ul></div>', '<nav><a href="/">{s}</a> <a href="/x">{s}</a></nav>', '<ul class="nav">{l}</ul>', '<div class="toolbar"><p>{s}</p></div>',
    '<form action="/q"><p>{s}</p><label>{s}</label><input name="q"></form>', '<form class="search"><label>{s}</label></form>',
    '<div class="login"><form><label>{s}</label><label>{s}</label></form></div>', '<div class="promo"><p>{t}</p></div>', '<ins class="adsbygoogle">{t}</ins>',
)
_AFTER = (
    '<aside><h3>{s}</h3><ul>{l}</ul></aside>', '<div class="sidebar"><p>{t}</p><ul>{l}</ul></div>', '<aside class="related"><p>{t}</p></aside>',
    '<section class="comments"><h2>{s}</h2><div class="comment"><p>{t}</p></div><div class="comment"><p>{t}</p><p>{t}</p></div></section>',
    '<div id="comments"><p class="comment">{t}</p><p class="comment">{t}</p></div>', '<ul class="comment-list"><li>{t}</li><li>{t}</li></ul>',
    '<form class="comment-form"><p>{t}</p><label>{s}</label></form>', '<ol class="commentlist"><li><p>{t}</p></li><li><p>{t}</p></li></ol>',
    '<div class="reader-comments"><div class="reply"><p>{s}</p><p>{t}</p></div></div>', '<section id="discussion"><article class="comment"><p>{t}</p></article></section>',
    '<div class="newsletter"><p>{t}</p><form><label>{s}</label></form></div>', '<div class="share"><ul>{l}</ul></div>', '<div class="pagination">{l}</div>',
    '<div class="footer"><p>{t}</p></div>', '<footer><p>{t}</p><ul>{l}</ul></footer>', '<div class="ads">{t}</div>', '<div id="bottom"><p>{t}</p></div>',
    '<div class="copyright">{s}</div>', '<div class="widget"><h3>{s}</h3><p>{t}</p></div>', '<aside class="promo"><p>{t}</p><p>{t}</p></aside>',
    '<section class="related-posts"><h3>{s}</h3><ul>{l}</ul></section>', '<div class="subscribe"><p>{t}</p></div>', '<div class="tags"><ul>{l}</ul></div>',
)


def variant(paragraphs: list[str], spare: list[str], rng: np.random.Generator) -> str:
    """A page with the paragraphs as its article, in a drawn layout, and spare texts around it.

    The article's blocks carry a mark, ``\\x01``, which the trainer takes for their label.
    """

    def fill(form: str) -> str:
        def text(_) -> str:
            return html.escape(str(spare[rng.integers(len(spare))]))

        def links(_) -> str:
            words = text(_).split()[: rng.integers(2, 9)]
            return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words)

        form = re.sub(r"\{l\}", links, form)
        form = re.sub(r"\{s\}", lambda m: " ".join(text(m).split()[: rng.integers(1, 6)]), form)
        return re.sub(r"\{t\}", text, form)

    def some(forms: tuple[str, ...], most: int) -> str:
        return "".join(fill(forms[i]) for i in rng.choice(len(forms), rng.integers(0, most + 1), replace=False))

    body = []
    for i, paragraph in enumerate(paragraphs):
        tag = "h1" if i == 0 and rng.random() < 0.7 else ("li" if rng.random() < 0.04 else "h2" if rng.random() < 0.04 else "p")
        body.append(f"<{tag}>\x01{html.escape(paragraph)}</{tag}>")
        if rng.random() < 0.06:
            body.append(fill(_AROUND[rng.integers(7, 9)]))
    left, right = _WRAPS[rng.integers(len(_WRAPS))]
    inside = some(_AFTER[3:9], 1) if rng.random() < 0.25 else ""
    article = left + "".join(body) + inside + right
    title = "<head><title>" + html.escape(paragraphs[0][:60]) + "</title></head>"
    return f"<html>{title}<body>{some(_AROUND, 4)}{article}{some(_AFTER, 4)}<footer>{fill('{t}')}</footer></body></html>"


def trained(pages: list[str], seed: int = 4) -> Labeller:
    """A labeller fitted to the pages that have an article element, and to variants of them."""
    rng = np.random.default_rng(seed)
    cuts = [cut(p)[:TRAIN_BLOCKS] for p in pages]
    marked = [(c, t) for c in cuts if c and (t := teacher(c)) is not None and t.any()]
    texts = [[b.text for b, y in zip(c, t, strict=True) if y] for c, t in marked]
    spare = [x for t in texts for x in t] + [b.text for c, t in marked for b, y in zip(c, t, strict=True) if not y]
    # the pages as they are count twice
    sequences, labels = [c for c, _ in marked] * 2, [t for _, t in marked] * 2
    for paragraphs in texts:
        for _ in range(VARIANTS):
            take = paragraphs[: 1 + int(rng.integers(len(paragraphs)))] if rng.random() < 0.3 else paragraphs
            made = cut(variant(take[: TRAIN_BLOCKS // 2], spare, rng))
            labels.append(np.array(["\x01" in b.text for b in made], bool))
            for b in made:
                b.text = b.text.replace("\x01", "")
            sequences.append(made)
    model = Labeller.fresh()
    if sequences:
        model.train(sequences, labels)
    else:
        model.w["bias"][:] = np.nan
    return model


def fit(pages: DataFrame, key: str = "page_id", source: str = "html") -> dict[str, np.ndarray]:
    """Weights of a labeller trained, in one task, on the first ``SAMPLE`` pages in the order of an id hash."""
    sample = pages.where(F.col(source).isNotNull()).select(F.xxhash64(key).alias("h"), F.col(key).alias("k"), F.col(source).alias("page"))
    sample = sample.orderBy("h", "k", "page").limit(SAMPLE).select("page").coalesce(1)

    def run(batches):
        model = trained([p.as_py() for batch in batches for p in batch.column(0)])
        for name, value in model.w.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([list(value.shape)], pa.list_(pa.int32())), pa.array([value.tobytes()], pa.binary())],
                names=["name", "shape", "value"],
            )

    rows = sample.mapInArrow(run, "name string, shape array<int>, value binary").collect()
    weights = {r["name"]: np.frombuffer(r["value"], np.float32).reshape(r["shape"]) for r in rows}
    return weights or {k: v for k, v in trained([]).w.items()}


def extract(
    pages: DataFrame, weights: dict[str, np.ndarray], source: str = "html", name: str = "text", joint: str = "\n"
) -> DataFrame:
    """``pages`` with the main text of each, its blocks joined by ``joint``, and ``n_chars``, its code points."""
    made = (name, "n_chars")
    base = pages.drop(*[c for c in made if c != source])
    names = [c for c in base.columns if c not in made]
    fields = [f for f in base.schema.fields if f.name in names]
    schema = T.StructType([*fields, T.StructField(name, T.StringType()), T.StructField("n_chars", T.LongType())])
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        model = Labeller(dict(shared.value))
        ruled = bool(np.isnan(model.w["bias"]).any())
        for batch in (part for whole in batches for part in wordhash.slices(whole, whole.schema.get_field_index(source))):
            at = batch.schema.get_field_index
            cuts = [cut(p.as_py() or "") for p in batch.column(at(source))]
            if ruled:
                labels = [np.array([not set(re.split("[ /:]", b.path)) & OTHER for b in c], bool) for c in cuts]
            else:
                labels = model.label(cuts)
            texts = [joint.join(b.text for b, y in zip(c, t, strict=True) if y) for c, t in zip(cuts, labels, strict=True)]
            columns = [batch.column(at(n)) for n in names]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *made])

    return base.mapInArrow(run, schema)
