"""Recurrent labeller of page blocks: a bidirectional LSTM in numpy.

A block is read as the mean of learned vectors of its hashed tag path, the mean
of learned vectors of all its hashed words, and a few figures (lengths, share of
links, punctuation). One LSTM reads a page's blocks forwards, one backwards, so
every block is judged with the whole page before and after it.

It is fitted on pages that ``generated`` writes: many layouts around prose taken
from the given pages, so that content and other blocks share their words and
only structure and context tell them apart.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable
from zlib import crc32

import numpy as np

from .html_blocks import Block, blocks

PATHS, WORDS = 1024, 2048  # hash buckets
PATH_DIM, WORD_DIM, HIDDEN = 14, 8, 20
FIGURES = 8
EPOCHS, BATCH, RATE, SEED = 7, 24, 0.012, 7
GENERATED = 700  # pages

CONTENT, OTHER = "", ""  # marks of generated text, removed after reading

# fixed values: usual words of page furniture, and of elements' names
FURNITURE = {
    "menu": ["Home", "About us", "Contact", "News", "Sports", "Business", "Shop", "Login", "Sign up",
             "Accueil", "Contactez-nous", "Startseite", "Über uns", "Kontakt", "Inicio", "Contacto"],
    "footer": ["Privacy policy", "Terms of service", "All rights reserved", "© 2024 Example Inc.",
               "Imprint", "Impressum", "Datenschutz", "Mentions légales", "Aviso legal", "Sitemap"],
    "notice": ["We use cookies to improve your experience.", "Accept all cookies", "Subscribe now",
               "Sign up for our newsletter", "You have 3 free articles left", "Please enable JavaScript.",
               "Nous utilisons des cookies.", "Wir verwenden Cookies.", "Usamos cookies."],
    "share": ["Share", "Tweet", "Print", "Email this", "Share on Facebook", "Partager", "Teilen"],
    "advert": ["Advertisement", "Sponsored", "Buy now and save 50%", "Anzeige", "Publicité"],
    "comment": ["Reply", "Leave a comment", "2 hours ago", "Comments (12)", "Log in to reply",
                "Répondre", "Antworten", "Responder", "posted by guest"],
    "related": ["Related articles", "Read more", "Most popular", "You may also like", "Lire aussi",
                "Mehr zum Thema", "Lo más leído", "Next page", "Older posts"],
    "form": ["Name", "Email", "Submit", "Search", "Password", "Your message", "Send", "Suchen"],
}
NAMES = {
    "header": ["header", "masthead", "site-header", "top", "topbar", "banner", "logo", "branding"],
    "menu": ["nav", "menu", "navbar", "main-menu", "navigation", "breadcrumb", "breadcrumbs", "tabs"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "colophon", "legal", "foot"],
    "notice": ["cookie-banner", "notice", "alert", "consent", "gdpr", "paywall", "newsletter", "popup",
               "modal", "message", "subscribe", "warning", "disclaimer", "cookie"],
    "share": ["share", "social", "share-buttons", "tools", "sharing", "addthis"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion",
               "adsense", "ad-slot", "commercial", "partner", "affiliate"],
    "comment": ["comments", "comment-list", "comment", "responses", "discussion", "disqus", "replies",
                "respond", "reader-comments", "thread"],
    "related": ["sidebar", "widget", "related", "recommended", "popular", "trending", "aside", "rail",
                "more-stories", "right-col", "secondary", "tags", "pagination"],
    "form": ["search", "form", "login", "signup", "contact-form", "search-box", "subscribe-form"],
    "content": ["content", "article", "main", "post", "entry", "article-body", "story", "post-content",
                "entry-content", "text", "body", "main-content", "story-body", "blog-post", "prose"],
}
TAGS = {"header": ["header", "div"], "menu": ["nav", "nav", "div", "ul"], "footer": ["footer", "div"],
        "notice": ["div", "section", "aside", "dialog"], "share": ["div", "ul"],
        "advert": ["div", "aside", "section", "ins"], "comment": ["section", "div", "ol", "ul"],
        "related": ["aside", "div", "section"], "form": ["form", "form", "div"]}
OTHER_TAGS = {"nav", "footer", "aside", "form", "header"}  # inside an article: not of it


def _bucket_cache(size: int) -> Callable[[Iterable[str]], list[int]]:
    known: dict[str, int] = {}

    def buckets(words: Iterable[str]) -> list[int]:
        if len(known) > 200_000:
            known.clear()
        out = []
        for w in words:
            b = known.get(w)
            if b is None:
                b = known[w] = crc32(w.encode("utf-8", "surrogatepass")) % size
            out.append(b)
        return out

    return buckets


_path_buckets, _word_buckets = _bucket_cache(PATHS), _bucket_cache(WORDS)


class Features:
    """Numbers of the blocks of a page: hashed path and words, and figures."""

    def __init__(self, found: list[Block]):
        self.n = len(found)
        paths = [_path_buckets([*b.path, "/".join(b.path[-2:])]) for b in found]
        words = [_word_buckets(b.text.lower().split()) for b in found]
        self.paths, self.path_sizes = self._flat(paths)
        self.words, self.word_sizes = self._flat(words)
        self.figures = np.array([self._figures(b, n) for b, n in zip(found, self.word_sizes)],
                                np.float32).reshape(self.n, FIGURES)

    @staticmethod
    def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.fromiter((b for x in lists for b in x), np.int64, int(sizes.sum())), sizes

    @staticmethod
    def _figures(block: Block, n_words: int) -> tuple:
        text, n = block.text, max(1, len(block.text))
        return (np.log1p(n_words) / 4, np.log1p(n) / 6, block.link_chars / n,
                float(text[-1:] in tuple(".!?…\"»”")), sum(text.count(c) for c in ".,;:") * 10 / n,
                float(n_words <= 2), min(len(block.path), 20) / 10, min(block.leaves, 10) / 10)


def _means(table: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean of the rows ``at`` of ``table`` for each run of ``sizes``."""
    out = np.zeros((len(sizes), table.shape[1]), np.float32)
    some = np.nonzero(sizes)[0]
    if len(some):
        starts = np.cumsum(sizes) - sizes
        out[some] = np.add.reduceat(table[at], starts[some], axis=0) / sizes[some, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction; gates in the order input, forget, output, candidate."""

    @staticmethod
    def forward(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool) -> tuple:
        steps, n, _ = x.shape
        size = u.shape[0]
        ready = x @ w + b
        h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        out, trace = np.empty((steps, n, size), np.float32), []
        for t in range(steps):
            z = ready[t] + h @ u
            gates = _sigmoid(z[:, :3 * size])
            new = np.tanh(z[:, 3 * size:])
            before, c = c, gates[:, size:2 * size] * c + gates[:, :size] * new
            cell = np.tanh(c)
            if keep:
                trace.append((h, before, gates, new, cell))
            h = gates[:, 2 * size:] * cell
            out[t] = h
        return out, trace

    @staticmethod
    def backward(x: np.ndarray, w: np.ndarray, u: np.ndarray, trace: list, dout: np.ndarray) -> tuple:
        steps, n, size = dout.shape
        dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * size, np.float32)
        dx = np.empty_like(x)
        dh, dc = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        for t in range(steps - 1, -1, -1):
            h, before, gates, new, cell = trace[t]
            i, f, o = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - cell * cell)
            dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f),
                                 dh * cell * o * (1 - o), dc * i * (1 - new * new)], axis=1)
            dw += x[t].T @ dz
            du += h.T @ dz
            db += dz.sum(axis=0)
            dx[t] = dz @ w.T
            dh, dc = dz @ u.T, dc * f
        return dx, dw, du, db


class Labeller:
    """The fitted network; ``labels`` judges the blocks of many pages at once."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        d = PATH_DIM + WORD_DIM + FIGURES
        self.p = {"paths": draw(PATHS, PATH_DIM) * 8, "words": draw(WORDS, WORD_DIM) * 4,
                  "out": draw(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for way in "fb":
            self.p |= {f"w{way}": draw(d, 4 * HIDDEN), f"u{way}": draw(HIDDEN, 4 * HIDDEN),
                       f"b{way}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"b{way}"][HIDDEN:2 * HIDDEN] = 1.0  # remember at first

    def _inputs(self, pages: list[Features]) -> tuple:
        """(steps, pages, numbers), the reversing index and the mask of real blocks."""
        steps, n = max(p.n for p in pages), len(pages)
        x = np.zeros((steps, n, PATH_DIM + WORD_DIM + FIGURES), np.float32)
        back, mask = np.tile(np.arange(steps)[:, None], (1, n)), np.zeros((steps, n), bool)
        for k, page in enumerate(pages):
            m = page.n
            x[:m, k, :PATH_DIM] = _means(self.p["paths"], page.paths, page.path_sizes)
            x[:m, k, PATH_DIM:PATH_DIM + WORD_DIM] = _means(self.p["words"], page.words, page.word_sizes)
            x[:m, k, PATH_DIM + WORD_DIM:] = page.figures
            back[:m, k] = np.arange(m)[::-1]
            mask[:m, k] = True
        return x, back, mask

    def _scores(self, x: np.ndarray, back: np.ndarray, keep: bool) -> tuple:
        p, cols = self.p, np.arange(x.shape[1])
        hf, tf = Lstm.forward(x, p["wf"], p["uf"], p["bf"], keep)
        hb, tb = Lstm.forward(x[back, cols], p["wb"], p["ub"], p["bb"], keep)
        both = np.concatenate([hf, hb[back, cols]], axis=2)
        return (both @ p["out"])[:, :, 0] + p["bias"], both, tf, tb

    def labels(self, pages: list[Features], most: int = 40_000) -> list[np.ndarray]:
        """Score of every block of every page, in batches of pages of like length."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k].n), key=lambda k: pages[k].n)
        while order:
            some = [order.pop()]
            while order and len(some) < 256 and pages[some[0]].n * (len(some) + 1) <= most:
                some.append(order.pop())
            x, back, _ = self._inputs([pages[k] for k in some])
            scores = self._scores(x, back, False)[0]
            for column, k in enumerate(some):
                out[k] = scores[:pages[k].n, column]
        return out

    def _gradients(self, pages: list[Features], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        p = self.p
        x, back, mask = self._inputs(pages)
        cols = np.arange(x.shape[1])
        scores, both, tf, tb = self._scores(x, back, True)
        wanted = np.zeros(scores.shape, np.float32)
        for k, y in enumerate(labels):
            wanted[:len(y), k] = y
        ds = np.where(mask, _sigmoid(scores) - wanted, 0).astype(np.float32)[:, :, None] / mask.sum()
        g = {"out": np.einsum("tnh,tno->ho", both, ds), "bias": ds.sum(axis=(0, 1))}
        dboth = ds @ p["out"].T
        dx, g["wf"], g["uf"], g["bf"] = Lstm.backward(x, p["wf"], p["uf"], tf, dboth[:, :, :HIDDEN])
        dr, g["wb"], g["ub"], g["bb"] = Lstm.backward(
            x[back, cols], p["wb"], p["ub"], tb, dboth[:, :, HIDDEN:][back, cols])
        dx = dx + dr[back, cols]
        g["paths"], g["words"] = np.zeros_like(p["paths"]), np.zeros_like(p["words"])
        for k, page in enumerate(pages):
            for name, a, b, at, sizes in (("paths", 0, PATH_DIM, page.paths, page.path_sizes),
                                          ("words", PATH_DIM, PATH_DIM + WORD_DIM, page.words,
                                           page.word_sizes)):
                share = dx[:page.n, k, a:b] / np.maximum(sizes, 1)[:, None]
                np.add.at(g[name], at, np.repeat(share, sizes, axis=0))
        return g

    def fit(self, pages: list[Features], labels: list[np.ndarray], epochs: int = EPOCHS) -> Labeller:
        """Adam over batches of pages of like length, in a fixed order."""
        rng = random.Random(SEED)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, total = 0, epochs * max(1, -(-len(pages) // BATCH))
        for _ in range(epochs):
            order = sorted(range(len(pages)), key=lambda k: (pages[k].n // 8, rng.random()))
            batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
            rng.shuffle(batches)
            for some in batches:
                g = self._gradients([pages[k] for k in some], [labels[k] for k in some])
                norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                step += 1
                rate = RATE * min(1.0, 3 * (1 - (step - 1) / total))
                for key, x in g.items():
                    x = x * min(1.0, 1.0 / (norm + 1e-9))
                    m[key] = 0.9 * m[key] + 0.1 * x
                    v[key] = 0.99 * v[key] + 0.01 * x * x
                    self.p[key] -= (rate * (m[key] / (1 - 0.9 ** step))
                                    / (np.sqrt(v[key] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return self


def generated(n: int, prose: list[str], seed: int = SEED,
              names: dict[str, list[str]] = NAMES) -> list[str]:
    """``n`` pages of varied layout; every text starts with its mark."""
    rng = random.Random(seed)
    return [_Writer(rng, prose, names).page() for _ in range(n)]


class _Writer:
    """Writes one page; layout choices are drawn once a page."""

    def __init__(self, rng: random.Random, prose: list[str], names: dict[str, list[str]]):
        self.rng, self.prose, self.names = rng, prose, names
        self.named = rng.random() < 0.8  # else elements carry names without meaning
        self.semantic = rng.random() < 0.5
        self.unclosed = rng.random() < 0.25

    def some(self, low: int, high: int) -> str:
        words = self.rng.choice(self.prose).split()
        at = self.rng.randrange(max(1, len(words)))
        n = self.rng.randint(low, high)
        cut = words[at:at + n] or words[:n]
        return " ".join(cut).replace("&", "&amp;").replace("<", "&lt;")

    def sentence(self, low: int = 8, high: int = 60) -> str:
        text = self.some(low, high)
        return text if self.rng.random() < 0.1 else text.rstrip(".,;") + self.rng.choice("...!?")

    def attributes(self, kind: str) -> str:
        rng = self.rng
        if rng.random() < 0.1:
            return ""
        if not self.named:
            return f' class="css-{rng.randrange(10 ** 6):x}"'
        name = rng.choice(self.names[kind])
        if rng.random() < 0.25:
            name += rng.choice(["-wrapper", "-container", " clearfix", "-inner", " col-8", "-1"])
        return f' {rng.choice(["class", "class", "id"])}="{name}"'

    def box(self, kind: str, body: str) -> str:
        tag = TAGS[kind][0] if self.semantic else self.rng.choice(TAGS[kind])
        if not self.named and tag in ("div", "ul", "section") and kind in ("advert", "notice", "comment"):
            tag = TAGS[kind][0] if kind != "comment" else "section"
        attributes = self.attributes(kind)
        if tag in ("div", "ul", "section", "ol", "ins") and not attributes:
            attributes = f' class="{self.rng.choice(self.names[kind])}"'
        return f"<{tag}{attributes}>{body}</{tag}>"

    def furniture(self, kind: str) -> str:
        return self.rng.choice(FURNITURE[kind]) if self.rng.random() < 0.7 else self.some(1, 4)

    def links(self, kind: str, low: int, high: int) -> str:
        rng, tag = self.rng, self.rng.choice(["li", "li", "", "div", "span", "p"])
        out = []
        for _ in range(rng.randint(low, high)):
            link = f'<a href="/{rng.randrange(999)}">{OTHER}{self.furniture(kind)}</a>'
            out.append(f"<{tag}>{link}</{tag}>" if tag else link)
        body = rng.choice([" ", "", " | "]).join(out)
        return f"<ul>{body}</ul>" if tag == "li" else body

    def other(self, kind: str) -> str:
        """A box of page furniture."""
        rng, mark = self.rng, OTHER
        if kind == "header":
            body = f'<a href="/">{mark}{self.some(1, 3)}</a>'
            if rng.random() < 0.6:
                body += f"<p>{mark}{self.some(3, 9)}</p>"
            if rng.random() < 0.4:
                body += self.other("menu")
        elif kind in ("menu", "share"):
            body = self.links(kind, 2, 10)
        elif kind == "footer":
            body = rng.choice([f"{mark}{self.furniture('footer')}", "<p>" + mark + self.sentence(4, 25) + "</p>",
                               self.links("footer", 2, 8) + f"<p>{mark}&copy; 2024 &middot; {self.some(1, 4)}</p>"])
        elif kind in ("notice", "advert"):
            text = self.furniture(kind) if rng.random() < 0.4 else self.sentence(3, 40)
            body = f"{mark}{text}" if rng.random() < 0.5 else f"<p>{mark}{text}</p>"
            if rng.random() < 0.3:
                body += f"<button>{mark}{self.furniture('notice')}</button>"
        elif kind == "comment":
            tag = rng.choice(["li", "div", "article", "p"])
            inner = self.attributes("comment")
            body = f"<h3>{mark}{self.furniture('comment')}</h3>" if rng.random() < 0.7 else ""
            for _ in range(rng.randint(1, 6)):
                said = f"{mark}{self.sentence(3, 50)}"
                said = f"<p>{said}</p>" if tag != "p" and rng.random() < 0.6 else said
                who = f"<b>{mark}{self.some(1, 2)}</b> " if rng.random() < 0.6 else ""
                more = f'<a href="#">{mark}{self.furniture("comment")}</a>' if rng.random() < 0.5 else ""
                body += f"<{tag}{inner}>{who}{said}{more}</{tag}>"
            if rng.random() < 0.3:
                body += self.other("form")
        elif kind == "related":
            body = f"<h3>{mark}{self.furniture('related')}</h3>" if rng.random() < 0.7 else ""
            body += self.links("related", 1, 7)
            if rng.random() < 0.4:
                body += f"<p>{mark}{self.sentence(5, 30)}</p>"
        else:
            body = "".join(f"<label>{mark}{self.furniture('form')}</label><input name=x>"
                           for _ in range(rng.randint(1, 3)))
            body += rng.choice(["", f"<p>{mark}{self.sentence(4, 15)}</p>"]) + f"<button>{mark}Send</button>"
        return self.box(kind, body)

    def paragraph(self) -> str:
        rng = self.rng
        text = CONTENT + self.sentence(*rng.choice([(1, 8), (8, 60), (20, 120)]))
        if rng.random() < 0.2:
            text += f" <{(t := rng.choice(['b', 'i', 'em', 'a href=/x', 'span']))}>{self.some(1, 5)}</{t.split()[0]}> {self.some(2, 9)}."
        if rng.random() < 0.1:
            text = f"<b>{text}<br>"
        kind = rng.random()
        if kind < 0.8:
            return f"<p>{text}" + ("" if self.unclosed and rng.random() < 0.5 else "</p>")
        if kind < 0.85:
            return f"<blockquote>{text}</blockquote>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>{CONTENT}{self.sentence(2, 20)}</li>"
                                    for _ in range(rng.randint(2, 6))) + "</ul>"
        if kind < 0.94:
            return "<table>" + "".join(f"<tr><td>{CONTENT}{self.some(1, 4)}<td>{CONTENT}{self.some(1, 4)}</tr>"
                                       for _ in range(rng.randint(1, 4))) + "</table>"
        return f"<h{rng.randint(2, 4)}>{CONTENT}{self.some(2, 8)}</h2>" if kind < 0.98 else \
            f"<pre>{text}</pre>"

    def article(self) -> str:
        rng = self.rng
        n = rng.choice([0, 1, 2, 4, 8, 16, rng.randint(20, 90)])
        title = f"<h1>{CONTENT}{self.some(2, 14)}</h1>" if rng.random() < 0.9 else ""
        plain = rng.random() < 0.15  # bare lines in a div
        parts = [title] + [f"<div>{CONTENT}{self.sentence()}</div>" if plain else self.paragraph()
                           for _ in range(max(n, not title))]
        for kind, chance in (("advert", 0.3), ("share", 0.2), ("related", 0.2), ("notice", 0.15)):
            if rng.random() < chance:
                parts.insert(rng.randint(1, len(parts)), self.other(kind))
        if rng.random() < 0.15:
            parts.append(self.other("comment"))
        body = "\n".join(parts)
        tag = rng.choice(["article", "article", "main", "div", "section"])
        body = f"<{tag}{self.attributes('content') if tag != 'article' or rng.random() < .4 else ''}>{body}</{tag}>"
        if rng.random() < 0.3:
            body = f"<div{self.attributes('content')}>{body}</div>"
        return f"<main>{body}</main>" if rng.random() < 0.15 else body

    def page(self) -> str:
        rng = self.rng
        before = [k for k, c in (("notice", .3), ("header", .6), ("menu", .7), ("form", .15), ("advert", .4),
                                 ("related", .15)) if rng.random() < c]
        after = [k for k, c in (("share", .2), ("advert", .2), ("comment", .35), ("related", .4), ("form", .15),
                                ("notice", .1), ("footer", .8)) if rng.random() < c]
        if rng.random() < 0.3:
            rng.shuffle(before)
        body = "".join(map(self.other, before)) + self.article() + "".join(map(self.other, after))
        if rng.random() < 0.3:
            body = f'<div id="{rng.choice(["page", "wrapper", "root", "app", "container"])}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}" + rng.choice(
            ["</body></html>", ""])


def marked(html: str) -> tuple[list[Block], np.ndarray]:
    """Blocks of a generated page without their marks, and their labels."""
    found = blocks(html)
    labels = np.array([CONTENT in b.text for b in found], np.float32)
    for b in found:
        b.text = " ".join(b.text.replace(CONTENT, "").replace(OTHER, "").split())
    return found, labels


def by_markup(found: list[Block]) -> np.ndarray | None:
    """Labels of a page that marks its article with elements of that meaning."""
    inside = [max([k for k, t in enumerate(b.path) if t in ("article", "main")], default=-1)
              for b in found]
    if not found or max(inside) < 0:
        return None
    out = []
    for b, at in zip(found, inside):
        furniture = {"." + n for k in ("advert", "comment", "share", "notice") for n in NAMES[k]}
        out.append(at >= 0 and not (OTHER_TAGS | furniture) & set(b.path))
    return np.array(out, np.float32)


def trained(pages: list[str], count: int = GENERATED, most_blocks: int = 300) -> Labeller:
    """Fit on generated pages with the prose of ``pages``, and on those of
    ``pages`` (up to ``most_blocks`` blocks) whose markup names the article."""
    read = [blocks(h) for h in pages]
    prose = [b.text for found in read for b in found if b.text.count(" ") >= 4] or [
        "some words to stand for the text of a page that has none of its own."]
    examples = [marked(h) for h in generated(count, prose)]
    for found in read:
        labels = by_markup(found) if len(found) <= most_blocks else None
        if labels is not None:
            examples.append((found, labels))
    examples = [(f, y) for f, y in examples if f]
    return Labeller().fit([Features(f) for f, _ in examples], [y for _, y in examples])
