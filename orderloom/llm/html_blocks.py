"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, with the path of open elements.  A block's vector
holds its hashed path (tag names, class and id words), its hashed words and a few measures (length, share of link text,
place on the page).  A bidirectional LSTM in numpy reads the blocks of the whole page and gives each the
probability of being main text; blocks of 0.5 or more are joined.

Training labels come from the pages themselves: where a page marks its article by an element, blocks inside it, apart from parts
that are named as boilerplate, are main text.  So that the labeller does not depend on that element, each sampled page is also
used in variants whose containers are renamed and into which comments, notices, side bars, forms and adverts made of the texts of
the sample are put.  The sample has at most ``most_pages`` pages, chosen by a hash of the id, and is fitted in one task.

Defined cases: a null or empty page has the empty text; markup that is not closed ends with the page, stray end tags are ignored;
pages of any length are read whole; repeated rows give equal texts; without a page that marks its article the labeller
falls back to path words; an empty table has no output; other columns are not read.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_PAGES = 240
VARIANTS = 6
PATH_SLOTS, WORD_SLOTS, MEASURES = 256, 16, 8
INPUT = PATH_SLOTS + WORD_SLOTS + MEASURES
HIDDEN = 12
BATCH_PAGES, BATCH_BLOCKS = 64, 20_000
SEED = 5

OPENING = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
ASIDE = re.compile(r"<!--|<!\[CDATA\[")
ATTRIBUTES = re.compile(r"""(?:[^'">]++|"[^"]{0,400}"|'[^']{0,400}'){0,40}+>""")     # of nearly all tags
SPECIAL = re.compile("""['">]""")
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORDS = re.compile(r"[a-z]+|[0-9]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = frozenset("script style noscript template textarea title svg iframe head select object canvas".split())
QUIET = INLINE | frozenset("script style noscript template svg iframe select object canvas".split())   # do not end a block
RAW_TEXT = frozenset("script style textarea title iframe".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main menu nav ol p pre section table ul li td th tr dt dd".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",)}
SCOPES = frozenset("ul ol dl table tr select body div article section main".split())

# Element names and path words that say what a part of a page is; labels for training only.
MAIN_NAMES = ("article", "main")
OTHER_WORDS = frozenset("nav header footer aside form menu sidebar comment comments ad ads advert banner cookie notice newsletter promo "
                        "related share social subscribe breadcrumb pagination widget popup".split())


class Tags:
    """Finds the tags of a page in time linear in its length, however its brackets and quotes are closed.

    A tag ends at the first ``>`` outside of quotes, or at the next ``>`` if there is none.  Where a search for it starts again behind a
    closed quote it goes on like any other from there, so those ends are kept.
    """

    def __init__(self, page: str):
        self.page, self.last, self.marks, self.ends = page, page.rfind(">"), None, {}

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Begin, end, slash, name and attributes of the next tag; comments and instructions have no name."""
        page = self.page
        while m := (OPENING if at <= self.last else ASIDE).search(page, at):
            begin, body, opened = m.start(), m.end(), m[0]
            if opened in ("<!--", "<![CDATA["):
                close = "-->" if opened == "<!--" else "]]>"
                end = page.find(close, body)
                return begin, len(page) if end < 0 else end + 3, "", "", ""
            if begin > self.last:                    # no bracket closes any more
                at = begin + 1
            elif not m[2]:
                return begin, page.find(">", body) + 1, "", "", ""
            else:
                plain = ATTRIBUTES.match(page, body)
                end = plain.end() if plain else self._unquoted_end(body)
                if end < 0:
                    end = page.find(">", body) + 1
                return begin, end, m[1], m[2], page[body:end - 1]
        return None

    def _unquoted_end(self, at: int) -> int:
        if self.marks is None:
            self.marks = [m.start() for m in SPECIAL.finditer(self.page)]
        walked, end = [], -1
        while at not in self.ends:
            walked.append(at)
            i = bisect_left(self.marks, at)
            if i == len(self.marks):
                break
            mark = self.marks[i]
            if self.page[mark] == ">":
                end = mark + 1
                break
            at = self.page.find(self.page[mark], mark + 1) + 1
            if not at:
                break
        else:
            end = self.ends[at]
        self.ends.update(dict.fromkeys(walked, end))
        return end


class Path:
    """Open elements above a block; children share their parents, so a page's paths take memory linear in its tags."""

    __slots__ = ("parent", "element", "inside", "spoiled", "sums")

    def __init__(self, parent: Path | None = None, element: str = ""):
        self.parent, self.element, self.sums = parent, element, None
        main = element.split(" ")[0] in MAIN_NAMES
        self.inside = main or parent is not None and parent.inside
        # Parts named as boilerplate, below the innermost main element.
        self.spoiled = not main and (parent is not None and parent.spoiled or not OTHER_WORDS.isdisjoint(WORDS.findall(element)))

    @classmethod
    def of(cls, *elements: str) -> Path:
        path = cls()
        for element in elements:
            path = cls(path, element)
        return path

    def names(self) -> tuple[str, ...]:
        out, path = [], self
        while path.parent is not None:
            out.append(path.element)
            path = path.parent
        return tuple(reversed(out))

    def vector(self) -> np.ndarray:
        """Hashed path: tag names with their depth from the leaf, and class and id words wherever they are."""
        waiting, path = [], self
        while path.sums is None:
            if path.parent is None:
                path.sums = np.zeros(PATH_SLOTS, np.float32)
            else:
                waiting.append(path)
                path = path.parent
        for path in reversed(waiting):
            path.sums = path.parent.sums + _element_vectors(path.element)[0]
        if self.parent is None:
            return self.sums
        out = self.sums + _element_vectors(self.element)[1]
        return out if self.parent.parent is None else out + _element_vectors(self.parent.element)[2]


@lru_cache(4000)
def _element_vectors(element: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An element's part in a path: two or more above the leaf, and what the leaf and the one above it have instead."""
    def hashed(*tokens: tuple[str, float]) -> np.ndarray:
        v = np.zeros(PATH_SLOTS, np.float32)
        for token, weight in tokens:
            h = zlib.crc32(token.encode())
            v[h % PATH_SLOTS] += weight if h >> 16 & 1 else -weight
        return v

    tag, _, names = element.partition(" ")
    leaf, above, higher = (hashed((f"d{depth}:{tag}", 0.5)) for depth in range(3))
    return hashed((f"t:{tag}", 1.0), *((f"n:{w}", 1.0) for w in WORDS.findall(names))) + higher, leaf - higher, above - higher


class Block:
    __slots__ = ("path", "pieces", "linked")

    def __init__(self, path: Path):
        self.path, self.pieces, self.linked = path, [], 0


class Open:
    """Open elements, with the places of each name, so that no end tag searches the stack."""

    def __init__(self):
        self.stack, self.places, self.blocks, self.root = [], {}, [], Path()

    def push(self, name: str, element: str) -> None:
        path = self.path()
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks.append(len(self.stack))
            path = Path(path, element)
        self.stack.append((name, path))

    def pop(self) -> str:
        name, _ = self.stack.pop()
        self.places[name].pop()
        if name not in INLINE:
            self.blocks.pop()
        return name

    def path(self) -> Path:
        return self.stack[-1][1] if self.stack else self.root

    def last(self, *names: str) -> int:
        """Place of the innermost open element of these names, -1 if none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def inner_block(self) -> int:
        return self.blocks[-1] if self.blocks else -1

    def ended_by(self, name: str) -> int:
        """Place of the element that an end tag closes: an inline end tag does not close blocks."""
        place = self.last(name)
        return place if name not in INLINE or place > self.inner_block() else -1

    def paragraph(self) -> int:
        place = self.inner_block()
        return place if place >= 0 and self.stack[place][0] == "p" else -1

    def sibling(self, name: str) -> int:
        place = self.last(*SIBLINGS[name])
        return place if place >= self.last(*(SCOPES - {"tr"} if name in ("td", "th") else SCOPES)) else -1


@lru_cache(100)
def _end_tag(name: str) -> re.Pattern:
    return re.compile(f"</{name}", re.I | re.A)


def blocks_of(page: str | None) -> list[tuple[Path, str, float]]:
    """Leaf blocks of a page in order: path, text, share of link text."""
    page, open_, out, block, at, links = page or "", Open(), [], None, 0, 0
    tags, hidden = Tags(page), 0

    def add(text: str) -> None:
        nonlocal block
        if text and not hidden:
            if block is None:
                if text.isspace():
                    return
                block = Block(open_.path())
                out.append(block)
            block.pieces.append(text)
            if links:
                block.linked += len(text)

    def close(place: int) -> None:
        nonlocal block, hidden, links
        while 0 <= place < len(open_.stack):
            name = open_.pop()
            hidden -= name in HIDDEN_TEXT
            links -= name == "a"
            if name not in QUIET:
                block = None

    while found := tags.after(at):
        begin, end, closing, name, rest = found
        add(page[at:begin])
        at = end
        if not name:
            continue                       # comment, doctype or instruction
        name = name.lower()
        if closing:
            close(open_.ended_by(name))
            if name not in QUIET:
                block = None
            continue
        if name in CLOSES_P:
            close(open_.paragraph())
        if name in SIBLINGS:
            close(open_.sibling(name))
        if name == "br":
            add(" ")
        elif name not in QUIET:
            block = None
        if name in VOID or rest.endswith("/") and name in ("path", "rect", "circle"):
            continue
        if name in RAW_TEXT:               # markup inside does not count
            m = _end_tag(name).search(page, at)
            at = m.start() if m else len(page)
        named = "" if "=" not in rest else " ".join(v.strip("\"'") for v in NAMES.findall(rest)).lower()
        open_.push(name, f"{name} {named}" if named else name)
        hidden += name in HIDDEN_TEXT
        links += name == "a"
    add(page[at:])
    kept = []
    for b in out:
        raw = "".join(b.pieces)
        text = " ".join(html.unescape(raw).split())
        if text:
            kept.append((b.path, text, min(b.linked / max(len(raw), 1), 1.0)))
    return kept


def _word_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of each block, scaled by their number, and the numbers."""
    data = np.frombuffer(("\n".join(texts) + "\n").lower().encode("utf-8", "replace"), np.uint8)
    inside = np.concatenate(([0], (data > 32).view(np.int8), [0]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    line = np.concatenate(([0], np.cumsum(data == 10)))[start]
    hashes = np.add.reduceat(np.append(data, 0).astype(np.uint32), start)      # byte sum, ends and length tell words apart
    hashes = (hashes * np.uint32(31) + data[start] * np.uint32(1009) + data[stop - 1] * np.uint32(9176)
              + (stop - start).astype(np.uint32) * np.uint32(65599)) * np.uint32(0x9E3779B1)
    sign = np.where(hashes >> np.uint32(8) & np.uint32(1), 1.0, -1.0)
    n = len(texts)
    counts = np.bincount(line, minlength=n)[:n]
    slots = (line * WORD_SLOTS + (hashes >> np.uint32(20)) % np.uint32(WORD_SLOTS)).astype(np.int64)
    bag = np.bincount(slots, sign, n * WORD_SLOTS)[:n * WORD_SLOTS].reshape(n, WORD_SLOTS)
    return bag / np.maximum(counts, 1)[:, None], counts


def vectors(pages: list[list[tuple[Path, str, float]]]) -> np.ndarray:
    """Input vectors of all blocks of some pages, page after page."""
    flat = [b for page in pages for b in page]
    out = np.zeros((len(flat), INPUT), np.float32)
    if not flat:
        return out
    for row, b in zip(out, flat):
        row[:PATH_SLOTS] = b[0].vector()
    out[:, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS], counts = _word_vectors([b[1] for b in flat])
    sizes = np.array([len(b[1]) for b in flat])
    place = np.concatenate([np.arange(len(p)) / max(len(p) - 1, 1) for p in pages])
    out[:, -MEASURES:] = np.stack([
        np.log1p(np.minimum(sizes, 1000)) / 6, np.minimum(counts, 60) / 30, [b[2] for b in flat],
        np.minimum(sizes / np.maximum(counts, 1), 12) / 10,
        [b[1][-1] in ".?!…»\"" for b in flat], place, [b[1][0] in "©®" for b in flat], np.ones(len(flat))], axis=1)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM with one output per block."""

    def __init__(self, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.theta = {}
        for side in "fb":
            self.theta[f"x{side}"] = rng.normal(0, 0.15, (INPUT, 4 * hidden))
            self.theta[f"h{side}"] = rng.normal(0, 0.2, (hidden, 4 * hidden))
            self.theta[f"o{side}"] = rng.normal(0, 0.3, hidden)
            self.theta[f"x{side}"][-1, hidden:2 * hidden] += 1.0     # the last input is 1: forget gates start open
        self.theta["bias"] = np.zeros(1)

    def _run(self, side: str, gates: np.ndarray, mask: np.ndarray, keep: bool):
        """One direction over padded gates (time, page, 4 hidden); states per time, and what training needs."""
        steps, pages, n = gates.shape[0], gates.shape[1], self.hidden
        h, c = np.zeros((pages, n), gates.dtype), np.zeros((pages, n), gates.dtype)
        out, trace = np.zeros((steps, pages, n), gates.dtype), []
        weights = self.theta[f"h{side}"].astype(gates.dtype)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ weights
            gate = _sigmoid(z[:, :3 * n])
            i, f, o, g = gate[:, :n], gate[:, n:2 * n], gate[:, 2 * n:], np.tanh(z[:, 3 * n:])
            m = mask[t][:, None]
            following = f * c + i * g
            tanh = np.tanh(following)
            if keep:
                trace.append((t, h, c, i, f, o, g, tanh, m))
            c = np.where(m, following, c)
            h = np.where(m, o * tanh, h)
            out[t] = h
        return out, trace

    @staticmethod
    def _padded(x: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        out, mask = np.zeros((max(sizes), len(sizes), x.shape[1]), x.dtype), np.zeros((max(sizes), len(sizes)), bool)
        at = 0
        for p, n in enumerate(sizes):
            out[:n, p], mask[:n, p] = x[at:at + n], True
            at += n
        return out, mask

    def probabilities(self, x: np.ndarray, sizes: list[int]) -> np.ndarray:
        """Of all blocks of some pages; pages without blocks are allowed."""
        out, starts = np.zeros(len(x)), np.cumsum([0, *sizes])
        order = sorted((p for p in range(len(sizes)) if sizes[p]), key=lambda p: sizes[p])
        gates = {side: x @ self.theta[f"x{side}"].astype(np.float32) for side in "fb"}
        for i in range(0, len(order), BATCH_PAGES):
            some = order[i:i + BATCH_PAGES]
            rows = np.concatenate([np.arange(starts[p], starts[p + 1]) for p in some])
            score, mask = self.theta["bias"][0], None
            for side in "fb":
                padded, mask = self._padded(gates[side][rows], [sizes[p] for p in some])
                score = score + self._run(side, padded, mask, False)[0] @ self.theta[f"o{side}"].astype(np.float32)
            out[rows] = _sigmoid(score.T[mask.T])
        return out

    def gradients(self, x: np.ndarray, sizes: list[int], target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss of the blocks and its gradients, by backpropagation through time."""
        padded, mask = self._padded(x, sizes)
        wanted, _ = self._padded(target[:, None], sizes)
        runs = {s: self._run(s, padded @ self.theta[f"x{s}"], mask, True) for s in "fb"}
        p = _sigmoid(sum(runs[s][0] @ self.theta[f"o{s}"] for s in "fb") + self.theta["bias"][0])
        y, total, n = wanted[:, :, 0], mask.sum(), self.hidden
        loss = -(np.where(y > 0.5, np.log(p + 1e-9), np.log(1 - p + 1e-9)) * mask).sum() / total
        error = (p - y) * mask / total
        grads = {"bias": np.array([error.sum()])}
        for s in "fb":
            out, trace = runs[s]
            grads[f"o{s}"] = (out * error[:, :, None]).sum(axis=(0, 1))
            gates = np.zeros((*mask.shape, 4 * n))
            recurrent = np.zeros((n, 4 * n))
            dh, dc = np.zeros((len(sizes), n)), np.zeros((len(sizes), n))
            for t, h, c, i, f, o, g, tanh, m in reversed(trace):
                dh = dh + error[t][:, None] * self.theta[f"o{s}"]
                here = dh * m
                d = dc * m + here * o * (1 - tanh * tanh)
                z = np.concatenate([d * g * i * (1 - i), d * c * f * (1 - f), here * tanh * o * (1 - o), d * i * (1 - g * g)], axis=1)
                gates[t] = z
                recurrent += h.T @ z
                dh, dc = np.where(m, z @ self.theta[f"h{s}"].T, dh), np.where(m, d * f, dc)
            grads[f"h{s}"] = recurrent
            grads[f"x{s}"] = np.tensordot(padded, gates, axes=([0, 1], [0, 1]))
        return float(loss), grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 10, rate: float = 0.02, batch: int = 32, seed: int = SEED):
        rng, step = np.random.default_rng(seed), 0
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.theta.items()}
        for _ in range(rounds):
            order = sorted(rng.permutation(len(pages)).tolist(), key=lambda p: len(pages[p][0]) // 8)
            batches = [order[i:i + batch] for i in range(0, len(order), batch)]
            for b in rng.permutation(len(batches)):
                some = [pages[p] for p in batches[b]]
                _, grads = self.gradients(np.concatenate([s[0] for s in some]).astype(np.float64), [len(s[0]) for s in some],
                                          np.concatenate([s[1] for s in some]).astype(np.float64))
                step += 1
                for k, g in grads.items():
                    first, second = moments[k]
                    first += 0.1 * (g - first)
                    second += 0.01 * (g * g - second)
                    self.theta[k] = self.theta[k] - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        return self


def path_label(path: Path) -> bool | None:
    """Whether path words put a block into the main text; None if nothing marks it."""
    return False if path.spoiled else True if path.inside else None


# Names for containers in training variants.
MAIN_CONTAINERS = ("div class=content", "div class='post entry'", "section class=story", "div id=main-content", "main", "div", "article",
                   "div class=article-body", "td class=text", "section")
OTHER_CONTAINERS = (
    ("ul", "li", "div class=menu"), ("ul", "li", "nav"), ("div", "a", "header class=site-header"), ("div", "p", "div class=sidebar"),
    ("div", "p", "aside"), ("div", "p", "div class='cookie notice'"), ("div", "p", "section class=comments"), ("div", "p", "div id=comments"),
    ("ol", "li class=comment", "div class=comment-list"), ("div", "label", "form"), ("div", "p", "div class='ad banner'"),
    ("div", "p", "div class=newsletter"), ("ul", "li", "div class=related"), ("div", "a", "div class='share social'"), ("div", "p", "footer"),
    ("div", "p", "div class=footer"), ("div", "span", "div class=promo"), ("div", "p", "div class=advert"), ("div", "p", "div role=alert"))


def variants(page: list[tuple[Path, str, float]], marks: list[bool], pool: list[str], rng: np.random.Generator):
    """The page under other names, with parts of other pages put around and into its article: blocks and labels."""
    container = MAIN_CONTAINERS[rng.integers(len(MAIN_CONTAINERS))].replace("class=", "").replace("id=", "").replace("'", "")
    shell = ("html", "body") + (("div",) if rng.random() < 0.5 else ())
    main = shell + (container,)

    def foreign(inner_part: bool = False) -> list[tuple]:
        outer, inner, name = OTHER_CONTAINERS[rng.integers(len(OTHER_CONTAINERS))]
        plain = [e.replace("class=", "").replace("id=", "").replace("role=", "").replace("'", "") for e in (name, outer, inner)]
        parent = main if inner_part or rng.random() < 0.2 else shell
        path = parent + (plain[0],) + ((plain[1],) if rng.random() < 0.6 else ()) + ((plain[2],) if plain[2].split()[0] not in INLINE else ())
        short = inner in ("a", "li", "label")
        path, out = Path.of(*path), []
        for _ in range(int(rng.integers(1, 8))):
            words = pool[rng.integers(len(pool))].split()
            n = int(rng.integers(1, 4 if short else 40))
            at = int(rng.integers(0, max(len(words) - n, 0) + 1))
            out.append((path, " ".join(words[at:at + n]) or "x", 1.0 if inner in ("a",) or (short and rng.random() < 0.7) else 0.0))
        return out

    top, moved = Path.of(*main), {}

    def under_main(path: Path) -> Path:
        """The elements below the innermost main element, under the new container."""
        waiting = []
        while path not in moved and path.element.split(" ")[0] not in MAIN_NAMES:
            waiting.append(path)
            path = path.parent
        here = moved.get(path, top)
        for path in reversed(waiting):
            here = moved[path] = Path(here, path.element)
        return here

    article = [(under_main(b[0]), b[1], b[2]) for b, mark in zip(page, marks) if mark]
    blocks, labels = [], []

    def put(some: list[tuple], mark: bool) -> None:
        blocks.extend(some)
        labels.extend([mark] * len(some))

    for _ in range(int(rng.integers(0, 4))):
        put(foreign(), False)
    cut = int(rng.integers(0, len(article) + 1)) if rng.random() < 0.7 else len(article)
    put(article[:cut], True)
    if cut < len(article):
        put(foreign(True), False)
        put(article[cut:], True)
    for _ in range(int(rng.integers(0, 4))):
        put(foreign(), False)
    return blocks, labels


def fit_pages(pages: list[str | None], variants_each: int = VARIANTS, seed: int = SEED) -> BlockLabeller | None:
    """Train on sampled pages; None if none of them marks its article."""
    rng, parsed = np.random.default_rng(seed), [blocks_of(p) for p in pages]
    marked = [(page, [path_label(b[0]) is True for b in page]) for page in parsed]
    marked = [(page, marks) for page, marks in marked if any(marks)]
    if not marked:
        return None
    pool = [b[1] for page, _ in marked for b in page]
    samples = []
    for page, marks in marked:
        samples.append((page, marks))
        samples += [variants(page, marks, pool, rng) for _ in range(variants_each)]
    samples = [s for s in samples if s[0]]
    training = []
    for blocks, marks in samples:
        x = vectors([blocks])
        for i in range(0, len(x), 120):          # long pages are cut for training only
            training.append((x[i:i + 120], np.array(marks[i:i + 120], np.float64)))
    return BlockLabeller().fit(training)


def extract(pages: list[str | None], model: BlockLabeller | None) -> list[str]:
    """Main texts of some pages."""
    out, parsed = [], [blocks_of(p) for p in pages]
    at = 0
    while at < len(parsed):
        stop, blocks = at, 0
        while stop < len(parsed) and (stop == at or blocks + len(parsed[stop]) <= BATCH_BLOCKS):
            blocks += len(parsed[stop])
            stop += 1
        some = parsed[at:stop]
        if model:
            chosen = model.probabilities(vectors(some), [len(p) for p in some]) >= 0.5
        else:
            chosen = np.array([path_label(b[0]) is not False for p in some for b in p], bool)
        first = 0
        for p in some:
            out.append("\n".join(b[1] for b, keep in zip(p, chosen[first:first + len(p)]) if keep))
            first += len(p)
        at = stop
    return out


def train(pages: DataFrame, key: str = "page_id", page: str = "html", most_pages: int = MOST_PAGES) -> BlockLabeller | None:
    """Fit on a bounded sample of pages."""
    ids = pages.where(F.col(page).isNotNull()).select(F.col(key).alias("_id"))
    ids = F.broadcast(ids.distinct().orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(most_pages))
    sample = pages.join(ids, F.col(key) == F.col("_id")).select(F.col(page)).distinct().repartition(1)

    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(p for b in batches for p in b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_pages(rows))])], names=["model"])

    got = sample.mapInArrow(fit_rows, "model binary").first()
    return pickle.loads(got["model"]) if got else None


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, key, page))

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for htmls in batches:
            texts = htmls.tolist()
            found = []
            for i in range(0, len(texts), 500):
                found += extract(texts[i:i + 500], model)
            yield pd.Series(found, dtype=object)

    texts = pages.select(key, url, of(F.col(page)).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
