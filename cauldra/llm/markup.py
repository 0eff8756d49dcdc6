"""Markup residue: every block of a document labelled, and clean text with its structure kept.

A document is cut into leaves: tags, comments, entities, inline constructs of any notation, and the
text between them by lines. Each leaf has a vector of its tag path, its shape and its hashed words. A
recurrent labeller (one LSTM layer in each direction, numpy only) reads the whole sequence and gives
each leaf a notation and a structure, so that the same ``* item`` is a list of one notation or of
another by what else the document holds. An exact check afterwards vetoes labels that the leaf's own
characters cannot have; it never adds any.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import spread

NOTATIONS = {"html": ("heading", "list", "code", "other"), "markdown": ("heading", "list", "code", "other"), "wiki": ("heading", "list", "code", "other"), "latex": ("heading", "list", "code", "other", "formula")}
LABELS: tuple[tuple[str, str] | None, ...] = (None, *((m, s) for m, ss in NOTATIONS.items() for s in ss))
LABEL = {x: i for i, x in enumerate(LABELS)}

MODEL = Path(__file__).with_name("models") / "markup.npz"

_MATH = r"(?:equation|align|gather|multline|math|displaymath|eqnarray)\*?"
_KINDS = (
    ("comment", r"<!--.*?(?:-->|\Z)"),
    ("script", r"<(?P<_el>script|style)\b[^>]*>.*?(?:</(?P=_el)\s*>|\Z)"),
    ("end", r"</[a-zA-Z][^<>]*>"),
    ("tag", r"<[a-zA-Z][^<>]*>|<![a-zA-Z][^<>]*>"),
    ("escaped", r"&lt;/?[a-zA-Z][\w -]*(?:=[^&<>]*)?/?&gt;"),
    ("entity", r"&(?:amp;)?(?:#\d{1,7}|#x[0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"),
    ("mathenv", rf"\\begin\{{(?P<_env>{_MATH})\}}.*?\\end\{{(?P=_env)\}}"),
    ("begin", r"\\begin\{[^}\n]*\}(?:\[[^\]\n]*\])?"),
    ("finish", r"\\end\{[^}\n]*\}"),
    ("dollars", r"\$\$[^$]+\$\$"),
    ("paren", r"\\\(.+?\\\)"),
    ("bracket", r"\\\[.+?\\\]"),
    ("dollar", r"(?<![\\$])\$[^$\n]+\$(?!\$)"),
    ("command", r"\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{(?:[^{}\n]|\{[^{}\n]*\})*\}"),
    ("item", r"\\item\b"),
    ("escape", r"\\[&%#_$*`\[\](){}.!+-]"),
    ("bare", r"\\[a-zA-Z]+"),
    ("template", r"\{\{[^{}]*\}\}"),
    ("wikilink", r"\[\[[^\[\]\n]+\]\]"),
    ("image", r"!\[[^\[\]\n]*\]\([^()\n]*\)"),
    ("link", r"\[[^\[\]\n]+\]\([^()\n]*\)"),
    ("quotes3", r"'''[^\n]+?'''"),
    ("quotes2", r"''[^\n]+?''"),
    ("stars", r"\*\*(?=\S)[^*\n]+?(?<=\S)\*\*"),
    ("lines", r"(?<!\w)__(?=\S)[^_\n]+?(?<=\S)__(?!\w)"),
    ("star", r"(?<![*\w])\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*(?![*\w])"),
    ("line", r"(?<![_\w])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?![_\w])"),
    ("tick", r"(?<!`)`[^`\n]+`(?!`)"),
    ("newline", r"\r\n|\r|\n"),
)
_TOKEN = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _KINDS), re.S | re.I)
KINDS = ("text", *(k for k, _ in _KINDS if k not in ("newline", "end")))
_KIND = {k: i for i, k in enumerate(KINDS)}
_TAG = re.compile(r"<\s*([a-zA-Z][a-zA-Z0-9]*)")
_VOID = frozenset("br img hr input meta link wbr area base col embed source track".split())
_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 ul ol table pre div blockquote dl form section article header footer".split())
_BOXES = _BLOCK | {"li", "tr", "br", "dt", "dd"}
_INNER = {**{f"h{i}": 1 for i in range(1, 7)}, "li": 2, "ul": 2, "ol": 2, "dl": 2, "dt": 2, "dd": 2, "pre": 3, "code": 3, "samp": 3, "kbd": 3, "table": 4, "tr": 4, "td": 4, "th": 4}


_ESCAPE = re.compile(r"\\[&%#_$]")
#: The path element of lines between fences.
FENCE = "```"


class Leaf(NamedTuple):
    kind: str
    start: int
    end: int
    path: tuple[str, ...]  # the innermost elements around it, PATH at most
    breaks: int  # line breaks right before it, 2 for a blank line
    first: bool  # the first leaf of its line
    inner: int  # what the innermost element that tells is, as _INNER has it, at any depth
    heading: bool  # inside a heading, at any depth
    item: bool  # inside a list item, at any depth
    inside: bool  # inside any element, fences aside
    box: int  # which boxes are around it, at any depth: equal rows of boxes have equal numbers


#: Innermost elements that the labeller reads one by one; what lies further out it reads as ``inner``.
PATH = 6


class _Open(NamedTuple):
    """An open element, with what holds for all that is inside it."""

    name: str
    inner: int
    heading: bool
    item: bool
    inside: bool
    box: int


_OUTSIDE = _Open("", 0, False, False, False, 0)


def leaves(text: str) -> list[Leaf]:
    """The leaves of a document in order; together with white space and end tags they cover it. Depth
    costs little: an element knows what its ancestors tell."""
    out: list[Leaf] = []
    stack: list[_Open] = []
    open_names: list[str] = []
    boxes: dict[tuple[int, str], int] = {}
    breaks, first, at = 2, True, 0

    def push(name: str) -> None:
        up = stack[-1] if stack else _OUTSIDE
        box = boxes.setdefault((up.box, name), len(boxes) + 1) if name in _BOXES else up.box
        fence = name == FENCE
        heading = name[0] == "h" and name[1:].isdigit()
        stack.append(_Open(name, _INNER.get(name, up.inner), up.heading or heading, up.item or name == "li", up.inside or not fence, box))
        open_names.append(name)

    def cut(n: int) -> None:
        del stack[n:], open_names[n:]

    def put(kind: str, i: int, j: int) -> None:
        nonlocal breaks, first
        up = stack[-1] if stack else _OUTSIDE
        out.append(Leaf(kind, i, j, tuple(open_names[-PATH:]), min(breaks, 2), first, up.inner, up.heading, up.item, up.inside, up.box))
        breaks, first = 0, False

    def words(i: int, j: int) -> None:
        if text[i:j].strip():
            fence = first and text[i:j].lstrip()[:3] in ("```", "~~~")
            if fence and FENCE in open_names:
                k = open_names.index(FENCE)
                del stack[k], open_names[k]
                put("text", i, j)
            else:
                put("text", i, j)
                if fence:
                    push(FENCE)

    def last(name: str) -> int:
        return len(open_names) - 1 - open_names[::-1].index(name)

    for m in _TOKEN.finditer(text):
        words(at, m.start())
        at = m.end()
        kind = next(k for k in (m.lastgroup, "script", "mathenv") if k and not k.startswith("_") and m[k] is not None)
        if kind == "newline":
            breaks, first = breaks + 1, True
        elif kind == "end":
            name = re.match(r"</\s*([a-zA-Z][a-zA-Z0-9]*)", m[0])[1].lower()
            if name in open_names:
                cut(last(name))
        elif kind == "tag":
            named = _TAG.match(m[0])
            name = named[1].lower() if named else "!"
            if name in _BLOCK and "p" in open_names and not (set(open_names[open_names.index("p") :]) & {"li", "td", "div"}):
                cut(open_names.index("p"))
            if name in ("li", "td", "tr", "th", "dt", "dd") and name in open_names:
                top = last(name)
                if not set(open_names[top:]) & {"ul", "ol", "table"}:
                    cut(top)
            push(name)
            put("tag", m.start(), m.end())
            if name in _VOID or name == "!" or m[0].endswith("/>"):
                cut(len(stack) - 1)
        else:
            put(kind, m.start(), m.end())
            if kind == "command":
                # Escapes in a command's argument are leaves of their own, inside the command's.
                for e in _ESCAPE.finditer(text, text.index("{", m.start()), m.end()):
                    put("escape", e.start(), e.end())
    words(at, len(text))
    return out


PREFIXES = tuple(re.compile(p) for p in (r"#\s", r"#{2,6}\s", r"#+\S", r"\*\s", r"\*\*+\s", r"-\s", r"\+\s", r"\d+[.)]\s", r">", r"\|", r"={3,}\s*$", r"==", r"=", r"```", r"~~~", r"[:;]", r"-{3,}\s*$", r"\S"))
_SUFFIXES = tuple(re.compile(p) for p in (r"=\s*$", r"\|\s*$", r"#\s*$", r"`\s*$", r"[.!?…]\s*$", r":\s*$"))
_HAS = tuple(re.compile(p) for p in (r"=", r"\\", r"[{}]", r"[\^_]", r"\d", r"[^\W\d_]", r"\|", r"[<>]", r"[^\W\d_]{2,}\s+[^\W\d_]{2,}\s+[^\W\d_]{2,}", r"^\$\d", r"\*"))
PATH_DIMS, WORD_DIMS = 16, 16
_WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")
DIMS = len(KINDS) + PATH_DIMS + 5 + 4 + len(PREFIXES) + len(_SUFFIXES) + len(_HAS) + 4 + WORD_DIMS


@lru_cache(maxsize=100_000)
def _hashed(word: str, dims: int) -> np.ndarray:
    """A fixed random vector of a word, from its hash."""
    return np.random.default_rng(zlib.crc32(word.encode("utf-8", "replace"))).standard_normal(dims).astype(np.float32)


def _vector(kind: str, s: str, path: tuple[str, ...], breaks: int, first: bool, inner: int) -> np.ndarray:
    row = np.zeros(DIMS, dtype=np.float32)
    row[_KIND[kind]] = 1
    at = len(KINDS)
    for i, t in enumerate(reversed(path)):
        row[at : at + PATH_DIMS] += _hashed(f"<{t}", PATH_DIMS) / (1 + i)
    at += PATH_DIMS
    row[at + inner] = 1
    at += 5
    row[at + breaks] = 1
    row[at + 3] = first
    at += 4
    if first:
        body = s.lstrip() if kind == "text" else s
        row[at + next((i for i, p in enumerate(PREFIXES) if p.match(body)), len(PREFIXES) - 1)] = 1
    at += len(PREFIXES)
    for i, p in enumerate(_SUFFIXES):
        row[at + i] = p.search(s[-8:]) is not None
    at += len(_SUFFIXES)
    for i, p in enumerate(_HAS):
        row[at + i] = p.search(s) is not None
    at += len(_HAS)
    row[at + min(3, len(s) // 15)] = 1
    at += 4
    found = _WORDS.findall(s)
    if kind == "tag":
        found = found[:2]
    if found:
        row[at:] = np.sum([_hashed(w.lower(), WORD_DIMS) for w in found], axis=0) / len(found)
    return row


_known_vector = lru_cache(maxsize=50_000)(_vector)


def vectors(text: str, own: list[Leaf]) -> np.ndarray:
    """One row per leaf. Short leaves repeat and are remembered."""
    return np.stack([(_known_vector if x.end - x.start <= 200 else _vector)(x.kind, text[x.start : x.end], x.path, x.breaks, x.first, x.inner) for x in own])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def run_lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states (time, batch, hidden) of an LSTM over x (time, batch, dims); with ``keep`` also
    what the backward pass needs."""
    steps, batch, _ = x.shape
    hidden = u.shape[0]
    h, c = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
    from_x = x @ w + b
    out = np.empty((steps, batch, hidden), np.float32)
    kept = []
    for t in range(steps):
        z = from_x[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in range(3))
        g = np.tanh(z[:, 3 * hidden :])
        before = c
        c = f * c + i * g
        tc = np.tanh(c)
        previous, h = h, o * tc
        out[t] = h
        if keep:
            kept.append((i, f, o, g, before, tc, previous))
    return (out, kept) if keep else out


def turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence of (time, batch, dims) backwards, padding left at its end."""
    t = np.arange(x.shape[0])[:, None]
    at = np.where(t < lengths[None, :], lengths[None, :] - 1 - t, t)
    return x[at, np.arange(x.shape[1])[None, :]]


class Labeller:
    """The fitted network."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    @lru_cache(maxsize=4)
    def load(path: str) -> Labeller:
        with np.load(path) as z:
            return Labeller({k: z[k].astype(np.float32) for k in z.files})

    def scores(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        w = self.w
        ahead = run_lstm(x, w["wf"], w["uf"], w["bf"])
        back = turned(run_lstm(turned(x, lengths), w["wb"], w["ub"], w["bb"]), lengths)
        return np.concatenate([ahead, back], axis=2) @ w["wo"] + w["bo"]

    def label(self, texts: list[str]) -> list[list[tuple[Leaf, int]]]:
        """(leaf, label number) of each text. Texts are run in groups of like length; the whole text
        is one sequence, however long."""
        cut = [leaves(t) for t in texts]
        out: list[list[tuple[Leaf, int]]] = [[] for _ in texts]
        order = sorted((i for i, own in enumerate(cut) if own), key=lambda i: len(cut[i]))
        at = 0
        while at < len(order):
            group = [order[at]]
            at += 1
            while at < len(order) and len(group) < 128 and len(cut[order[at]]) * (len(group) + 1) <= 20_000:
                group.append(order[at])
                at += 1
            lengths = np.array([len(cut[i]) for i in group])
            x = np.zeros((lengths.max(), len(group), DIMS), np.float32)
            for k, i in enumerate(group):
                x[: lengths[k], k] = vectors(texts[i], cut[i])
            best = self.scores(x, lengths).argmax(axis=2)
            for k, i in enumerate(group):
                out[i] = list(zip(cut[i], best[: lengths[k], k].tolist()))
        return out


_HTML_KINDS = frozenset(("tag", "comment", "script", "escaped", "entity"))
_FORMULA = frozenset(("mathenv", "dollars", "paren", "bracket", "dollar"))
_FENCE = re.compile(r"^\s*(?:```|~~~)", re.M)


def checked(text: str, labelled: list[tuple[Leaf, int]]) -> list[tuple[Leaf, tuple[str, str] | None]]:
    """The labels, without those that the leaf's own characters rule out."""
    fenced = len(_FENCE.findall(text)) >= 2
    verbatim = "\\begin{verbatim" in text or "\\begin{lstlisting" in text
    out = []
    for k, (x, n) in enumerate(labelled):
        label, s = LABELS[n], text[x.start : x.end].strip()
        ok = True
        if label:
            notation, structure = label
            if notation == "html":
                ok = x.kind in _HTML_KINDS or x.inside
            elif structure == "formula":
                ok = x.kind in _FORMULA and not re.match(r"\$\d[^=\\^_]*\$$", s)
            elif notation == "latex":
                ok = "\\" in s or (structure == "code" and verbatim) or (x.kind == "text" and structure in ("list", "heading", "other"))
            elif (notation, structure) == ("markdown", "heading"):
                after = text[labelled[k + 1][0].start : labelled[k + 1][0].end].strip() if k + 1 < len(labelled) else ""
                ok = bool(re.match(r"#{1,6}\s", s) or re.fullmatch(r"=+|-{2,}", s) or re.fullmatch(r"=+|-{2,}", after))
            elif (notation, structure) == ("markdown", "code"):
                ok = fenced or x.kind == "tick"
            elif structure == "list":
                ok = x.first and bool(re.match(r"[*+\-#:;]+(?:\s|$)|\d+[.)](?:\s|$)", s))
            elif (notation, structure) == ("wiki", "heading"):
                ok = bool(re.match(r"=+[^=].*=+$", s))
            elif x.kind == "text" and structure == "other":
                ok = bool(re.match(r"[>|!{}]", s)) or "|" in s or (notation == "wiki" and bool(re.search(r"''|\[\[|\{\{|\]\]|\}\}", s)))
        out.append((x, label if ok else None))
    return out


def found(text: str, labelled: list[tuple[Leaf, int]]) -> list[tuple[str, str]]:
    """The distinct (notation, structure) that hold for leaves bearing marks of their own. Text that
    only lies inside a structure adds nothing beyond the structure's marks."""
    out = set()
    for x, label in checked(text, labelled):
        if label and not (label[0] == "html" and x.kind == "text"):
            out.add(label)
    return sorted(out)


_PLAIN_INLINE = {"stars": 2, "lines": 2, "star": 1, "line": 1, "quotes3": 3, "quotes2": 2, "tick": 1}


def _inline(kind: str, s: str) -> str:
    """An inline construct without its marks."""
    if kind in _PLAIN_INLINE:
        n = _PLAIN_INLINE[kind]
        return s[n:-n]
    if kind in ("entity", "escaped"):
        return html.unescape(html.unescape(s)) if kind == "entity" else ""
    if kind == "wikilink":
        return s[2:-2].split("|")[-1]
    if kind in ("link", "image"):
        return re.match(r"!?\[([^\]]*)\]", s)[1]
    if kind == "command":
        return _ESCAPE.sub(lambda e: e[0][1:], s[s.index("{") + 1 : -1])
    if kind == "escape":
        return s[1:]
    return ""


_ASIDE = ("comment", "script")


def clean(text: str, labelled: list[tuple[Leaf, int]]) -> str:
    """Clean text: headings as ``# line``, list items as ``- line``, code between fences, formulas as
    they stand; all other markup is taken off. Text without markup keeps its words and line breaks."""
    lines: list[str] = []
    line, code, style, boxes, held = "", False, None, 0, ""

    def flush() -> None:
        nonlocal line, style
        body = re.sub(r"[ \t\xa0]+", " ", line).strip()
        if body:
            lines.append({"heading": "# ", "list": "- "}.get(style, "") + body)
            style = None
        line = ""

    def fence(on: bool) -> None:
        nonlocal code, held
        if on != code:
            flush()
            lines.extend(part for part in held.splitlines() if part.strip())
            lines.append("```")
            code, held = on, ""

    covered = 0
    for x, label in checked(text, labelled):
        s = text[x.start : x.end]
        notation, structure = label or (None, None)
        if x.kind in _ASIDE or x.end <= covered:
            continue
        covered = x.end
        now = x.box
        if now != boxes or x.breaks == 2 or (x.breaks and not now):
            if not code:
                flush()
                style = None if x.breaks or now != boxes else style
            boxes = now
        if structure == "code":
            if x.kind in ("begin", "finish") or (notation == "html" and x.kind == "tag") or (notation == "markdown" and _FENCE.match(s)):
                flush()
            elif x.kind == "tick":
                line += s
            else:
                fence(True)
                held += ("\n" if x.breaks else "") + html.unescape(s)
            continue
        fence(False)
        if x.kind == "tag":
            name = x.path[-1] if x.path else ""
            line += " " if name in ("td", "th") else ""
            if name in _BOXES:
                flush()
            continue
        if x.heading:
            style = "heading"
        elif x.item:
            style = "list" if not lines or line or boxes else style
        if structure == "formula" or (label is None and x.kind not in ("text", "entity")):
            line += s
        elif structure == "heading" and notation != "html":
            flush()
            if re.fullmatch(r"\s*(?:=+|-{2,})\s*", s):
                # The line above is the heading.
                if lines and not lines[-1].startswith("# "):
                    lines[-1] = "# " + lines[-1]
                continue
            style = "heading"
            line = (re.sub(r"^\s*(?:#+|=+)\s*|\s*(?:#+|=+)\s*$", "", s) if x.kind == "text" else _inline(x.kind, s))
            flush()
        elif structure == "list" and notation != "html":
            if x.kind in ("begin", "finish"):
                flush()
                continue
            if x.kind == "item" or x.first:
                flush()
            style = "list"
            line += "" if x.kind == "item" else re.sub(r"^\s*(?:[*+\-#:;]+|\d+[.)])\s*", "", s)
        elif x.kind == "text":
            if structure == "other" and notation in ("markdown", "wiki"):
                s = "" if re.fullmatch(r"[\s|:\-]+", s) else re.sub(r"^\s*[>|]\s*|\s*\|\s*$", "", s).replace("|", " ")
            line += html.unescape(s)
        else:
            line += _inline(x.kind, s)
    fence(False)
    flush()
    return "\n".join(lines)


def label_documents(docs: DataFrame, key: str, text: str, model: str | None = None) -> DataFrame:
    """(key, clean, found): clean text and array<struct<markup,structure>> of every row.

    Null text gives null clean text and an empty list, empty and blank text empty clean text. Texts are
    labelled whole. ``model`` is the path of fitted weights; without one the package's own are read
    on the driver and broadcast (a fixed size).
    """
    with np.load(model or MODEL) as z:
        weights = {k: z[k] for k in z.files}
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    source = docs.select(key, F.col(text).alias("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = Labeller({k: v.astype(np.float32) for k, v in shared.value.items()})
        for b in batches:
            texts = [t or "" for t in b["_text"]]
            told = net.label(texts)
            yield pd.DataFrame(
                {
                    key: b[key],
                    "clean": [None if raw is None else clean(t, own) for raw, t, own in zip(b["_text"], texts, told)],
                    "found": [[{"markup": m, "structure": s} for m, s in found(t, own)] for t, own in zip(texts, told)],
                }
            )

    kind = source.schema[key].dataType.simpleString()
    return spread(source, key).mapInPandas(run, f"`{key}` {kind}, clean string, found array<struct<markup:string,structure:string>>")
