"""Fits the markup labeller on documents that it writes itself: ``python -m cauldra.llm.markup_training``.

Every training document is a sequence of blocks of one or two notations, of look-alikes and of plain
sentences of invented words; each piece is written with its label. Bounded by DOCUMENTS.
"""

from __future__ import annotations

import random
import sys

import numpy as np

from . import markup as m

DOCUMENTS = 9_000
HELD_OUT = 600
HIDDEN = 32
EPOCHS = 14
BATCH = 48
SEED = 7

Piece = tuple[str, tuple[str, str] | None]


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.vocabulary = ["".join(self.r.choice("bcdfghjklmnprstvw") + self.r.choice("aeiou") + self.r.choice(["", "n", "r", "s", "l"]) for _ in range(self.r.randint(1, 3))) for _ in range(4000)]

    def words(self, least: int, most: int) -> str:
        return " ".join(self.r.choice(self.vocabulary) for _ in range(self.r.randint(least, most)))

    def sentence(self) -> str:
        if self.r.random() < 0.12:
            return self.words(1, 5)
        s = self.words(4, 16).capitalize()
        if self.r.random() < 0.25:
            s = s.replace(" ", f" {self.r.randint(1, 2100)} ", 1)
        if self.r.random() < 0.3:
            s = s.replace(" ", ", ", 1)
        if self.r.random() < 0.15:
            s = f"{self.words(1, 3).capitalize()}: {s}"
        return s + self.r.choice([".", ".", ".", "?", "!"])

    def title(self) -> str:
        t = self.words(1, 4).capitalize()
        return t + (f" & {self.words(1, 2)}" if self.r.random() < 0.15 else "")

    def alike(self) -> str:
        """A plain line that only looks like markup: a sentence with some signs that notations use,
        standing where plain text may have them."""
        n, pick = self.r.randint, self.r.choice
        word = lambda: self.words(1, 1)
        signs = [
            lambda: f"{pick(['$', 'US$', '€', '$'])}{n(1, 900)}",
            lambda: f"{pick(['$', '$', '£'])}{n(1, 90)}.{n(10, 99)}",
            lambda: f"{word()} {pick(['<', '>', '<=', '>=', '=', '==', '!='])} {pick([word(), str(n(1, 99))])}",
            lambda: f"{pick(['<', '>', '~', '#', '±', '*', '^', '='])}{n(1, 99)}",
            lambda: f"{n(1, 99)} {pick(['*', 'x', '/', '+', '-', '=', '|'])} {n(1, 99)} {pick(['*', '/', '=', '>', '|'])} {n(1, 99)}",
            lambda: f"{word()}_{pick([word(), str(n(1, 99))])}_{pick([word(), str(n(1, 99)), pick('abcxyz')])}",
            lambda: f"{word().upper()}_{n(1, 99)}",
            lambda: f"{pick(['[', '(', '{', '<'])}{self.words(1, 2)}{pick([']', ')', '}', ' >'])}",
            lambda: f"[{self.words(1, 2)}]",
            lambda: f"{{{self.words(1, 2)}}}",
            lambda: f"{word()}{pick(['&', ' & ', ' &', '/', '|', ' | ', '*', '#'])}{word()}",
            lambda: f"{word()}*",
            lambda: f"{pick('CDX')}:\\{word()}\\{word()}",
            lambda: "".join(pick("\\/|<>:;()-^o3x") for _ in range(n(2, 3))),
            lambda: f"{n(1, 99)}{pick(['%', '°C', '#', ' °F', '*'])}",
            lambda: f"\"{self.words(1, 2)}\"{pick([' - ', ' -- ', ' = ', ': '])}'{word()}'",
        ]
        parts = [self.words(1, 4).capitalize()]
        for _ in range(n(1, 3)):
            parts += [pick(signs)(), self.words(1, 3)]
        if self.r.random() < 0.3:
            # Two amounts in a line enclose what is between them.
            parts += [f"${n(1, 90)}", self.words(1, 3), f"${n(1, 90)}", self.words(0, 2)]
        return " ".join(p for p in parts if p) + pick([".", ".", ".", "!", "?", ""])

    def formula(self) -> Piece:
        a, b, c = (self.r.choice("abcdkmnprtvwxyTVP") for _ in range(3))
        f = self.r.choice([f"{a}_{{n+1}} = {a}_n + {self.r.randint(1, 9)}", f"{a} = {b} / {c}", rf"\frac{{{a}_{{{self.words(1, 1)}}}}}{{{b}_{{{self.words(1, 1)}}}}} = 0.{self.r.randint(1, 99)}", rf"\Delta {a} = {self.r.randint(10, 99)} - {self.r.randint(1, 20)}", rf"{a}_n = {a}_0 e^{{-k{b}}}", rf"{a} = \frac{{{b}}}{{{c}}}", rf"\sum_{{i=1}}^n {a}_i", rf"\alpha {a}^2 + {b}", f"{a}({b}) < {c}"])
        env = self.r.choice(["equation", "equation", "align", "equation*"])
        return self.r.choice([f"${f}$", f"$${f}$$", rf"\({f}\)", rf"\[{f}\]", rf"\begin{{{env}}}{f}\end{{{env}}}"]), ("latex", "formula")

    def code_lines(self) -> list[str]:
        n = self.r.randint
        return self.r.choice([[f"{self.words(1, 1)}: {n(1, 99)}{self.r.choice(['C', 'g', 'x', ''])}" for _ in range(n(2, 4))], [f"{self.words(1, 1)}={n(1, 9)}:{n(1, 20)}" for _ in range(n(1, 3))], [f"T{i} {n(60, 99)}" for i in range(n(2, 4))], [" / ".join(f"{n(3, 40)}s" for _ in range(n(2, 5)))], [f"{self.words(1, 1)}:AX-{n(1, 99)}", f"{self.words(1, 1)}:{n(1, 9)}"], [f"if x_{n(1, 9)} > {n(1, 9)}:", f"    {self.words(1, 1)}(x * {n(2, 9)})"], ["# " + self.words(1, 3), f"{self.words(1, 1)} --{self.words(1, 1)}"], ["* " + self.words(1, 2), "$" + self.words(1, 1)]])

    def tag(self, name: str, attributes: bool = True) -> str:
        n = name.upper() if self.r.random() < 0.15 else name
        extra = self.r.choice(["", "", "", f' class="{self.words(1, 1)}"', f' data-{self.words(1, 1)}="{self.r.randint(1, 9)}"', f' style="{self.words(1, 1)}:{self.r.randint(1, 900)}"']) if attributes else ""
        return f"<{n}{extra}>"

    # Blocks: lists of pieces.
    def html(self) -> list[Piece]:
        H, L, C, O = (("html", s) for s in ("heading", "list", "code", "other"))
        k = self.r.random()
        if k < 0.12:
            name = f"h{self.r.randint(1, 5)}"
            title = self.title().replace("&", self.r.choice(["&", "&amp;"]))
            deep = self.r.choice([1, 1, 1, 2, 4])
            inner: list[Piece] = [*[(self.tag("span"), O)] * deep, (title, H), *[("</span>", H)] * deep] if self.r.random() < 0.3 else self.entities(title, H)
            return [(self.tag(name), H), *inner, (f"</{name}>", H)]
        if k < 0.27:
            name, out = self.r.choice(["ul", "ol"]), []
            out.append((self.tag(name), L))
            closed = self.r.random() < 0.7
            for _ in range(self.r.randint(1, 4)):
                out += [("\n", None), (self.tag("li"), L)]
                p = self.r.random() < 0.3
                if p:
                    out.append(("<p>", O))
                out.append((self.sentence(), L if not p else O))
                if p:
                    out.append(("</p>", O))
                if closed:
                    out.append(("</li>", L))
            return [*out, ("\n", None), (f"</{name}>", L)]
        if k < 0.37:
            body = "\n".join(self.code_lines())
            return self.r.choice([[("<pre>", C), (body, C), ("</pre>", C)], [("<pre>", C), ("<code>", C), (body, C), ("</code>", C), ("</pre>", C)], [(self.tag("code"), C), (body, C), ("</code>", C)]])
        if k < 0.45:
            out = [(self.tag("table"), O)]
            for _ in range(self.r.randint(1, 3)):
                out += [("<tr>", O)] + [x for _ in range(2) for x in (("<td>", O), *self.entities(self.words(1, 2) + self.r.choice(["", "", "&deg;C", " &lt; 3"]), O), ("</td>", O))] + [("</tr>", O)]
            return [*out, ("</table>", O)]
        if k < 0.52:
            return [(f"<!-- {self.words(1, 3)} {self.r.randint(1, 99)} -->", O)] + ([(f"<style>.{self.r.choice('xyz')}{{color:#{self.r.randint(100, 999)}}}</style>", O)] if self.r.random() < 0.6 else [(f"<script>var {self.words(1, 1)}={self.r.randint(1, 999)};</script>", O)])
        if k < 0.58:
            return [("&lt;p&gt;", O), (self.sentence(), None), ("&lt;/p&gt;", O), (" " + self.sentence(), None), (self.r.choice(["&amp;nbsp;", "&nbsp;", ""]), O)]
        if k < 0.66:
            return [(self.sentence() + " ", None), (f'<a href="https://{self.words(1, 1)}.example/{self.r.randint(1, 999)}">', O), (self.sentence(), O), ("</a>", O)]
        if k < 0.74:
            return [(self.sentence(), None), (self.r.choice(["<br>", "<br />", "<BR/>"]), O), ("\n", None), (self.sentence(), None), ("<br>", O)]
        if k < 0.78:
            return [*self.entities(self.sentence() + self.r.choice([" &mdash; ", "&nbsp;", " &lt; ", " &amp; ", " &#8217; "]) + self.sentence(), None, O)]
        name = self.r.choice(["p", "p", "p", "div"])
        out = [(self.tag(name), O), (self.sentence(), O)]
        if self.r.random() < 0.4:
            i = self.r.choice(["strong", "em", "b", "span"])
            out += [(" ", None), (self.tag(i), O), (self.sentence(), O), (f"</{i}>", O)]
        if self.r.random() < 0.15:
            out += [(" ", None), self.formula()]
        if self.r.random() < 0.2:
            out += [("<br>", O), (self.sentence(), O)]
        if self.r.random() < 0.15:
            out += [("&nbsp;", O), (self.sentence(), O)]
        return out + ([(f"</{name}>", O)] if self.r.random() < 0.85 else [])

    def entities(self, s: str, label, of=("html", "other")) -> list[Piece]:
        out, at = [], 0
        for e in m.re.finditer(r"&#?\w+;", s):
            out += [(s[at : e.start()], label), (e[0], of)]
            at = e.end()
        return [*out, (s[at:], label)]

    def markdown(self) -> list[Piece]:
        H, L, C, O = (("markdown", s) for s in ("heading", "list", "code", "other"))
        k = self.r.random()
        if k < 0.18:
            n = self.r.randint(1, 4)
            return self.r.choice([[(f"{'#' * n} {self.title()}", H)], [(f"{'#' * n} {self.title()} {'#' * n}", H)], [(f"{self.title()}\n", H), (self.r.choice("=-") * self.r.randint(4, 12), H)]])
        if k < 0.4:
            mark = self.r.choice(["* ", "- ", "+ ", "1"])
            out = []
            for i in range(self.r.randint(2, 4)):
                out += [("\n" if i else "", None), ((f"{i + 1}. " if mark == "1" else mark) + self.sentence(), L)]
            return out
        if k < 0.55:
            f = self.r.choice(["```", "~~~"])
            return [(f + self.r.choice(["", "", "text", "python"]), C), ("\n", None)] + [x for line in self.code_lines() for x in ((line, C), ("\n", None))] + [(f, C)]
        if k < 0.65:
            return [(f"| {self.words(1, 1)} | {self.words(1, 1)} |", O), ("\n", None), ("|---|---|", O), ("\n", None), (f"| {self.r.randint(1, 9)} g | {self.r.randint(1, 99)} {self.words(1, 1)} |", O)]
        if k < 0.75:
            return [x for i in range(self.r.randint(1, 3)) for x in (("\n" if i else "", None), ("> " + self.sentence(), O))]
        if k < 0.86:
            return [(self.sentence() + " ", None), (f"[{self.words(1, 3)}](https://{self.words(1, 1)}.example/{self.r.randint(1, 99)})", O), (" " + self.sentence(), None)]
        if k < 0.89:
            return [(self.sentence() + " ", None), (f"`{self.words(1, 2)}`", C), (" " + self.sentence(), None)]
        d = self.r.choice(["**", "__", "**", "__", "*", "_"])
        return [(f"{d}{self.words(1, 4).capitalize()}{self.r.choice(['', ':'])}{d}", O), (" " + self.sentence(), None)]

    def wiki(self) -> list[Piece]:
        H, L, C, O = (("wiki", s) for s in ("heading", "list", "code", "other"))
        k = self.r.random()
        if k < 0.25:
            n = self.r.randint(2, 4)
            sp = self.r.choice(["", " "])
            return [(f"{'=' * n}{sp}{self.title()}{sp}{'=' * n}", H)]
        if k < 0.5:
            mark = self.r.choice(["* ", "** ", "* ", "# ", "*"])
            inner = self.r.choice([f"[[{self.words(1, 2).capitalize()}]]", f"'''{self.words(1, 2).capitalize()}'''", f"[[{self.words(1, 2).capitalize()}]]", f"'''{self.words(1, 2).capitalize()}'''", None] if self.r.random() < 0.1 else [f"[[{self.words(1, 2).capitalize()}]]", f"'''{self.words(1, 2).capitalize()}'''"])
            out = [(mark + (self.sentence() if inner is None else ""), L)] + ([(inner, O)] if inner else [])
            for _ in range(self.r.randint(1, 3)):
                out += [("\n", None), (mark + self.sentence(), L)]
            return out
        if k < 0.62:
            return [(f"{{{{{self.words(1, 2).capitalize()}|{self.words(1, 1)}={self.r.randint(1, 99)}|{self.words(1, 1)}={self.words(1, 2)}}}}}", O), ("\n", None), (self.sentence(), None)]
        if k < 0.75:
            return [(f"''{self.sentence()}''", O), (" ", None), ("{{" + self.words(1, 2) + "}}", O)]
        if k < 0.88:
            return [(self.sentence() + " ", None), (f"[[{self.title()}|{self.words(1, 3)}]]", O), (" " + self.sentence(), None)]
        return [(f"'''{self.words(1, 3).title()}'''", O), (" " + self.sentence(), None)]

    def latex(self) -> list[Piece]:
        H, L, C, O = (("latex", s) for s in ("heading", "list", "code", "other"))
        k = self.r.random()
        if k < 0.2:
            name = self.r.choice(["section", "subsection*", "subsection", "chapter", "paragraph"])
            return [(f"\\{name}{{{self.title().replace('&', chr(92) + '&')}}}", H)]
        if k < 0.4:
            env = self.r.choice(["itemize", "enumerate"])
            out = [(f"\\begin{{{env}}}", L)]
            for _ in range(self.r.randint(1, 3)):
                out += [("\n", None), ("\\item", L), (" " + self.sentence(), L)]
            return [*out, ("\n", None), (f"\\end{{{env}}}", L)]
        if k < 0.55:
            env = self.r.choice(["verbatim", "lstlisting"])
            return [(f"\\begin{{{env}}}", C), ("\n", None)] + [x for line in self.code_lines() for x in ((line, C), ("\n", None))] + [(f"\\end{{{env}}}", C)]
        if k < 0.75:
            return [(self.sentence() + " ", None), self.formula()]
        c = self.r.choice(["textbf", "emph", "textit", "underline"])
        out = [(f"\\{c}{{{self.words(1, 3).title()}}}", O), (" " + self.sentence(), None)]
        return out + ([(f" \\emph{{{self.words(1, 2)}}}", O)] if self.r.random() < 0.4 else []) + ([(" 5 ", None), (self.r.choice(["\\%", "\\&", "\\_"]), O), (" " + self.words(1, 3), None)] if self.r.random() < 0.2 else [])

    def document(self) -> tuple[str, list[tuple[int, int]]]:
        """(text, [(end offset of piece, label)])"""
        kind = self.r.choice(["html"] * 5 + ["markdown"] * 4 + ["wiki"] * 4 + ["latex"] * 3 + ["plain"] * 2)
        other = self.r.choice(["html", "markdown", "wiki", "latex"]) if self.r.random() < 0.3 else None
        blocks: list[list[Piece]] = []
        for i in range(self.r.randint(1, 7)):
            use = other if other and self.r.random() < 0.4 else kind
            # A document's first list says little about its notation: the rest has to.
            blocks.append([(self.sentence() + (" " + self.sentence() if self.r.random() < 0.5 else ""), None)] if use == "plain" or self.r.random() < 0.12 else getattr(self, use)())
        if self.r.random() < 0.35:
            blocks.append([(self.alike(), None)])
        if self.r.random() < 0.06:
            blocks.append([(self.sentence() + " ", None), self.formula()])
        gap = self.r.choice(["\n\n", "\n\n", "\n\n", "\n", "\r\n", ""]) if kind == "html" else self.r.choice(["\n\n", "\n\n", "\n\n", "\n\n", "\r\n\r\n"])
        if kind == "html" and self.r.random() < 0.12:
            # Pages nest their content at any depth.
            names = [self.r.choice(["div", "div", "section", "span", "article"]) for _ in range(self.r.randint(1, 12))]
            blocks[0] = [*((self.tag(x), ("html", "other")) for x in names), *blocks[0]]
            blocks[-1] = [*blocks[-1], *((f"</{x}>", ("html", "other")) for x in reversed(names))]
        text, ends = "", []
        for i, block in enumerate(blocks):
            # Marks of line-wise notations stand at line starts.
            joint = "" if not i else ("\n\n" if other else gap)
            if i and self.r.random() < 0.3 and block[0][1] is None and len(block) == 1:
                joint = " "
            for s, label in [(joint, None), *block]:
                if s:
                    text += s
                    ends.append((len(text), m.LABEL[label]))
        return text, ends


def examples(n: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    w, out = Writer(seed), []
    while len(out) < n:
        text, ends = w.document()
        own = m.leaves(text)
        if not own or len(own) > 120:
            continue
        at = np.array([e for e, _ in ends])
        y = np.array([ends[int(np.searchsorted(at, x.start + (len(text[x.start : x.end]) - len(text[x.start : x.end].lstrip())), side="right"))][1] for x in own])
        covered = 0
        for i, x in enumerate(own):
            if x.end <= covered and y[i]:
                y[i] = m.LABEL["latex", "other"]
            covered = max(covered, x.end)
        out.append((m.vectors(text, own), y))
    return out


def _back(kept, x, w, u, dh):
    """Gradients of an LSTM's weights, given those of its hidden states."""
    hidden = u.shape[0]
    du, dz_all = np.zeros_like(u), np.empty((x.shape[0], x.shape[1], 4 * hidden), np.float32)
    next_h, next_c = np.zeros_like(dh[0]), np.zeros_like(dh[0])
    for t in range(x.shape[0] - 1, -1, -1):
        i, f, o, g, before, tc, previous = kept[t]
        d = dh[t] + next_h
        dc = next_c + d * o * (1 - tc * tc)
        dz = dz_all[t]
        dz[:, :hidden] = dc * g * i * (1 - i)
        dz[:, hidden : 2 * hidden] = dc * before * f * (1 - f)
        dz[:, 2 * hidden : 3 * hidden] = d * tc * o * (1 - o)
        dz[:, 3 * hidden :] = dc * i * (1 - g * g)
        du += previous.T @ dz
        next_h, next_c = dz @ u.T, dc * f
    return np.einsum("tbd,tbz->dz", x, dz_all, optimize=True), du, dz_all.sum(axis=(0, 1))


def batches(data, r):
    order = sorted(range(len(data)), key=lambda i: len(data[i][1]) + r.random())
    groups = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    r.shuffle(groups)
    for g in groups:
        lengths = np.array([len(data[i][1]) for i in g])
        x = np.zeros((lengths.max(), len(g), m.DIMS), np.float32)
        y = np.full((lengths.max(), len(g)), -1)
        for k, i in enumerate(g):
            x[: lengths[k], k], y[: lengths[k], k] = data[i]
        yield x, y, lengths


def fit(documents: int = DOCUMENTS, epochs: int = EPOCHS, seed: int = SEED, say=print) -> dict[str, np.ndarray]:
    rng, r = np.random.default_rng(seed), random.Random(seed)
    data, test = examples(documents, seed), examples(HELD_OUT, seed + 1)
    init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    w = {"wf": init(m.DIMS, 4 * HIDDEN), "uf": init(HIDDEN, 4 * HIDDEN), "bf": np.zeros(4 * HIDDEN, np.float32), "wb": init(m.DIMS, 4 * HIDDEN), "ub": init(HIDDEN, 4 * HIDDEN), "bb": np.zeros(4 * HIDDEN, np.float32), "wo": init(2 * HIDDEN, len(m.LABELS)), "bo": np.zeros(len(m.LABELS), np.float32)}
    for b in ("bf", "bb"):
        w[b][HIDDEN : 2 * HIDDEN] = 1
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step = 0
    for epoch in range(epochs):
        rate, losses = 0.004 * 0.8**epoch, []
        for x, y, lengths in batches(data, r):
            back_x = m.turned(x, lengths)
            hf, kf = m.run_lstm(x, w["wf"], w["uf"], w["bf"], keep=True)
            hb, kb = m.run_lstm(back_x, w["wb"], w["ub"], w["bb"], keep=True)
            h = np.concatenate([hf, m.turned(hb, lengths)], axis=2)
            z = h @ w["wo"] + w["bo"]
            z -= z.max(axis=2, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=2, keepdims=True)
            there = y >= 0
            picked = np.take_along_axis(p, np.maximum(y, 0)[..., None], axis=2)[..., 0]
            losses.append(-np.log(np.maximum(picked[there], 1e-9)).mean())
            d = p
            np.put_along_axis(d, np.maximum(y, 0)[..., None], picked[..., None] - 1, axis=2)
            d *= (there / there.sum())[..., None]
            grads = {"wo": np.einsum("tbh,tbl->hl", h, d, optimize=True), "bo": d.sum(axis=(0, 1))}
            dh = d @ w["wo"].T
            grads["wf"], grads["uf"], grads["bf"] = _back(kf, x, w["wf"], w["uf"], dh[..., :HIDDEN])
            grads["wb"], grads["ub"], grads["bb"] = _back(kb, back_x, w["wb"], w["ub"], m.turned(dh[..., HIDDEN:], lengths))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                a, b = moments[k]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w[k] -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        net, right, total = m.Labeller(w), 0, 0
        for x, y, lengths in batches(test, r):
            best = net.scores(x, lengths).argmax(axis=2)
            right, total = right + int((best == y)[y >= 0].sum()), total + int((y >= 0).sum())
        say(f"epoch {epoch + 1}: loss {np.mean(losses):.4f}, held-out accuracy {right / total:.4f}", flush=True)
    return w


if __name__ == "__main__":
    fitted = fit()
    m.MODEL.parent.mkdir(exist_ok=True)
    np.savez_compressed(m.MODEL, **{k: v.astype(np.float16) for k, v in fitted.items()})
    sys.exit(0)
