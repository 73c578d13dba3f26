"""Problem 3: markup residue, and clean text that keeps the structure.

A text is read into a tree of nodes: elements, comments and entities, headings,
list items, emphasis, links, code, tables, templates, commands, formulas - and
the same signs where they may stand for themselves. Boosted trees judge every
node by its kind, its attribute tokens, the density of text in its subtree, its
depth and its siblings. The judgements are decoded together over the tree: a
part (cell, item) is no markup under a container that is none, and nothing
within code or a comment is.
"""

from __future__ import annotations

import html
import random
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.trees import BoostedTrees
from lexmill.session import map_keyed

TRAINING_TEXTS = 5000  # size of the labelled sample, made by ``labelled_texts``
SEED = 20

#: What a text must hold to hold markup, a sign of every kind of node but bare signs; rows without it never leave the JVM.
CANDIDATE = (
    r"(?m)<[A-Za-z/!]|&[#A-Za-z][A-Za-z0-9]*;|^\s*(?:[#*+>|=_~`-]|\d{1,3}[.)] )|^[^\S\n]*(?:={3,}|-{3,})|\]\(|\*|_[^_\s]|~~|`|\[\[|\{\{|\{\||''|\\[A-Za-z\[\]\\(){}%&$#_]"
    r"|\$[^$\n]+\$|\$\$|\[\^|\[/?[a-z]+[\]=]"
)

# Names that occur in the four languages of markup.
HTML_NAMES = set(
    "a abbr address article aside b big blockquote body br button caption center cite code col dd del details div dl dt em figcaption figure font footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark meta nav nowiki ol option p pre q ref s samp script section "
    "select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr".split()
)
LATEX_NAMES = set(
    "alpha author autoref bar begin beta bibitem boldsymbol caption cdot centering chapter cite citep citet date delta documentclass dots emph end ensuremath eqref "
    "footnote frac gamma ge geq hat hline href include includegraphics infty input int item label lambda large ldots le left leq ln log makebox maketitle mathbb "
    "mathbf mathcal mathrm mbox mu multicolumn newcommand newline ne neq noindent omega overline pageref par paragraph partial phi pi pm prod psi quad qquad ref right "
    "rho rightarrow section sigma small sqrt subsection subsubsection sum tau text textbf textit textsc texttt textsuperscript theta times title to url usepackage "
    "vec verb verbatim vspace".split()
)
_PARTS = {"row", "item", "task", "numbered"}
_VERBATIM = {"fence", "code", "comment", "script", "math", "display"}

_TOKEN = regex.compile(
    r"""
  (?P<comment><!--.*?-->|<!DOCTYPE[^<>]*>)
 |(?P<script><(?P<raw>script|style|pre)\b[^<>]*>.*?</(?P=raw)\s*>)
 |(?P<tag></?(?P<name>[A-Za-z][A-Za-z0-9]*)(?P<attrs>(?:\s[^<>]*)?)/?>)
 |(?P<entity>&(?:\#[0-9]{1,7}|\#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});)
 |(?P<fence>(?m:^)[ ]*(?:```|~~~)[^\n]*\n.*?(?:\n[ ]*(?:```|~~~)[ ]*(?=\n|\Z)|\Z))
 |(?P<code>(?P<tick>`+)[^`\n]+(?P=tick))
 |(?P<heading>(?m:^)[ ]{0,3}\#{1,6}[ \t]*[^\s\#][^\n]*)
 |(?P<setext>(?m:^)[^\n]*\S[^\n]*\n(?:={3,}|-{3,})[ ]*(?=\n|\Z))
 |(?P<wiki_heading>(?m:^)(?P<bar>={1,6})[ ]*[^=\n]+?[ ]*(?P=bar)[ ]*(?=\n|\Z))
 |(?P<task>(?m:^)[ ]*[*+-][ ]\[[ xX]\][^\n]*)
 |(?P<item>(?m:^)[ ]*[*+-](?:[ \t]+\S|[^\s*+-])[^\n]*)
 |(?P<numbered>(?m:^)[ ]*\d{1,3}[.)][ ]+[^\n]*)
 |(?P<quote>(?m:^)[ ]*>[ ]*[^\s>][^\n]*)
 |(?P<wiki_table>\{\|.*?\n\|\}|\{\|[^\n]*|(?m:^)\|[-}][^\n]*|(?m:^)\|[^\n|]+\|\|[^\n]*)
 |(?P<row>(?m:^)[ ]*\|[^\n]*\|[ ]*(?=\n|\Z))
 |(?P<rule>(?m:^)[ ]*(?:(?:\*[ ]?){3,}|(?:-[ ]?){3,}|(?:_[ ]?){3,})(?=\n|\Z))
 |(?P<template>\{\{[^{}\n]*\}\})
 |(?P<wiki_link>\[\[[^\[\]\n]+\]\])
 |(?P<image>!\[[^\[\]\n]*\]\([^()\n]*\))
 |(?P<link>\[[^\[\]\n]*\]\([^()\n]*\))
 |(?P<footmark>\[\^[^\[\]\s]+\]:?)
 |(?P<bbcode>\[/?(?:b|i|u|s|url|img|quote|code|color|size|list)(?:=[^\[\]]*)?\])
 |(?P<strong>(?<!\*)\*\*[^*\n]+?\*\*(?!\*))
 |(?P<emphasis>(?<!\*)\*[^*\n]+?\*(?!\*))
 |(?P<magic>__[A-Z]{3,}__)
 |(?P<underline>(?<!_)__?(?=[^\s_])[^_\n]+?(?<=[^\s_])__?(?!_))
 |(?P<strike>~~(?=\S)[^~\n]+?~~(?!~))
 |(?P<signature>~{3,5})
 |(?P<quotes>'{2,5}(?=[^'])[^'\n]+?'{2,5})
 |(?P<display>\\\[.*?\\\]|\\\(.*?\\\)|\$\$[^$]+\$\$)
 |(?P<math>\$[^$\n]+?\$)
 |(?P<command>\\(?P<macro>[A-Za-z]+)\*?(?:\[[^\[\]\n]*\])?(?:\{(?P<arg>[^{}\n]*(?:\{[^{}\n]*\}[^{}\n]*)*)\})*)
 |(?P<linebreak>\\\\(?=\s|\Z|\[))
 |(?P<escape>\\[%&$\#_{}])
 |(?P<sign>[<>&*\#|`~$^_{}\[\]]|\\|--+|->|==+)
""",
    regex.X | regex.S,
)
KINDS = [k for k in _TOKEN.groupindex if k not in ("raw", "name", "attrs", "macro", "arg", "tick", "bar")]


@dataclass
class Node:
    kind: str
    start: int
    end: int
    name: str = ""
    attrs: str = ""
    inner: tuple[int, int] = (0, 0)  # what is within the signs
    close: tuple[int, int] = (0, 0)  # the closing tag of an element
    closed: bool = False
    parent: int = -1
    depth: int = 0
    children: list[int] = field(default_factory=list)


#: Kinds within which other nodes may lie.
_NESTING = {
    "heading", "setext", "wiki_heading", "task", "item", "numbered", "quote", "row", "wiki_table", "command", "strong", "emphasis", "underline", "strike", "quotes", "link",
    "image", "wiki_link", "fence", "code", "comment", "script",
}
_LEAD = {
    kind: regex.compile(lead)
    for kind, lead in {
        "heading": r"\s*#+[ \t]*", "task": r"\s*[*+-] \[[ xX]\][ \t]*", "item": r"\s*[*+-][ \t]*", "numbered": r"\s*\d+[.)][ ]*", "quote": r"\s*>[ ]*", "wiki_heading": r"=+[ ]*",
        "strong": r"\*\*", "emphasis": r"\*", "underline": r"__?", "strike": r"~~", "quotes": r"'{2,5}", "link": r"\[", "image": r"!\[", "wiki_link": r"\[\[(?:[^|\]]*\|)*",
        "row": r"\s*\|", "wiki_table": r"\{?\|", "fence": r"[ ]*(?:```|~~~)[^\n]*", "code": r"`+", "comment": r"<!-*", "script": r"<[^<>]*>",
    }.items()
}
_TRAIL = {
    kind: regex.compile(trail + r"\Z")
    for kind, trail in {
        "setext": r"\n[^\n]*", "wiki_heading": r"[ ]*=+[ ]*", "strong": r"\*\*", "emphasis": r"\*", "underline": r"__?", "strike": r"~~", "quotes": r"'{2,5}", "link": r"\]\([^()]*\)",
        "image": r"\]\([^()]*\)", "wiki_link": r"\]\]", "row": r"\|[ ]*", "fence": r"(?:```|~~~)?[ ]*", "code": r"`+", "comment": r"-*>", "script": r"<[^<>]*>",
    }.items()
}


def _inside(kind: str, m: regex.Match) -> tuple[int, int]:
    """The span within the signs of a node."""
    if kind == "command":
        return m.span("arg") if m["arg"] is not None else (m.end(), m.end())
    lo, hi = m.span()
    if kind in _LEAD and (lead := _LEAD[kind].match(m[0])):
        lo += lead.end()
    if kind in _TRAIL and (trail := _TRAIL[kind].search(m[0])) and trail.start() >= lo - m.start():
        hi -= len(trail[0])
    return lo, max(lo, hi)


def parse(text: str) -> list[Node]:
    """The nodes of a text, parents before their children."""
    nodes: list[Node] = []
    stack: list[int] = []

    def add(node: Node, parent: int) -> int:
        node.parent = parent
        node.depth = nodes[parent].depth + 1 if parent >= 0 else 0
        nodes.append(node)
        if parent >= 0:
            nodes[parent].children.append(len(nodes) - 1)
        return len(nodes) - 1

    def scan(lo: int, hi: int, parent: int, within: str) -> None:
        base = len(stack)
        for m in _TOKEN.finditer(text, lo, hi):
            kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in KINDS if m[k] is not None)
            at = stack[-1] if len(stack) > base else parent
            if kind == "tag":
                name = m["name"].lower()
                if m[0].startswith("</"):
                    for k in range(len(stack) - 1, base - 1, -1):
                        if nodes[stack[k]].name == name:
                            node = nodes[stack[k]]
                            node.closed, node.inner, node.close = True, (node.inner[0], m.start()), m.span()
                            del stack[k:]
                            break
                    else:
                        add(Node("tag", *m.span(), name=name), at)
                    continue
                k = add(Node("tag", *m.span(), name=name, attrs=m["attrs"] or "", inner=(m.end(), m.end())), at)
                if not m[0].endswith("/>") and name not in ("br", "hr", "img", "input", "meta", "link", "wbr"):
                    stack.append(k)
                continue
            node = Node(kind, *m.span(), name=(m["macro"] or "") if kind == "command" else "", attrs=m["arg"] or "" if kind == "command" else "")
            k = add(node, at)
            node.inner, node.closed = _inside(kind, m), True
            if kind in _NESTING and node.inner[0] < node.inner[1]:
                scan(*node.inner, k, kind)
        del stack[base:]

    scan(0, len(text), -1, "")
    return nodes


_NUMBERED = regex.compile(r"\d+[.)](?=\s)")
_ATTRIBUTES = ["class", "id", "href", "src", "style", "alt", "color", "size", "="]
FEATURES = [*KINDS, "known name", *_ATTRIBUTES, "closed", "density", "length", "text", "depth", "in code", "siblings", "same", "at line start", "at line end",
            "digits", "spaced", "spaced within", "digit first", "numbers within", "word before", "word after", "argument", "path", "money", "lines of a kind", "children"]


def features(text: str, nodes: list[Node]) -> np.ndarray:
    out = np.zeros((len(nodes), len(FEATURES)))
    at = {name: k for k, name in enumerate(FEATURES)}
    kinds: dict[str, int] = {}
    coded = [False] * len(nodes)
    for n in nodes:
        kinds[n.kind] = kinds.get(n.kind, 0) + 1
    for k, n in enumerate(nodes):
        s, row = text[n.start : n.end], out[k]
        row[at[n.kind]] = 1
        row[at["known name"]] = (n.kind == "tag" and n.name in HTML_NAMES) or (n.kind == "command" and n.name in LATEX_NAMES) or (
            n.kind == "entity" and html.unescape(s) != s
        )
        for a in _ATTRIBUTES:
            row[at[a]] = a in n.attrs
        inner = text[n.inner[0] : n.inner[1]]
        letters = sum(ch.isalnum() for ch in inner)
        row[at["closed"]] = n.closed
        row[at["density"]] = letters / (1 + len(s) + sum(nodes[c].end - nodes[c].start for c in n.children))
        row[at["length"]] = min(len(s), 200)
        row[at["text"]] = min(letters, 200)
        row[at["depth"]] = n.depth
        coded[k] = n.parent >= 0 and (coded[n.parent] or nodes[n.parent].kind in _VERBATIM)
        row[at["in code"]] = coded[k]
        siblings = nodes[n.parent].children if n.parent >= 0 else [i for i, o in enumerate(nodes) if o.parent < 0]
        row[at["siblings"]] = min(len(siblings), 20)
        row[at["same"]] = min(sum(nodes[i].kind == n.kind for i in siblings), 20)
        before, after = text[n.start - 1 : n.start] or "\n", text[n.end : n.end + 1] or "\n"
        row[at["at line start"]] = before == "\n"
        row[at["at line end"]] = after == "\n"
        row[at["digits"]] = sum(ch.isdigit() for ch in s) / len(s)
        row[at["spaced"]] = (n.inner[0] > n.start and text[n.inner[0] - 1] == " ") or (before == " " and after == " ")
        row[at["spaced within"]] = (inner[:1] + inner[-1:]).count(" ")
        row[at["digit first"]] = inner[:1].isdigit()
        row[at["numbers within"]] = len(_NUMBERED.findall(s)) if n.kind == "numbered" else 0
        row[at["word before"]] = before.isascii() and before.isalnum()
        row[at["word after"]] = after.isascii() and after.isalnum()
        row[at["argument"]] = "{" in s or "[" in s
        row[at["path"]] = bool(regex.search(r"[A-Za-z]:\\|\\\w+\\|\.\w{2,4}(?!\w)", text[max(0, n.start - 12) : n.end + 12]))
        row[at["money"]] = bool(regex.search(r"[$]\s?\d", s)) and not regex.search(r"[\\=^_{}]", s)
        row[at["lines of a kind"]] = kinds[n.kind]
        row[at["children"]] = len(n.children)
    return out


def decode(nodes: list[Node], logit: np.ndarray) -> np.ndarray:
    """The most probable judgement of all nodes that contradicts itself nowhere."""
    yes, no = np.zeros(len(nodes)), np.zeros(len(nodes))
    for k in range(len(nodes) - 1, -1, -1):
        n = nodes[k]
        yes[k] += logit[k]
        if n.parent >= 0:
            best = max(yes[k], no[k])
            yes[n.parent] += no[k] if nodes[n.parent].kind in _VERBATIM else best
            no[n.parent] += no[k] if n.kind in _PARTS and nodes[n.parent].kind != "sign" else best
    out = np.zeros(len(nodes), bool)
    for k, n in enumerate(nodes):
        free = n.parent < 0 or not (
            (out[n.parent] and nodes[n.parent].kind in _VERBATIM) or (not out[n.parent] and n.kind in _PARTS)
        )
        out[k] = free and yes[k] > no[k]
    return out


# The sample's texts, with N for a number, W for a word and S for a sentence.
_MARKED = [
    "<p>S</p>", '<p class="W">S</p>', "<b>W</b>S", "<i>W</i>", "S<br>S", "S<br/>", '<a href="/W/N.html">W</a>S', '<img src="/W/N.png" alt="W">', "<ul>\n<li>W</li>\n<li>W\n<li>W</li>\n</ul>",
    "<h2>W</h2>\n<p>S</p>", "<TABLE><TR><TD>W<TD>N<TR><TD>W<TD>N</TABLE>", '<span style="color:#N">S</span>', "<font size=N>S", "<!-- W N -->S", "<script>var W=N;W(W);</script>S",
    "<pre><code>W -i N.txt</code></pre>S", "S<sup>N</sup>", "</div></td>", "S</div>", '<div class="W"><p>S</p>', "<blockquote>S</blockquote>", "<em>W</em>S", "<nowiki>~~~</nowiki>", "S<ref>W</ref>", "<strong>W</strong>",
    "&nbsp;&nbsp;S", "S&ldquo;W&rdquo;", "S &lt;W&gt; &amp; W", "S&#N;S", "W&hellip;", "W&mdash;W", "S&copy;N", "W&#x4e2d;W", "# W\n\nS", "## W\n\nS", "### W\n\nS", "#### W", "W\n=====\nS", "W\n-----\nS", "- W\n- W\n- W", "* W\n* W",
    "* [ ] W\n* [x] W", "> S\n> S", "> S", "**W**S", "S**W**", "S *W* S", "~~S~~ S", "`W --in N.W`S", "```\nfor W in W: W(W, N)\n```\nS", "```W\nW = N\n```", "[W](/W/N)S", "S[W](http://W.W/N)", "![W](img/N.png)", "| W | W |\n|---|---:|\n| W | N |",
    "S[^N]\n\n[^N]: S", "S\n\n---\n\nS", "* * *\nS", "1. W\n2. W\n3. W", "1. W W\n2. W", "S\n1. W\n2. W W\n3. W\nS", "[[W]]S", "S[[W|W]]", "[[Category:W]]", "[[File:W.png|thumb|W]]", "== W ==\nS", "=== W ===", "__TOC__\n=== W ===\nS", "{{W|id=N|W}}S", '{| class="W"\n|-\n| W || N\n|}',
    "'''W'''S", "''S''S", "S ~~~~", "\\section{W}\nS", "\\textbf{W}S", "S\\footnote{S}", "\\begin{itemize}\n\\item W\n\\item W\n\\end{itemize}", "S~\\cite{W N}", "S\\label{s:N} \\ref{s:N}", "\\emph{W}", "S\\\\ S", "$x_{N} \\le N$ S",
    "S $E_{N}=\\frac{N}{N}mv^2$", "$a^2+b^2=c^2$", "\\[ p(w) = \\sum_{i=1}^{N} c_i \\]\nS", "\\( \\alpha \\)", "$$\\int_0^N x dx$$", "\\chapter{W}", "N\\% S", "S \\& S", "[b]W[/b]S", "[url=/W/N]W[/url]",
]
_SOUND = [
    "S, N < N > N", "N < N", "W > W > W", "N * N * N = N", "N*N=N", "S ($N – $N)", "$N", "S $N", "W W $N.N W $N", "R&D / W & W", "AT&T S", "C# / C++ N [W]", "#N W", "#N", "D:\\W\\N.txt W", "C:\\W\\W", "\\\\W\\W", "2^N – S",
    "-- S --", "S -> W", "W -> W", "[N] S", "[W] S", "N. W N. W N. W", "N) W N) W", "W_N_W = W", "W_W.W", "{W, W} S", "W | W | W S", "W / W / W", "W (W, W): N", "S - W", "W - N", "N-N", "W: W", "α = N°, β = N° : W", "§N S", "S * S", "W* S",
    "~N W", "W~W", "W = W", "N == N", "S == S", "W & W", "W<N", "N>N", "S (*) S", "S [W] [W]", "W #W S", "W@W.W", "http://W.W/W_W", "S 'W' S", "W's W", "S ... W", "<- W", "<3 S", "N%", "W++", "**", "S **", "W__W", "N/N/N", "|W| = N", "!!! S", "S [!] S",
    "W<W", "« W » S", "\"W\"", "W's and W's", "S; S", "W -W", "W --W", "> N", "W>>", "W >>", "N. S", "- S", "+N W", "*W", "S*", "W^N", "`W", "W`", "$W", "W$", "S & S &c;", "W&W", "a < b > c", "W[N]", "W[N][N] = W",
]


def forms(held_out: bool | None = None) -> tuple[list[str], list[str]]:
    """The marked and the sound forms; of each every fifth is held out, and ``held_out`` takes these or the others."""
    return tuple([f for k, f in enumerate(each) if held_out is None or (k % 5 == 3) == held_out] for each in (_MARKED, _SOUND))


def labelled_texts(n: int = TRAINING_TEXTS, seed: int = SEED, held_out: bool | None = None) -> list[tuple[str, list[tuple[int, int]]]]:
    """A sample of ``n`` texts made from the forms, each with the spans in which its markup lies.

    A text is sound, or marked, or holds a sound form beside a marked one: what
    the text as a whole is tells nothing of a node.
    """
    rng = random.Random(seed)
    marked, sound = forms(held_out)
    words = ["词表", "灯笼", "河湾镇", "reading", "Fähre", "étoile", "карта", "りんご", "seg", "id", "bell", "noun", "米粉", "東町"]
    ends = ["。", "！", ".", "。", "?", ""]

    def fill(form: str) -> str:
        def one(m: regex.Match) -> str:
            if m[0] == "N":
                return str(rng.choice([rng.randint(0, 9), rng.randint(10, 99), rng.randint(100, 9999)]))
            if m[0] == "W":
                return rng.choice(words)
            sep = rng.choice(["", " "])
            said = [rng.choice(words) if rng.random() < 0.9 else f"{rng.choice(['', '4.'])}{rng.randint(1, 2000)}" for _ in range(rng.randint(4, 16))]
            return sep.join(said) + rng.choice(ends)

        return regex.sub(r"(?<![A-Za-z])[NWS](?![A-Z])", one, form)

    out = []
    for k in range(n):
        parts = [(fill(rng.choice(marked if k % 2 == 0 else sound)), k % 2 == 0)]
        if rng.random() < 0.25:
            parts.insert(rng.randint(0, 1), (fill(rng.choice(sound)), False))
        if rng.random() < 0.4:
            parts.insert(0, (fill("S"), False))
        if rng.random() < 0.3:
            parts.append((fill("S"), False))
        text, spans = "", []
        for part, is_marked in parts:
            # what begins a line, or goes on over lines, stands on lines of its own
            if text:
                alone = "\n" in part or "\n" in text or regex.match(r"[#*>=|+\-`~\[{_\\\d'W]", part)
                text += "\n" if alone else rng.choice(["", " "])
            if is_marked:
                spans.append((len(text), len(text) + len(part)))
            text += part
        out.append((text, spans))
    return out


def _labels(nodes: list[Node], spans: list[tuple[int, int]]) -> list[float]:
    """1 for what lies where markup was put, but for bare signs and for what is within code, a comment or a formula."""
    coded = [False] * len(nodes)
    for k, n in enumerate(nodes):
        coded[k] = n.parent >= 0 and (coded[n.parent] or nodes[n.parent].kind in _VERBATIM)
    return [float(not c and n.kind != "sign" and any(a <= n.start and n.end <= e for a, e in spans)) for n, c in zip(nodes, coded)]


def fitted(held_out: bool | None = None) -> BoostedTrees:
    """Trees fitted to the nodes of the labelled sample: a node is markup if it lies where markup was put."""
    xs, ys = [], []
    for text, spans in labelled_texts(held_out=held_out):
        nodes = parse(text)
        if nodes:
            xs.append(features(text, nodes))
            ys += _labels(nodes, spans)
    return BoostedTrees().fit(np.concatenate(xs), np.array(ys))


_MODEL: list[BoostedTrees] = []


def model() -> BoostedTrees:
    """The trees of all forms, fitted once on the driver."""
    if not _MODEL:
        _MODEL.append(fitted())
    return _MODEL[0]


def judge(texts: list[str], trees: BoostedTrees) -> list[tuple[list[Node], np.ndarray]]:
    """The nodes of each text, and which of them are markup."""
    parsed = [parse(t) for t in texts]
    rows = [features(t, n) for t, n in zip(texts, parsed) if n]
    if not rows:
        return [(n, np.zeros(0, bool)) for n in parsed]
    logit, out, done = trees.logit(np.concatenate(rows)), [], 0
    for nodes in parsed:
        out.append((nodes, decode(nodes, logit[done : done + len(nodes)])))
        done += len(nodes)
    return out


class _Cleaner:
    """One text's clean form, made from the innermost node outwards."""

    def __init__(self, text: str, nodes: list[Node], is_markup: np.ndarray):
        self.text = text
        found = [(n.start, n.end, n, False) for n, yes in zip(nodes, is_markup) if yes]
        found += [(*n.close, n, True) for n, yes in zip(nodes, is_markup) if yes and n.close != (0, 0)]
        self.tokens = sorted(found, key=lambda x: (x[0], -x[1]))
        self.starts = [t[0] for t in self.tokens]

    def span(self, lo: int, hi: int) -> str:
        """The text from ``lo`` to ``hi`` without its markup."""
        out, done = [], lo
        for k in range(bisect_left(self.starts, lo), len(self.tokens)):
            start, end, node, closing = self.tokens[k]
            if start >= hi:
                break
            if start >= done and end <= hi:
                out += [self.text[done:start], ("\n" if node.name in _BREAKING else "") if closing else self.node(node)]
                done = end
        return "".join(out) + self.text[done:hi]

    def cells(self, lo: int, hi: int, bar: str) -> str:
        """The cells between bars, without markup, parted by tabs."""
        cuts = [m.span() for m in regex.finditer(bar, self.text, pos=lo, endpos=hi) if not any(a < m.start() < e for a, e, n, _ in self.tokens if lo <= a and n.kind not in ("row", "wiki_table"))]
        bounds = [lo, *(x for cut in cuts for x in cut), hi]
        return "\t".join(self.span(a, e).strip() for a, e in zip(bounds[::2], bounds[1::2]))

    def table(self, n: Node) -> str:
        """The rows of a wiki table, each on a line."""
        rows: list[list[str]] = [[]]
        at = n.start
        for line in self.text[n.start : n.end].split("\n"):
            if line.startswith("|-") or line.startswith("|+"):
                rows.append([])
            elif line[:1] in "|!" and not line.startswith("|}"):
                rows[-1].append(self.cells(at + 1, at + len(line), r"\|\||!!"))
            at += len(line) + 1
        return "\n".join("\t".join(r) for r in rows if r)

    def node(self, n: Node) -> str:
        s, inner = self.text[n.start : n.end], lambda: self.span(*n.inner)
        match n.kind:
            case "comment" | "magic" | "signature" | "rule" | "footmark" | "template" | "bbcode":
                return ""
            case "script":
                body = html.unescape(regex.sub(r"<[^<>]*>", "", s))
                return f"\n```\n{body}\n```\n" if s[1:4].lower() == "pre" else ""
            case "tag":
                if n.name == "li":
                    return "\n- "
                if regex.fullmatch(r"h[1-6]", n.name):
                    return "\n" + "#" * int(n.name[1]) + " " if n.inner != (0, 0) else "\n"
                return "\n" if n.name in _BREAKING or n.name == "br" else "\t" if n.name in ("td", "th") else ""
            case "entity":
                return html.unescape(s).replace("\xa0", " ")
            case "heading" | "wiki_heading":
                return "#" * len(regex.search("[#=]+", s)[0]) + " " + inner().strip()
            case "setext":
                return "# " + inner().strip()
            case "task" | "item":
                return "- " + inner()
            case "numbered":
                return s[: n.inner[0] - n.start].lstrip() + inner()
            case "wiki_link":
                return inner() if ":" not in s[2:-2].split("|")[0] else ""
            case "quote" | "strong" | "emphasis" | "strike" | "quotes" | "underline" | "image" | "link":
                return inner()
            case "row":
                return "" if regex.fullmatch(r"[\s|:-]+", s) else self.cells(*n.inner, r"\|")
            case "wiki_table":
                return self.table(n)
            case "linebreak":
                return "\n"
            case "escape":
                return s[1:]
            case "display":
                return "$" + s.strip("$").removeprefix("\\[").removeprefix("\\(").removesuffix("\\]").removesuffix("\\)").strip() + "$"
            case "command":
                if n.name in ("section", "chapter", "subsection", "subsubsection", "title"):
                    return f"# {inner()}"
                if n.name == "item":
                    return "- "
                return inner() if n.name.startswith(("text", "emph", "mbox")) else f" ({inner()})" if n.name == "footnote" else ""
        return s


_BREAKING = {"p", "div", "tr", "table", "ul", "ol", "blockquote"}
_TABULAR = regex.compile(r"\\begin\{(?:tabular|array|longtable)\*?\}(?:\{[^{}]*\})?(.*?)\\end\{(?:tabular|array|longtable)\*?\}", regex.S)


def cleaned(text: str, nodes: list[Node], is_markup: np.ndarray) -> str:
    """The text without its markup; headings, lists, code and formulas in one plain notation.

    Nodes within nodes are cleaned too, but for those in code and formulas; cells
    are parted by tabs and rows by line ends. Closing tags without a start were
    read as nodes of their own.
    """
    if any(yes and n.kind == "command" and n.name == "begin" for n, yes in zip(nodes, is_markup)) and _TABULAR.search(text):
        # of a table's body the column signs are no letters; what they part is judged as it stands
        text = _TABULAR.sub(lambda m: regex.sub(r"(?<!\\)\s*&\s*", "\t", m[1]).replace("\\hline", ""), text)
        nodes = parse(text)
        is_markup = np.array([n.kind != "sign" for n in nodes], bool)
    rest = _Cleaner(text, nodes, is_markup).span(0, len(text))
    return regex.sub(r"\n{3,}", "\n\n", rest).strip("\n ")


def _run(trees: BoostedTrees, wanted: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            judged = judge(pdf["text"].tolist(), trees)
            marked = [bool(yes.any()) for _, yes in judged]
            clean = [cleaned(t, n, y) if wanted and y.any() else t for t, (n, y) in zip(pdf["text"], judged)]
            yield pd.DataFrame({"row_id": pdf["row_id"], "marked": marked, "clean": clean})

    return run


def strip_markup(rows: DataFrame, clean: bool = True) -> DataFrame:
    """``(row_id, marked, clean)`` of rows ``(row_id, text)``.

    A null text is not marked and stays null, an empty one is clean; repeated
    rows are kept. Without ``clean`` the text is passed on as it stands.
    """
    odd = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    rows = rows.select("row_id", "text")
    done = map_keyed(rows.where(odd), _run(model(), clean), "row_id long, marked boolean, clean string", "row_id")
    return done.unionAll(rows.where(~odd).select("row_id", F.lit(False).alias("marked"), F.col("text").alias("clean")))


def marked_rows(rows: DataFrame) -> DataFrame:
    """``row_id`` of every row whose text holds markup."""
    odd = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    done = map_keyed(rows.select("row_id", "text").where(odd), _run(model(), False), "row_id long, marked boolean, clean string", "row_id")
    return done.where("marked").select("row_id")
