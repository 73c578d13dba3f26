"""Problem 4: the main lines of a page, by composite text density.

A page is read into a tree: the body, the block elements that its lines open and
close, runs of list items, rows and the like, and the lines themselves as leaves,
with the tags and links within them. The composite density of a node is

    chars / tags * log(chars / link_chars * tags / link_tags, base)
    base = ln(chars * link_chars / other_chars + body_link_chars / body_chars * chars + e)

(what is 0 counts as 1). The densities of a node's children are summed. The main
text is the run of the body's children with the largest sum over the threshold that
the body's own density sets; in it, a leaf or a run of items below the threshold is
none.

Text that once was a link has often lost its tag. What is a link is therefore
also learned from the collection: how many of the lines of one form (the same
beginning, the same ending, words of menus) are no sentences, for forms of which a
fixed share of all pages has a line. That share of the line's characters counts as
link characters; nothing else follows from a form.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import map_keyed, write_table

FORM_SHARE = 0.0015
LABEL_SHARE = 0.006
SINGLE_SHARE = 0.004
MENU_SHARE = 0.005
SURE = 1.0  # standard deviations by which a share must be exceeded
SENTENCE_RATE = 0.1
BODY_SHARE = 0.1  # of the body's density, as the threshold for its subtrees

_END = r"""[。．！？.!?…।]["”’」』）)\]»]*(?:\[\^?\d+\])*\s*\z|\s[—–-]+\s*\z"""
_TAG = r"<[^<>]*>"
_LINK = r"(?i)<a\b[^<>]*>[^<>]*</a>"
_SEPARATOR = r"[\s|/·>•,，、]+"
# Lines of an article that are no sentences.
_BODY = (
    r"^\s*(?:[*#=|\\{}`_&$~-]|\[\[|\[\^?\d|!\[|<(?!ul class=|a |/?div class=.nav)[a-zA-Z!/]"
    r"|(?:图|表|圖|図|Abb\.?|Fig\.?|Figure|Table|Tab\.?|Рис\.?)\s*\d|第\s*\d+\s*[章节節回部話篇]|(?:注|註|附注|Note|Anm\.)\s*[:：]"
    r"|(?:Section|Chapter|Part|Teil|Kapitel|Abschnitt|Chapitre|Глава)\s*\d|(?:for|if|def|import|print|return|while)\b.*[(:])"
)
_WITHIN = r"[。！？।\\$<>{}]"  # signs of running text or of markup, of which an ending tells nothing
_LOST = r"[\x{FFFD}\x{80}-\x{84}\x{86}-\x{9F}]"
# Elements that hold lines.
_BLOCKS = "article aside blockquote body div dl figure footer form header main nav ol pre section table tbody td tr ul"

def _forms(bare: Column) -> tuple[Column, Column, Column]:
    """Whether a line begins with a label, its beginning and its ending."""
    label = F.regexp_extract(bare, r"^([^：:\s]{1,12}[：:])", 1)
    first = F.substring_index(bare, " ", 1)
    head = (
        F.when(label != "", label)
        .when(bare.rlike(r"^\p{IsLatin}"), F.substring_index(bare, " ", 2))
        .when(F.contains(bare, F.lit(" ")) & (F.length(first) <= 8), first)
        .otherwise(F.substring(bare, 1, 4))
    )
    return label != "", head, F.right(bare, F.lit(6))


def line_table(rows: DataFrame) -> DataFrame:
    """One row per line with the features of the leaf, written once.

    Text is kept of lines that are no sentences only; of the forms of all others
    the hashes are enough.
    """
    page = F.coalesce(F.concat(F.lit("p"), F.col("page_id").cast("string")), F.concat(F.lit("r"), F.col("row_id").cast("string")))
    lines = rows.select("row_id", page.alias("page"), "line_no", "again", F.posexplode(F.split("text", "\n")).alias("k", "raw"))
    tagged = F.contains("raw", F.lit("<"))
    plain = F.trim(F.regexp_replace(F.when(tagged, F.regexp_replace("raw", _TAG, " ")).otherwise(F.col("raw")), r"[\s\x{A0}]+", " "))
    lines = lines.withColumns({"plain": plain, "structural": F.col("raw").rlike(_BODY)})
    bare = F.regexp_replace(F.regexp_replace("plain", r"\d+", "0"), r"[。．！？.!?…।\"”’」』）)\]»\s]+\z", "")
    lines = lines.withColumn("bare", bare)
    textual = F.col("structural") | F.col("plain").rlike(_END) | (F.length("bare") > 400) | (F.col("bare") == "")
    lines = lines.withColumn("textual", textual)
    labelled, head, tail = _forms(F.col("bare"))
    linked = F.length("plain") - F.length(F.trim(F.regexp_replace(F.regexp_replace("raw", _LINK, ""), _TAG, "")))
    elements = F.array_join(F.regexp_extract_all("raw", F.lit(rf"(?i)</?(?:{_BLOCKS.replace(' ', '|')})\b"), 0), " ")
    featured = lines.select(
        *["row_id", "page", "line_no", "k", "again", "textual", "structural"],
        F.col("plain").rlike(_LOST).alias("lost"),
        F.when(~F.col("textual"), labelled).alias("labelled"),
        F.when(~F.col("textual"), F.col("plain").rlike(_WITHIN)).alias("running"),
        F.when(~F.col("textual"), F.col("bare")).alias("bare"),
        F.xxhash64(head).alias("head"),
        F.xxhash64(tail).alias("tail"),
        F.length("plain").alias("chars"),
        F.when(tagged, F.greatest(linked, F.lit(0))).otherwise(0).alias("linked"),
        F.when(tagged, F.regexp_count("raw", F.lit(_LINK))).otherwise(0).alias("links"),
        F.when(tagged, F.lit(1) + F.regexp_count("raw", F.lit(_TAG))).otherwise(1).alias("tags"),
        F.when(tagged, elements).otherwise("").alias("elements"),
    )
    return write_table(featured)


class Forms:
    """Of each frequent form, the share of link text in its lines."""

    def __init__(self, pages: int, head: dict[int, tuple[float, float]], tail: dict[int, tuple[float, float]], menu: set[str]):
        self.pages, self.head, self.tail, self.menu = pages, head, tail, menu
        self.separator = re.compile(_SEPARATOR)

    def link_share(self, bare: str, head: int, tail: int, labelled: bool, running: bool) -> tuple[float, int]:
        """Share of link text in a line that is no sentence, and the number of its words."""
        words = [w for w in self.separator.split(bare) if w]
        single = len(words) == 1
        n, share = self.head.get(head, (0.0, 0.0))
        out = share if n >= (LABEL_SHARE if labelled else SINGLE_SHARE if single else FORM_SHARE) else 0.0
        if not (single or labelled or running) and len(bare) > 8:
            out = max(out, self.tail.get(tail, (0.0, 0.0))[1])
        if single or len(words) >= 3:
            out = max(out, sum(w in self.menu for w in words) / len(words))
        return out, len(words)


def learn_forms(lines: DataFrame) -> Forms:
    """The forms of which a fixed share of the pages has a line, none of them known by less than ``SURE`` deviations.

    The shares are relative, so however large the collection there are no more
    forms than lines of a page over the least share.
    """
    pages = max(1, lines.agg(F.approx_count_distinct("page", 0.01)).first()[0])
    least = F.col("n") - SURE * F.sqrt("n")
    each = F.explode(F.array(F.struct(F.lit("head").alias("kind"), F.col("head").alias("form")), F.struct(F.lit("tail").alias("kind"), F.col("tail").alias("form"))))
    forms = (
        lines.select("textual", each.alias("f"))
        .groupBy("f.kind", "f.form")
        .agg(F.count("*").alias("n"), F.count_if("textual").alias("t"))
        .where((least >= FORM_SHARE * pages) & (F.col("t") <= SENTENCE_RATE * F.col("n")))
        .select("kind", "form", (least / pages).alias("known"), (1 - F.col("t") / F.col("n")).alias("share"))
        .collect()
    )
    words = F.filter(F.split("bare", _SEPARATOR), lambda w: w != "")
    menu = (
        lines.where(~F.col("textual") & (F.size(words) >= 4))
        .select(F.explode(words).alias("w"))
        .groupBy("w")
        .agg(F.count("*").alias("n"))
        .where(least >= MENU_SHARE * pages)
        .collect()
    )
    head, tail = ({r["form"]: (r["known"], r["share"]) for r in forms if r["kind"] == kind} for kind in ("head", "tail"))
    return Forms(pages, head, tail, {r["w"] for r in menu})


def density(chars: float, link_chars: float, tags: float, link_tags: float, body: float) -> float:
    """Composite text density of a node; ``body`` is the body's share of link characters."""
    if chars <= 0:
        return 0.0
    link, tags = max(link_chars, 1.0), max(tags, 1.0)
    other = max(chars - link_chars, 1.0)
    base = math.log(math.log(chars * link_chars / other + body * chars + math.e))
    odds = math.log(max(chars / link * tags / max(link_tags, 1.0), 1.0))
    # a base of e and less would turn the scale round
    return chars / tags * odds / max(base, 0.1)


def page_tree(structural: list[bool], elements: list[str]) -> list[int]:
    """The body's child to which each line belongs, by number.

    A line that opens a block element, those within it and the one that closes it
    are one child; so is a run of items, rows or other structural lines.
    """
    out, open_names, child, before = [], [], -1, False
    for is_structural, names in zip(structural, elements):
        if not open_names and not (before and is_structural):
            child += 1
        out.append(child)
        for name in names.split():
            if name[1] != "/":
                open_names.append(name[1:].lower())
            elif name[2:].lower() in open_names:
                while open_names.pop() != name[2:].lower():
                    pass
        before = is_structural
    # what is never closed holds nothing but its own line
    return out if not open_names else [*np.cumsum([0, *(not (a and b) for a, b in zip(structural, structural[1:]))])]


def main_lines(chars: list, link: list, tags: list, link_tags: list, structural: list, lost: list, elements: list) -> list[bool]:
    """Which lines of one page, in order, are its main text."""
    body_chars, body_link = float(sum(chars)), float(sum(link))
    share = body_link / max(body_chars, 1.0)
    theta = BODY_SHARE * density(body_chars, body_link, float(sum(tags)), float(sum(link_tags)), share)
    leaf = [0.0 if x else density(c, lc, t, lt, share) for c, lc, t, lt, x in zip(chars, link, tags, link_tags, lost)]
    child = page_tree(structural, elements) if any(structural) or any(elements) else list(range(len(chars)))
    sums = np.bincount(child, leaf)
    # the run of children with the largest sum over the threshold
    best, first, last, total, start = 0.0, 0, -1, 0.0, 0
    for k, s in enumerate(sums):
        total += s - theta
        if total > best:
            best, first, last = total, start, k
        if total < 0:
            total, start = 0.0, k + 1
    return [
        first <= c <= last and (d >= theta or lost_here or n == 0 or (s and sums[c] >= theta))
        for c, d, lost_here, n, s in zip(child, leaf, lost, chars, structural)
    ]


def _judge(forms: Forms):
    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole pages: a batch's last one waits for the next batch."""
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(pdf):
                continue
            cut = int(np.flatnonzero((pdf["page"] == pdf["page"].iloc[-1]).to_numpy())[0])
            rest = pdf.iloc[cut:]
            if cut:
                yield pdf.iloc[:cut]
        if rest is not None and len(rest):
            yield rest

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pages(batches):
            again = pdf["again"].to_numpy() == 1
            if again.any():  # a row that was restored stands in place of the stored one
                pdf = pdf[again | ~pdf["row_id"].isin(set(pdf["row_id"][again]))]
            chars, tags = pdf["chars"].tolist(), pdf["tags"].tolist()
            link, link_tags = [float(x) for x in pdf["linked"]], [float(x) for x in pdf["links"]]
            for i, (bare, head, tail, labelled, running) in enumerate(zip(pdf["bare"], pdf["head"], pdf["tail"], pdf["labelled"], pdf["running"])):
                if bare is not None:
                    share, words = forms.link_share(bare, head, tail, labelled, running)
                    if share:
                        link[i] = max(link[i], share * chars[i])
                        link_tags[i] += share * words
                        tags[i] = max(tags[i], link_tags[i])  # the line of a link is the link
            page, structural, lost, elements = pdf["page"].to_numpy(), pdf["structural"].tolist(), pdf["lost"].tolist(), pdf["elements"].tolist()
            cuts = [0, *(np.flatnonzero(page[1:] != page[:-1]) + 1).tolist(), len(page)]
            main: list[bool] = []
            for a, e in zip(cuts, cuts[1:]):
                main += main_lines(chars[a:e], link[a:e], tags[a:e], link_tags[a:e], structural[a:e], lost[a:e], elements[a:e])
            yield pd.DataFrame({"row_id": pdf["row_id"], "seg_no": pdf["k"] + 1, "page": page, "line_no": pdf["line_no"], "main": main})

    return run


def frame_lines(rows: DataFrame, restored: DataFrame | None = None) -> DataFrame:
    """``(row_id, seg_no, page_id, line_no, main)`` of every line of the pages.

    ``rows`` has ``row_id, page_id, line_no, text``, one row per stored piece of
    a page; so has ``restored``, whose rows stand in place of those with the same
    ``row_id`` and meet them where the lines of a page come together. A page is the unit, however many rows a file or a site has. Null
    texts have no line; rows stored again are lines again; a row with a null page
    is a page of its own; empty lines are main if they lie in the main text.
    """
    columns = ["row_id", "page_id", "line_no", "text"]
    every = rows.select(*columns, F.lit(0).alias("again"))
    if restored is not None:
        every = every.unionByName(restored.select(*columns, F.lit(1).alias("again")))
    lines = line_table(every.where(F.col("text").isNotNull()))
    forms = learn_forms(lines)
    # whole pages to a task, in order; a page of any length is read as it comes
    ordered = lines.repartition("page").sortWithinPartitions("page", "line_no", "k", "row_id", "again")
    schema = "row_id long, seg_no long, page string, line_no int, main boolean"
    judged = map_keyed(ordered, _judge(forms), schema, "row_id")
    kinds = dict(rows.dtypes)
    page_id = F.when(F.startswith("page", F.lit("p")), F.substring("page", 2, 40)).cast(kinds["page_id"])
    return judged.select("row_id", "seg_no", page_id.alias("page_id"), F.col("line_no").cast(kinds["line_no"]).alias("line_no"), "main")
