"""Problem 9: texts cut off by field limits or in transfer.

Evidence, all of it drawn from the whole collection:

* a vocabulary trie: the final token of a text is an unknown proper prefix of
  known words. Tokens are of two kinds: the word at the end (letters up to the last
  space, mark or slash), and, since scripts without spaces do not show where words
  begin, the longest ending of 1 to 12 characters that occurs elsewhere. The trie
  tells of each how often it goes on in the collection and how often a mark, a line
  end or the end of another text closes it;
* length: where a source's texts with open ends pile up at one length (in
  characters or in bytes), there is a limit, and a text at the limit was cut;
* an end torn within a tag, an entity or a character;
* no end mark, in running text whose ending the trie does not know as a whole.

A whole text may also end in a list item, a note, a signature, a date or the like.
Lines of such a form (list signs, brackets, tabs, or a beginning whose lines end
without a mark throughout the collection) need no end mark; of them only the word
at their end is looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.session import write_table

NEAR = 50  # neighbouring lengths on either side
SURPRISE = 13.8  # of a pile of texts: about one chance in a million
CLOSED = 0.05  # of the cuts at a limit, those that fall on an end mark by chance
KNOWN = 2  # occurrences elsewhere that make a token known
ENDINGS = (1, 2, 4, 6, 8, 12)  # characters of the endings that the trie holds
WORD = 0  # the trie's level of words
GOES_ON = 0.05  # a token closed more rarely than that is a prefix
WHOLE = 0.8  # one closed more often than that is whole
CHUNK = 1 << 19  # characters that a task works on at once
BITS = 1 << 26  # of the filter that keeps nodes which no text's end asks for from being counted

# End marks, what may close after them, and forms of last lines.
_END = r"[。．.!?！？…।؟‥]+[\"'”’»«」』）)\]》]*\s*\z"
_MARK = r"\s*(?:\[(?:…+|\.{3,})\]|[…‥]+|\.{3,})\s*\z"  # what may be put in the place of a lost end
_OMITTED = r"\[(?:…+|\.{3,})\]\s*\z"
_TORN = r"(?:\x{FFFD}+|<[/!]?[A-Za-z]*|&#?[A-Za-z0-9]*|\\[A-Za-z]*)\s*\z"
_TRAILER = r"^\s*(?:[·•‣▪*+-] ?[^。，！？,!?]{1,40}|[^\t]{1,40}(?:\t[^\t]*)+|[—–-]{2}.{1,40}|\[\d+\].{0,60}|[（(][^（）()]{1,30}[）)]|[^\p{L}\p{N}]+)\s*\z"
_LABEL = r"^\s*([^：:\s]{1,12}[：:])"
_PARTING = "/ \t-—–·•：:"
_CLOSING = "。．!?！？…।؟\n"
# Scripts without spaces between words.
_UNSPACED = (
    r"\x{0E01}-\x{0E3A}\x{0E40}-\x{0E4E}\x{0E81}-\x{0ECD}\x{0EDC}-\x{0EDF}\x{1000}-\x{103F}\x{1050}-\x{109D}\x{1780}-\x{17D3}"
    r"\x{3005}-\x{3007}\x{3021}-\x{3029}\x{3031}-\x{3035}\x{3038}-\x{303B}\x{3041}-\x{3096}\x{309D}-\x{309F}\x{30A1}-\x{30FA}"
    r"\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}"
)
_WORD_END = rf"(?:[\p{{L}}\p{{M}}&&[^{_UNSPACED}]]|/[{_UNSPACED}]+)[^\p{{L}}\p{{M}}]*\z"
_SHORT = 80  # characters in which the end of a text is looked for

_BREAK = 0x10FFFE  # stands between texts
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _pattern(java: str) -> regex.Pattern:
    """The pattern with Java's ``\\x{...}`` and ``\\z`` as ``regex`` spells them."""
    return regex.compile(regex.sub(r"\\x\{(\w+)\}", lambda m: regex.escape(chr(int(m[1], 16))), java).replace(r"\z", r"\Z"))


class Ends:
    """Where a text's last token ends, and what stands after it."""

    def __init__(self):
        self.mark, self.torn, self.end = _pattern(_MARK), _pattern(_TORN), _pattern(_END)
        self.word = _pattern(rf"(?:(?![{_UNSPACED}])[\p{{L}}\p{{M}}]|/[{_UNSPACED}]+)\z")

    def of(self, text: str) -> tuple[int, bool, bool]:
        """Length without what follows the last token; whether an end mark follows; whether the end is judged as a word."""
        tail = text[-_SHORT:]
        before, stop = len(text) - len(tail), len(tail)
        if m := self.torn.search(tail):
            stop = m.start()
        elif m := self.mark.search(tail):
            stop = m.start()
        elif m := self.end.search(tail):
            stop = m.start()
            return before + stop, True, bool(self.word.search(tail[:stop]))
        else:
            stop = len(tail.rstrip())
        return before + stop, False, True


class Trie:
    """Hashed nodes of every position of many texts."""

    def __init__(self):
        self.letter, self.unspaced = self._of(r"[\p{L}\p{M}]+"), self._of(f"[{_UNSPACED}]+")
        self.parting = np.zeros(0x30000, bool)
        self.parting[[ord(c) for c in _PARTING]] = True
        self.power = self.back = np.zeros(0, np.uint64)
        self.closing = np.array([ord(c) for c in _CLOSING], np.int64)

    @staticmethod
    def _of(runs: str) -> np.ndarray:
        """Which code points the pattern matches."""
        out = np.zeros(0x30000, bool)
        for m in _pattern(runs).finditer("".join(map(chr, range(0x30000)))):
            out[m.start() : m.end()] = True
        return out

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the texts (a run of digits is one letter), each after a break; the place of each last character."""
        cp = np.frombuffer("".join(f"{chr(_BREAK)}\n{t}" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        cp = np.where((cp >= 48) & (cp <= 57), 48, cp)
        cp = cp[~((cp == 48) & (np.concatenate([[0], cp[:-1]]) == 48))]
        starts = np.flatnonzero(cp == _BREAK)
        return cp, np.concatenate([starts[1:], [len(cp)]]) - 1

    def nodes(self, cp: np.ndarray, at: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Per level the node of each place (or of the places ``at``), 0 where the level has none."""
        n = len(cp)
        with np.errstate(over="ignore"):
            if len(self.power) <= n:
                self.power, self.back = (np.multiply.accumulate(np.full(n + 1, f)) for f in (_FACTOR, _INVERSE))
            power, back = self.power, self.back
            sums = np.concatenate([[np.uint64(0)], np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64)])
            here = np.arange(n) if at is None else at
            for level in (WORD, *ENDINGS):
                if level == WORD:
                    known = (cp < len(self.letter)) & self.letter[np.minimum(cp, len(self.letter) - 1)]
                    first = np.maximum.accumulate(np.where(~known, np.arange(n) + 1, 0))
                    # in a script without spaces only slashes, a label or a list sign show a word
                    after = np.minimum.accumulate(np.where(~known, np.arange(n), n - 1)[::-1])[::-1]
                    shown = (cp[after] == ord("/")) | self.parting[np.minimum(cp[np.maximum(first - 1, 0)], 0x2FFFF)] | ~self.unspaced[np.minimum(cp[np.minimum(first, n - 1)], 0x2FFFF)]
                    first = np.where(shown, first, n)[here]
                else:
                    first = here + 1 - level
                start = np.clip(first, 0, n)
                h = (sums[here + 1] - sums[start]) * back[start]
                h = (h ^ (h >> np.uint64(31)) ^ np.uint64(level * 0x51ED27)) * np.uint64(0xBF58476D1CE4E5B9)
                h = (h ^ (h >> np.uint64(29))) | np.uint64(1)
                h[(first > here) | (first < 0)] = 0
                yield level, h.view(np.int64)

    def goes_on(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a place's word goes on, and whether its text goes on without a closing mark."""
        after = np.concatenate([cp[1:], [10]])
        then = np.concatenate([cp[2:], [10, 10]])
        word = (after < len(self.letter)) & self.letter[np.minimum(after, len(self.letter) - 1)]
        closed = np.isin(after, self.closing) | (after == _BREAK) | ((after == ord(".")) & np.isin(then, [32, 10, _BREAK]))
        return word, ~closed


def _of_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ends, trie = Ends(), Trie()
    for pdf in batches:
        if not len(pdf):
            continue
        found = [ends.of(t) for t in pdf["tail"]]
        kept = [k for k, (stop, _, judged) in enumerate(found) if judged and stop]
        if not kept:
            continue
        cp, last = trie.read([pdf["tail"].iloc[k][: found[k][0]].lower() for k in kept])
        ended, of = np.array([found[k][1] for k in kept]), pdf["tail_id"].to_numpy(np.int64)[kept]
        for level, h in trie.nodes(cp, last):
            use = (h != 0) & (~ended if level != WORD else True)
            yield pd.DataFrame({"tail_id": of[use], "level": np.full(int(use.sum()), level, np.int32), "node": h[use]})


def bit_of(node: np.ndarray) -> np.ndarray:
    return (node.view(np.uint64) >> np.uint64(20)).astype(np.int64) & (BITS - 1)


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[list[str]]:
    """The texts of the batches, in lists of about ``CHUNK`` characters; a longer text is a list of its own."""
    held, size = [], 0
    for pdf in batches:
        for text in pdf["text"]:
            held.append(text)
            size += len(text)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _of_texts(bitmap: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends, trie = Ends(), Trie()
        held: list[np.ndarray] = []  # rows of node, times it goes on, times it is closed

        def merged() -> np.ndarray:
            rows = np.concatenate(held)
            u, at = np.unique(rows[:, 0], return_inverse=True)
            # counts stay far below 2^53, so that the sums of bincount are exact
            return np.stack([u, np.bincount(at, rows[:, 1]).astype(np.int64), np.bincount(at, rows[:, 2]).astype(np.int64)], 1)

        for texts in chunks(batches):
            found = [ends.of(t) for t in texts]
            cp, last = trie.read([t[:stop].lower() for t, (stop, _, _) in zip(texts, found)])
            word_on, text_on = trie.goes_on(cp)
            open_end, judged = np.array([not e for _, e, _ in found]), np.array([j for _, _, j in found])
            for level, h in trie.nodes(cp):
                h[last[judged if level == WORD else open_end]] = 0  # ends that are judged are counted by themselves
                bit = bit_of(h)
                use = np.flatnonzero((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool) & (h != 0))
                if len(use):
                    on = (word_on if level == WORD else text_on)[use]
                    u, at = np.unique(h[use], return_inverse=True)
                    n, n_on = np.bincount(at), np.bincount(at, on).astype(np.int64)
                    held.append(np.stack([u, n_on, n - n_on], 1))
            if held and sum(map(len, held)) > 1_000_000 + 2 * len(held[0]):
                held = [merged()]
        if held:
            rows = merged()
            for k in range(0, len(rows), 100_000):
                yield pd.DataFrame(rows[k : k + 100_000], columns=["node", "n_on", "n_closed"])

    return run


def _filter(nodes: DataFrame) -> np.ndarray:
    """The bits of all nodes: ``BITS`` of them however many nodes there are, made on the executors in pieces of 4 kB."""
    bit = F.shiftright("node", 20).bitwiseAND(F.lit(BITS - 1))
    pieces = nodes.groupBy(F.shiftright(bit, 15).alias("b")).agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit(0x7FFF))).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in pieces.collect():
        out[r["b"] << 12 : (r["b"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def vocabulary_trie(texts: DataFrame, ends: DataFrame) -> DataFrame:
    """``(node, n_on, n_closed)``: how often each node that ``ends`` asks for goes on in the collection, and is closed.

    All places of all ``texts`` are counted, but for the last ones of those whose
    end is judged: these are in ``ends (tail_id, level, node)``, once for all
    copies, and close their nodes too.
    """
    places = texts.select("text").mapInPandas(_of_texts(_filter(ends)), "node long, n_on long, n_closed long")
    last = ends.select("node", F.lit(0).cast("long").alias("n_on"), F.lit(1).cast("long").alias("n_closed"))
    return places.unionAll(last).groupBy("node").agg(F.sum("n_on").alias("n_on"), F.sum("n_closed").alias("n_closed"))


def judged_ends(texts: DataFrame, tails: DataFrame) -> DataFrame:
    """``(tail_id, word_on, word_closed, n_on, n_closed)`` of the distinct ends ``(tail_id, tail)``.

    ``word_*`` is of the word at the end, ``n_*`` of the longest known ending;
    neither counts the end itself. Ends of which nothing is known are left out.
    """
    ends = write_table(tails.mapInPandas(_of_ends, "tail_id long, level int, node long"))
    known = ends.join(vocabulary_trie(texts, ends), "node").withColumn("n_closed", F.col("n_closed") - 1)
    known = known.where(F.col("n_on") + F.col("n_closed") >= KNOWN)
    word, counts = F.col("level") == WORD, F.struct("n_on", "n_closed")
    longest = F.max_by(F.when(~word, counts), F.when(~word, F.col("level")))
    found = known.groupBy("tail_id").agg(F.max(F.when(word, counts)).alias("w"), longest.alias("e"))
    return found.select("tail_id", F.col("w.n_on").alias("word_on"), F.col("w.n_closed").alias("word_closed"), "e.n_on", "e.n_closed")


def _head(line: Column) -> Column:
    """What a line that is no running text may begin with: a label, or two characters of which the first is no letter; all digits are one."""
    label = F.nullif(F.regexp_extract(line, _LABEL, 1), F.lit(""))
    return F.regexp_replace(F.coalesce(label, F.nullif(F.regexp_extract(line, r"^\s*([^\p{L}\s].)", 1), F.lit(""))), r"\d", "0")


def last_line(text: Column) -> Column:
    return F.substring_index(F.rtrim(text, F.lit("\n\r")), "\n", -1)


def unmarked_heads(texts: DataFrame, last_lines: DataFrame) -> DataFrame:
    """``head`` of the lines that need no end mark: four in five of the lines with it have none.

    Lines within texts count each; last lines ``(head, ended)`` count once for all
    copies, less the one that is judged.
    """
    lines = F.split(F.rtrim("text", F.lit("\n\r")), "\n")
    inner = texts.where(F.contains("text", F.lit("\n"))).select(F.explode(F.slice(lines, F.lit(1), F.size(lines) - 1)).alias("line")).where("trim(line) <> ''")
    inner = inner.select(_head(F.col("line")).alias("head"), F.right("line", F.lit(_SHORT)).rlike(_END).alias("ended"))
    counts = inner.unionAll(last_lines.select("head", "ended")).where("head IS NOT NULL").groupBy("head").agg(F.count("*").alias("n"), F.count_if(~F.col("ended")).alias("bare"))
    return counts.where((F.col("bare") > KNOWN) & (F.col("bare") - 1 >= WHOLE * (F.col("n") - 1))).select("head")


def _piles(measured: DataFrame, unit: str, width: int) -> DataFrame:
    """``(source, top, closed)``: each length of a source at which its open-ended texts pile up.

    ``top`` ends a bin of ``width`` lengths; ``closed`` tells that so few texts are
    about that even one with an end mark was rather cut there than has that length
    by chance.
    """
    lengths = measured.groupBy("source", unit).agg(
        F.approx_count_distinct("h").alias("texts"), F.approx_count_distinct(F.when(F.col("openish"), F.col("h"))).alias("open")
    )
    along = W.partitionBy("source").orderBy(unit)

    def count(what: str, low: int, high: int) -> Column:
        return F.coalesce(F.sum(what).over(along.rangeBetween(low, high)), F.lit(0))

    def rate(what: str) -> Column:
        """Texts to be expected in the bin, from the denser of its two sides (beyond a limit there is nothing)."""
        left, right = count(what, -width - NEAR + 1, -2 * width + 1), count(what, width, NEAR + width - 1)
        if width == 1:
            left, right = count(what, -NEAR, -1), count(what, 1, NEAR)
        return (F.greatest(left, right) + 0.5) / NEAR * width

    n = count("open", 1 - width, 0)
    bins = lengths.select("source", F.col(unit).alias("top"), n.alias("n"), rate("open").alias("rate"), rate("texts").alias("rate_all"))
    surprise = F.col("n") * F.log(F.col("n") / F.col("rate")) - F.col("n") + F.col("rate")
    piled = bins.where((F.col("n") > 3 * F.col("rate")) & (surprise >= SURPRISE))
    # of bins that overlap, the fullest; of equal ones the first
    order = W.partitionBy("source").orderBy("top")
    near = lambda low, high: F.coalesce(F.max("n").over(order.rangeBetween(low, high)), F.lit(0))
    best = piled.withColumn("best", (F.col("n") > near(1 - width, -1)) & (F.col("n") >= near(1, width - 1))) if width > 1 else piled.withColumn("best", F.lit(True))
    return best.where("best").select("source", "top", (F.col("rate_all") <= CLOSED * F.col("n")).alias("closed"))


def source_limits(measured: DataFrame) -> DataFrame:
    """``(source, limits_chars, limits_bytes)``: the limits of each source that has one, as arrays of ``(top, closed)``.

    Every length of the source is tested against its neighbours, so limits may be
    several, touch few of the texts, and have longer texts above them. Bytes are
    tested in bins of five lengths, since a cut may fall within a character, and
    without the texts at a limit of characters.
    """

    def listed(piles: DataFrame, name: str) -> DataFrame:
        return piles.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("top", "closed"))).alias(name))

    chars = _piles(measured, "nc", 1)
    rest = measured.join(chars.select("source", F.col("top").alias("nc")), ["source", "nc"], "left_anti")
    return listed(chars, "limits_chars").join(listed(_piles(rest, "nb", 5), "limits_bytes"), "source", "full")


def truncated(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, evidence)`` for each non-null text, ``evidence`` null if it is whole.

    ``evidence`` is the first that holds of ``prefix`` (the trie), ``limit``,
    ``torn`` and ``open``. An empty text is whole; a null source is a source like
    any other but has no limit; repeated rows give repeated rows; other columns
    are ignored.
    """
    base = docs.where(F.col("text").isNotNull()).select("doc_id", "source", "text")
    last = last_line(F.col("text"))
    lines = base.select(
        *["doc_id", "source", F.length("text").alias("nc"), F.octet_length("text").alias("nb"), F.xxhash64("text").alias("h")],
        last.alias("last"),
        (F.length(last) < F.length("text")).alias("several"),
        F.right("text", F.lit(_SHORT)).alias("short"),
    )
    marks = lines.select(
        *["doc_id", "source", "nc", "nb", "h", "short"],
        (F.trim("last") == "").alias("empty"),
        F.when(F.col("several"), _head(F.col("last"))).alias("head"),  # a text of one line has no form of last lines
        F.col("last").rlike(_TRAILER).alias("listed"),
        F.col("short").rlike(_TORN).alias("torn"),
        F.col("short").rlike(_MARK).alias("marked"),
        (F.col("short").rlike(_END) & ~F.col("short").rlike(_OMITTED)).alias("ended"),
    )
    judged = F.col("torn") | F.col("marked") | ~F.col("ended") | F.col("short").rlike(_WORD_END)
    measured = write_table(marks.withColumns({"tail_id": F.xxhash64("short"), "short": F.when(judged, F.col("short"))}))
    tails = measured.where("short IS NOT NULL AND NOT empty").groupBy("tail_id").agg(F.first("short").alias("tail"))
    lasts = measured.where("NOT empty AND head IS NOT NULL").groupBy("tail_id", "head").agg(F.first("ended").alias("ended"))
    heads = unmarked_heads(base, lasts).withColumn("formed", F.lit(True))
    joined = measured.drop("short").join(judged_ends(base, tails), "tail_id", "left").join(heads, "head", "left")
    trailer = F.col("listed") | F.coalesce("formed", F.lit(False))
    running = write_table(
        joined.withColumn("trailer", trailer).withColumn("openish", ~F.col("trailer") & (~F.col("ended") | F.col("marked")) | F.col("torn"))
    )
    joined = running.join(source_limits(running), "source", "left")
    reached = lambda x: F.col("openish") | x["closed"]
    at_limit = F.coalesce(
        F.exists("limits_chars", lambda x: (F.col("nc") == x["top"]) & reached(x)), F.lit(False)
    ) | F.coalesce(F.exists("limits_bytes", lambda x: F.col("nb").between(x["top"] - 4, x["top"]) & reached(x)), F.lit(False))
    share = F.col("n_closed") / (F.col("n_on") + F.col("n_closed"))
    doubt = F.when(F.col("marked"), (F.col("n_closed") + 0.5) / (F.col("n_on") + F.col("n_closed") + 1)).otherwise(share)
    cut_word = F.coalesce((F.col("word_closed") == 0) & (F.col("word_on") >= KNOWN), F.lit(False))
    cut_run = F.coalesce(F.col("openish") & ~F.col("trailer") & (doubt <= GOES_ON), F.lit(False))
    whole = F.coalesce((share > WHOLE) & (F.col("n_closed") >= KNOWN), F.lit(False))
    evidence = (
        F.when(F.col("empty"), F.lit(None))
        .when(cut_word, F.lit("prefix"))
        .when(at_limit & ~F.col("trailer"), F.lit("limit"))
        .when(cut_run, F.lit("prefix"))
        .when(F.col("torn"), F.lit("torn"))
        .when(~F.col("trailer") & ~F.col("ended") & (~whole | F.col("marked")), F.lit("open"))
    )
    return joined.select("doc_id", "source", evidence.alias("evidence"))
