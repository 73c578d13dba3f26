"""Best path, marginals, n best paths, and words from tags."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.crf.features import expand
from lexmill.operators.crf.model import Model
from lexmill.session import map_keyed

_TAGGED = "key long, line_no int, sent_no int, tokens array<string>, tags array<string>, words array<string>, score double, prob double, rank int"


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def viterbi(emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """The best path (of equals the lowest tag), its score, and the best scores of all beginnings."""
    n, y = emit.shape
    best, back = np.zeros((n, y)), np.zeros((n, y), np.int64)
    best[0] = emit[0]
    for i in range(1, n):
        total = best[i - 1][:, None] + move[i]
        back[i] = total.argmax(0)
        best[i] = total.max(0) + emit[i]
    path = np.zeros(n, np.int64)
    path[-1] = int(best[-1].argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i][path[i]]
    return path, float(best[-1].max()), best


def viterbi_many(emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best paths and scores of stacked sentences of one length; the same as ``viterbi`` of each."""
    count, n, _ = emit.shape
    best, back = emit[:, 0], []
    for i in range(1, n):
        total = best[:, :, None] + move[:, i]
        back.append(total.argmax(1))
        best = total.max(1) + emit[:, i]
    path = np.zeros((count, n), np.int64)
    path[:, -1] = best.argmax(1)
    for i in range(n - 1, 0, -1):
        path[:, i - 1] = back[i - 1][np.arange(count), path[:, i]]
    return path, best.max(1)


def forward_backward(emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    n, y = emit.shape
    alpha, beta = np.zeros((n, y)), np.zeros((n, y))
    alpha[0] = emit[0]
    for i in range(1, n):
        alpha[i] = logsumexp(alpha[i - 1][:, None] + move[i], 0) + emit[i]
    for i in range(n - 2, -1, -1):
        beta[i] = logsumexp(move[i + 1] + (emit[i + 1] + beta[i + 1])[None, :], 1)
    return alpha, beta, float(logsumexp(alpha[-1], 0))


def path_score(emit: np.ndarray, move: np.ndarray, path: np.ndarray) -> float:
    i = np.arange(1, len(path))
    return float(emit[np.arange(len(path)), path].sum() + move[i, path[:-1], path[1:]].sum())


def n_best(emit: np.ndarray, move: np.ndarray, n: int) -> list[tuple[np.ndarray, float]]:
    """The ``n`` best paths by A* from the end; what is left is bounded exactly by the best beginnings."""
    _, _, best = viterbi(emit, move)
    length, y = emit.shape
    heap = [(-best[-1][t], k, (t,), emit[-1][t]) for k, t in enumerate(range(y))]
    heapq.heapify(heap)
    tick, out = y, []
    while heap and len(out) < n:
        _, _, tail, score = heapq.heappop(heap)
        i = length - len(tail)
        if i == 0:
            out.append((np.array(tail), float(score)))
            continue
        for t in range(y):
            ahead = score + move[i][t, tail[0]]
            heapq.heappush(heap, (-(best[i - 1][t] + ahead), tick, (t, *tail), ahead + emit[i - 1][t]))
            tick += 1
    return out


class Stack:
    """Sentences one upon another, the longest first: a step along them is one operation for all that go so far.

    ``rows`` is the row of each place of the sentences end to end, ``steps`` the
    slice of the rows of each position, and ``ends`` each sentence's last row.
    """

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        rank = np.empty(len(sizes), np.int64)
        rank[np.argsort(-sizes, kind="stable")] = np.arange(len(sizes))
        alive = len(sizes) - np.cumsum(np.bincount(sizes))[:-1]
        offsets = np.concatenate([[0], np.cumsum(alive)])
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.rows = offsets[place] + np.repeat(rank, sizes)
        self.ends = offsets[sizes - 1] + rank
        self.steps = [slice(a, b) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]

    def stacked(self, x: np.ndarray) -> np.ndarray:
        out = np.empty_like(x)
        out[self.rows] = x
        return out

    def pairs(self, move: np.ndarray):
        """From the second position on: the rows here, those before, and the transitions."""
        for before, here in zip(self.steps, self.steps[1:]):
            yield here, slice(before.start, before.start + here.stop - here.start), move[here] if len(move) > 1 else move


def forward_many(stack: Stack, emit: np.ndarray, move: np.ndarray, add=logsumexp) -> np.ndarray:
    """``alpha`` of stacked sentences; with ``np.max`` the best scores of all beginnings."""
    out = emit.copy()
    for here, before, m in stack.pairs(move):
        out[here] += add(out[before][:, :, None] + m, axis=1)
    return out


def backward_many(stack: Stack, emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    out = np.zeros_like(emit)
    for here, before, m in reversed(list(stack.pairs(move))):
        out[before] = logsumexp(m + (emit[here] + out[here])[:, None, :], axis=2)
    return out


def best_paths(stack: Stack, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``viterbi`` of stacked sentences: tags of the rows and scores of the sentences."""
    best, back, path = emit.copy(), np.zeros(emit.shape, np.int8), np.zeros(len(emit), np.int64)
    for here, before, m in stack.pairs(move):
        total = best[before][:, :, None] + m
        back[here] = total.argmax(1)
        best[here] = total.max(1) + emit[here]
    path[stack.ends] = best[stack.ends].argmax(1)
    for here, before in reversed(list(zip(stack.steps[1:], stack.steps))):
        n = here.stop - here.start
        path[before.start : before.start + n] = back[here][np.arange(n), path[here]]
    return path, best[stack.ends].max(1)


def _merged(score: np.ndarray, entry: np.ndarray, above: np.ndarray, move: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
    """The best of the paths ``(sentences, tags, n)`` that go on to each next tag, in the order of ``n_best``.

    That search takes equals first in, first out. A path is thus first by its
    score, then by how far ahead the place lies where its loss occurs (``entry``),
    then by the path it left there (``above``), then by its tag. Returns score,
    entry, above, the tag before and the place among that tag's paths.
    """
    count, y, n = score.shape
    z = move.shape[2]
    top = score == score[:, :, :1]
    pad = lambda x, by: np.concatenate([x, np.full((count, y, 1), by, x.dtype)], 2).ravel()
    scores, entries, aboves = pad(score, -np.inf), pad(np.where(top, at - 1, entry), 0), pad(np.where(top, n, above), n)
    head = np.broadcast_to((np.arange(count * y) * (n + 1)).reshape(count, y, 1), (count, y, z)).copy()
    start = head.copy()
    cells = np.arange(count * y * z).reshape(count, y, z) * (n + 1)
    ranks = np.zeros(count * y * z * (n + 1), np.int64)  # of a path, its place among the merged ones
    tags, out = np.arange(y)[:, None], [np.empty((count, z, n), t) for t in (float, np.int64, np.int64, np.int8, np.int8)]
    pick = np.arange(count)[:, None] * (y * z) + np.arange(z)
    for r in range(n):
        total = scores[head] + move
        if r:
            over = ranks[cells + aboves[head]]
            order = (entries[head] * (n + 1) + over) * y + tags
            tag = np.where(total == total.max(1, keepdims=True), order, np.iinfo(np.int64).max).argmin(1)
        else:
            tag = total.argmax(1)
        chosen = pick + tag * z
        from_ = head.ravel()[chosen]
        which = from_ - start.ravel()[chosen]
        out[0][:, :, r] = total.ravel()[chosen]
        out[1][:, :, r] = entries[from_]
        out[2][:, :, r] = over.ravel()[chosen] if r else 0
        out[3][:, :, r], out[4][:, :, r] = tag, np.minimum(which, n - 1)
        ranks[chosen * (n + 1) + np.minimum(which, n - 1)] = r
        head.ravel()[chosen] += which < n
    return tuple(out)


def n_best_many(stack: Stack, emit: np.ndarray, move: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n_best`` of stacked sentences: tags ``(rows, n)`` and scores ``(sentences, n)``, minus infinity where there are no more paths."""
    y = emit.shape[1]
    score, first = np.full((len(emit), y, n), -np.inf), stack.steps[0]
    score[first, :, 0] = emit[first]
    entry, above = np.zeros(score.shape, np.int64), np.zeros(score.shape, np.int64)
    tag, which = np.zeros(score.shape, np.int8), np.zeros(score.shape, np.int8)
    for at, (here, before, m) in enumerate(stack.pairs(move), 1):
        best, entry[here], above[here], tag[here], which[here] = _merged(score[before], entry[before], above[before], m, at)
        score[here] = best + emit[here][:, :, None]
    ends = np.sort(stack.ends)
    order = np.argsort(np.argsort(stack.ends, kind="stable"), kind="stable")
    last = _merged(score[ends], entry[ends], above[ends], np.zeros((1, y, 1)), len(stack.steps))
    t, k = np.zeros((2, len(emit), n), np.int8)
    t[ends], k[ends] = last[3][:, 0], last[4][:, 0]
    for here, before, _ in reversed(list(stack.pairs(move[:1]))):
        rows = np.arange(here.start, here.stop)[:, None]
        t[before], k[before] = tag[rows, t[here], k[here]], which[rows, t[here], k[here]]
    return t, last[0][:, 0][order]


def words_of(tokens: list[str], tags: list[str], drop_last: bool = True) -> list[str]:
    """Words: a tag B or S starts one, every other goes on. The last token is dropped, as it mostly is the end mark."""
    out: list[str] = []
    for token, tag in zip(tokens[: len(tokens) - 1] if drop_last else tokens, tags):
        if tag in ("B", "S") or not out:
            out.append(token)
        else:
            out[-1] += token
    return out


def _best_paths(model: Model, sentences: list[list]) -> list[tuple[np.ndarray, float]]:
    """The best path and its score of each sentence; sentences of one length are decoded together."""
    out: list = [None] * len(sentences)
    if not all(isinstance(tokens[0], str) for tokens in sentences):  # rows of columns
        for k, tokens in enumerate(sentences):
            path, score, _ = viterbi(*model.scores(tokens))
            out[k] = (path, score)
        return out
    emit, move = model.scores_of_batch(sentences)
    sizes = np.array([len(s) for s in sentences])
    starts = np.cumsum(sizes) - sizes
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        places = starts[at][:, None] + np.arange(n)
        moves = move[places] if len(move) > 1 else np.broadcast_to(move, (1, n, *move.shape[1:]))
        paths, scores = viterbi_many(emit[places], moves)
        for k, path, score in zip(at, paths, scores.tolist()):
            out[k] = (path, score)
    return out


def _tagger(model: Model, nbest: int, drop_last: bool, marginals: bool, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["key", "line_no", "sent_no", *columns]
        starting = np.array([t in ("B", "S") for t in model.tags])
        for pdf in batches:
            rows = []
            pdf = pdf[pdf["tokens"].map(len) > 0]
            sentences = [list(t) for t in pdf["tokens"]]
            if not sentences:
                continue
            single = _best_paths(model, sentences) if nbest == 1 else [None] * len(sentences)
            for key, line_no, sent_no, tokens, one in zip(pdf["key"], pdf["line_no"], pdf["sent_no"], sentences, single):
                paths, z = [one], None
                if nbest > 1 or marginals:
                    emit, move = model.scores(tokens)
                    z = forward_backward(emit, move)[2]
                    paths = n_best(emit, move, nbest) if nbest > 1 else paths
                for k, (path, score) in enumerate(paths):
                    row = [key, line_no, sent_no]
                    for c in columns:
                        if c == "words":
                            row.append(_words(tokens, starting[path], drop_last))
                        elif c == "tags":
                            row.append([model.tags[t] for t in path])
                        elif c == "prob":
                            row.append(float(np.exp(score - z)) if z is not None else None)
                        else:
                            row.append({"tokens": tokens, "score": score, "rank": k}[c])
                    rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    return run


def _lattices(model: Model, batches: Iterator[pa.RecordBatch], most: int = 100_000):
    """Of sentences with tokens, about ``most`` tokens at a time: rows, tokens end to end, their numbers and names, sizes, stack, emissions and transitions."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy().astype(np.int64)
        batch, sizes = batch.filter(pa.array(sizes > 0)), sizes[sizes > 0]
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            rows, n = batch.slice(a, b - a), sizes[a:b]
            flat = rows.column("tokens").flatten().cast(pa.string())
            coded = flat.dictionary_encode()
            code, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            emit, move = model.scores_of_codes(code, names, n)
            stack = Stack(n)
            yield rows, flat, code, names, n, stack, stack.stacked(emit), stack.stacked(move) if len(move) > 1 else move


def _joined(flat: pa.StringArray, starts: np.ndarray, sizes: np.ndarray, drop_last: bool) -> pa.ListArray:
    """``words_of`` of sentences end to end, of whose tokens it is known whether they start a word."""
    ends = np.cumsum(sizes)
    starts, kept = starts.copy(), np.ones(len(flat), bool)
    starts[ends - sizes] = True
    if drop_last:
        kept[ends - 1] = False
    text, owner = pa.concat_arrays([flat.filter(pa.array(kept))]), np.repeat(np.arange(len(sizes)), sizes)[kept]
    at = np.flatnonzero(starts[kept])
    _, offsets, data = text.buffers()
    bounds = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds[np.append(at, len(text))].astype(np.int32)), data or pa.py_buffer(b""))
    counts = np.bincount(owner[at], minlength=len(sizes))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), words)


def _n_best_tagger(model: Model, nbest: int, drop_last: bool, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starting = np.array([t in ("B", "S") for t in model.tags])
        for rows, _, _, _, sizes, stack, emit, move in _lattices(model, batches):
            paths, scores = n_best_many(stack, emit, move, nbest)
            z = logsumexp(forward_many(stack, emit, move)[stack.ends], 1)
            sentence, rank = np.nonzero(np.isfinite(scores))
            taken, n = rows.take(pa.array(sentence)), sizes[sentence]
            first, to = (np.cumsum(sizes) - sizes)[sentence], np.append(0, np.cumsum(n))
            place = np.repeat(first - to[:-1], n) + np.arange(to[-1])
            tags, score = paths[stack.rows[place], np.repeat(rank, n)], scores[sentence, rank]
            made = {
                "tokens": lambda: taken.column("tokens"),
                "tags": lambda: pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(model.tags).take(pa.array(tags))),
                "words": lambda: _joined(taken.column("tokens").flatten().cast(pa.string()), starting[tags], n, drop_last),
                "score": lambda: pa.array(score),
                "prob": lambda: pa.array(np.exp(score - z[sentence])),
                "rank": lambda: pa.array(rank.astype(np.int32)),
            }
            kept = ["key", "line_no", "sent_no"]
            yield pa.RecordBatch.from_arrays([*[taken.column(c) for c in kept], *[made[c]() for c in columns]], [*kept, *columns])

    return run


def _words(tokens: list, starts: np.ndarray, drop_last: bool) -> list[str]:
    """``words_of`` for tags of which it is known whether they start a word."""
    n = len(tokens) - 1 if drop_last else len(tokens)
    if n <= 0:
        return []
    cuts = [0, *(np.flatnonzero(starts[1:n]) + 1).tolist(), n]
    text = [t if isinstance(t, str) else t[0] for t in tokens]
    return ["".join(text[a:e]) for a, e in zip(cuts, cuts[1:])]


def tag(
    sentences: DataFrame, model: Model, nbest: int = 1, drop_last: bool = True, marginals: bool = False, columns: list[str] | None = None
) -> DataFrame:
    """Tags, words, score and (with ``marginals`` or several paths) probability of each sentence.

    ``sentences`` has ``key, line_no, sent_no, tokens``. An empty sentence gives
    no row. Of the results only ``columns`` are made, by default all.
    """
    rows = sentences.select("key", "line_no", "sent_no", "tokens")
    kinds = dict(c.split() for c in _TAGGED.split(", "))
    wanted = columns or [c for c in kinds if c not in ("key", "line_no", "sent_no")]
    given = dict(rows.dtypes)
    if nbest > 1 and given["tokens"] == "array<string>":
        schema = ", ".join(f"{c} {kinds.get(c) if c in wanted else given[c]}" for c in ("key", "line_no", "sent_no", *wanted))
        return rows.mapInArrow(_n_best_tagger(model, nbest, drop_last, wanted), schema)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("key", "line_no", "sent_no", *wanted))
    return map_keyed(rows, _tagger(model, nbest, drop_last, marginals, wanted), schema, "key")


def _posteriors(stack: Stack, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``alpha``, ``beta`` and the probabilities of each place's tags, of the sentences end to end."""
    alpha, beta = forward_many(stack, emit, move)[stack.rows], backward_many(stack, emit, move)[stack.rows]
    z = logsumexp(alpha[np.cumsum(stack.sizes) - 1], 1)
    return alpha, beta, np.exp(alpha + beta - np.repeat(z, stack.sizes)[:, None])


def _marginals(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = len(model.tags)
        for rows, flat, _, _, sizes, stack, emit, move in _lattices(model, batches):
            alpha, beta, p = _posteriors(stack, emit, move)
            best = forward_many(stack, emit, move, np.max)[stack.rows]
            i = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            owners = rows.select(["key", "line_no", "sent_no"]).take(pa.array(np.repeat(np.arange(len(sizes)), sizes * y)))
            token, tag = flat.take(pa.array(np.repeat(np.arange(len(flat)), y))), pa.array(model.tags).take(pa.array(np.tile(np.arange(y), len(flat))))
            cells = [pa.array(c.ravel()) for c in (emit[stack.rows], alpha, beta, best, p)]
            names = ["key", "line_no", "sent_no", "i", "token", "tag", "emission", "alpha", "beta", "best", "prob"]
            yield pa.RecordBatch.from_arrays([*owners.columns, pa.array(np.repeat(i, y).astype(np.int32)), token, tag, *cells], names)

    return run


def tag_marginals(sentences: DataFrame, model: Model) -> DataFrame:
    """``(key, line_no, sent_no, i, token, tag, emission, alpha, beta, best, prob)`` of every position and tag.

    ``best`` is the score of the best beginning that ends in the tag there.
    """
    rows = sentences.select("key", "line_no", "sent_no", "tokens")
    given = ", ".join(f"{c} {k}" for c, k in rows.dtypes[:3])
    return rows.mapInArrow(_marginals(model), f"{given}, i int, token string, tag string, emission double, alpha double, beta double, best double, prob double")


def _expected(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = len(model.tags)
        for _, _, code, names, _, stack, emit, move in _lattices(model, batches):
            p = _posteriors(stack, emit, move)[2]
            sums = np.stack([np.bincount(code, p[:, t], len(names)) for t in range(y)], 1)
            token, tag = np.repeat(np.arange(len(names)), y), np.tile(np.arange(y), len(names))
            cells = [pa.array(names, pa.string()).take(pa.array(token)), pa.array(model.tags).take(pa.array(tag)), pa.array(sums.ravel())]
            yield pa.RecordBatch.from_arrays([*cells, pa.array(np.repeat(np.bincount(code, minlength=len(names)), y))], ["token", "tag", "expected", "n"])

    return run


def expected_counts(sentences: DataFrame, model: Model) -> DataFrame:
    """``(token, tag, expected, n)``: the sum of the probabilities of a tag over the places of a token, and their number; summed where they arise first."""
    parts = sentences.select("tokens").mapInArrow(_expected(model), "token string, tag string, expected double, n bigint")
    return parts.groupBy("token", "tag").agg(F.sum("expected").alias("expected"), F.sum("n").alias("n"))


def _results(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = {t: k for k, t in enumerate(model.tags)}
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                tokens = list(r.tokens)
                if not tokens:
                    continue
                emit, move = model.scores(tokens)
                alpha, beta, z = forward_backward(emit, move)
                path = viterbi(emit, move)[0]
                p = np.exp(alpha + beta - z)
                for i, t in enumerate(path):
                    gold = index.get(r.tags[i]) if r.tags is not None else None
                    out.append((r.key, r.line_no, r.sent_no, i, tokens[i], model.tags[t], int(t), gold, float(p[i, t])))
            yield pd.DataFrame(out, columns=["key", "line_no", "sent_no", "i", "token", "tag", "tag_id", "gold_id", "prob"]).astype({"gold_id": "Int32"})

    return run


def results(sentences: DataFrame, model: Model) -> DataFrame:
    """``(key, line_no, sent_no, i, token, tag, tag_id, gold_id, prob)`` of every position.

    ``gold_id`` is of the column ``tags``, where ``sentences`` has one, and null for a tag the model lacks.
    """
    gold = F.col("tags") if "tags" in sentences.columns else F.lit(None).cast("array<string>")
    schema = "key long, line_no int, sent_no int, i int, token string, tag string, tag_id int, gold_id int, prob double"
    return map_keyed(sentences.select("key", "line_no", "sent_no", "tokens", gold.alias("tags")), _results(model), schema, "key")


def _transitions(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                tokens = list(r.tokens)
                if not tokens:
                    continue
                emit, move = model.scores(tokens)
                z = forward_backward(emit, move)[2]
                vectors = feature_vectors(tokens, model)
                for i in range(len(tokens)):
                    costs = [[float(-c) for c in row] for row in move[i]] if i else []
                    out.append((r.key, r.line_no, r.sent_no, i, float(z), costs, *vectors[i]))
            yield pd.DataFrame(out, columns=["key", "line_no", "sent_no", "i", "z", "transition_costs", "emission_vector", "transition_vector"])

    return run


def transitions(sentences: DataFrame, model: Model) -> DataFrame:
    """``(key, line_no, sent_no, i, z, transition_costs, emission_vector, transition_vector)`` of every position.

    ``z`` is the logarithm of the sum over all paths, ``transition_costs`` has a
    row per tag before and a cost per tag here, and the vectors are the
    identifiers of the known features; of the first position the costs and the
    transition vector are empty.
    """
    schema = "key long, line_no int, sent_no int, i int, z double, transition_costs array<array<double>>, emission_vector array<int>, transition_vector array<int>"
    return map_keyed(sentences.select("key", "line_no", "sent_no", "tokens"), _transitions(model), schema, "key")


def feature_vectors(sentence: list, model: Model) -> list[tuple[list[int], list[int]]]:
    """The identifiers of each position's known features, of one tag and of pairs of tags."""
    out = []
    for i in range(len(sentence)):
        found = [(f[0], model.ids[f]) for f in expand(sentence, i, model.templates) if f in model.ids]
        out.append(([k for kind, k in found if kind == "U"], [k for kind, k in found if kind != "U"]))
    return out
