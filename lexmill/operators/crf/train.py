"""Training: L2 and L1 by limited-memory quasi-Newton steps, and MIRA by parameter mixing.

Every round the gradient is summed over the partitions of a persisted table of
sentences and only the sums visit the driver; they have one number per weight.

MIRA bounds the sum of a sentence's steps by ``c``, passes over a sentence that was
right ``shrink`` times in a row, and ends after two rounds without a violated
margin. These numbers belong to the sentence: every round gives them anew, in the order
of the numbered sentences, which stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.crf.decode import Stack, backward_many, best_paths, forward_backward, forward_many, logsumexp, path_score, viterbi
from lexmill.operators.crf.features import TEMPLATES, Template, expand, feature_counts
from lexmill.operators.crf.model import Model, number_features
from lexmill.session import cut_rdd

MAX_FEATURES = 5_000_000  # a model beyond this is not broadcast; raise ``least`` or this bound


def _prepare(model: Model, tokens: list[str]) -> tuple[list[list[int]], list[list[int]]]:
    uni, bi = [], []
    for i in range(len(tokens)):
        found = [(f, model.ids[f]) for f in expand(tokens, i, model.templates) if f in model.ids]
        uni.append([k for f, k in found if f[0] == "U"])
        bi.append([k for f, k in found if f[0] == "B"])
    return uni, bi


def _lattice(w: np.ndarray, uni: list[list[int]], bi: list[list[int]], y: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(y)
    emit = np.stack([w[np.add.outer(np.array(u, int), at)].sum(0) if u else np.zeros(y) for u in uni])
    square = np.arange(y * y)
    move = np.stack([w[np.add.outer(np.array(b, int), square)].sum(0).reshape(y, y) if b else np.zeros((y, y)) for b in bi])
    return emit, move


def sentence_gradient(w: np.ndarray, uni, bi, gold: np.ndarray, y: int, grad: np.ndarray) -> tuple[float, int]:
    """Adds expectations less observations to ``grad``; returns the loss and the number of wrong tags."""
    emit, move = _lattice(w, uni, bi, y)
    alpha, beta, z = forward_backward(emit, move)
    node = np.exp(alpha + beta - z)
    node[np.arange(len(gold)), gold] -= 1
    for i in range(len(gold)):
        for u in uni[i]:
            grad[u : u + y] += node[i]
        if i and bi[i]:
            edge = np.exp(alpha[i - 1][:, None] + move[i] + (emit[i] + beta[i])[None, :] - z)
            edge[gold[i - 1], gold[i]] -= 1
            for b in bi[i]:
                grad[b : b + y * y] += edge.ravel()
    path = viterbi(emit, move)[0]
    return z - path_score(emit, move, gold), int((path != gold).sum())


_NUMBERED = "sizes binary, gold binary, uni binary, bi binary"
_TOKENS = 200_000  # about so many tokens are numbered, and stepped through, together


def _number(model: Model):
    """Sentences as numbers: sizes, gold tags, and of each place the identifiers of its features; an unknown one has that after the last weight."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = {t: k for k, t in enumerate(model.tags)}
        held, size = [], 0

        def made() -> pd.DataFrame:
            tokens = np.concatenate([t for t, _ in held])
            sizes = np.array([len(t) for t, _ in held], np.int64)
            code, names = pd.factorize(tokens)
            ids = {True: [], False: []}
            for t, found, key in model.features_of_codes(code, [str(n) for n in names], sizes):
                ids[t.is_unigram].append(np.where(found < 0, len(model.weights), found)[key].astype(np.int32))
            gold = np.array([index[t] for _, tags in held for t in tags], np.int32)
            row = [sizes.tobytes(), gold.tobytes(), *[np.array(ids[k], np.int32).tobytes() for k in (True, False)]]
            return pd.DataFrame([row], columns=[c.split()[0] for c in _NUMBERED.split(", ")])

        for pdf in batches:
            for tokens, tags in zip(pdf["tokens"], pdf["tags"]):
                if len(tokens):
                    held.append((np.array(tokens, object), tags))
                    size += len(tokens)
                if size >= _TOKENS:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    return run


def _numbers(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, gold tags, and features by template and place, of one row of numbered sentences."""
    gold = np.frombuffer(row["gold"], np.int32)
    uni, bi = (np.frombuffer(row[k], np.int32).reshape(-1, len(gold)) for k in ("uni", "bi"))
    return np.frombuffer(row["sizes"], np.int64), gold, uni, bi


def _wide(w: np.ndarray, y: int) -> np.ndarray:
    """Weights with those of the unknown feature after them."""
    return np.concatenate([w, np.zeros(y * y)])


def _scores(w: np.ndarray, uni: np.ndarray, bi: np.ndarray, y: int) -> tuple[np.ndarray, np.ndarray]:
    """Emissions and transitions of every place; transitions that are the same everywhere are one matrix."""
    emit, move = np.zeros((uni.shape[1], y)), np.zeros((1, y, y))
    each = w.reshape(-1, y)
    for u in uni:
        emit += each[u // y]
    for b in bi:
        same = b[:1] if (b == b[0]).all() else b
        move = move + w[same[:, None] + np.arange(y * y)].reshape(-1, y, y)
    return emit, move


def _add_gradient(w: np.ndarray, row, y: int, grad: np.ndarray) -> np.ndarray:
    """Adds the gradient of a row of sentences to ``grad``, both wide; returns loss, wrong tags, wrong sentences, tags and sentences."""
    sizes, gold, uni, bi = _numbers(row)
    stack = Stack(sizes)
    emit, move = _scores(w, uni, bi, y)
    emit, g = stack.stacked(emit), stack.stacked(gold)
    move = stack.stacked(move) if len(move) > 1 else move
    p, alpha, beta = len(gold), forward_many(stack, emit, move), backward_many(stack, emit, move)
    every, edge, z = np.arange(p), np.zeros((p, y, y)), np.empty(p)
    total, score = logsumexp(alpha[stack.ends], 1), emit[every, g]
    z[stack.rows] = np.repeat(total, sizes)
    for here, before, m in stack.pairs(move):
        pair = edge[here]
        pair[:] = alpha[before][:, :, None] + m
        pair += (emit[here] + beta[here] - z[here][:, None])[:, None, :]
        np.exp(pair, out=pair)
        pair[np.arange(len(pair)), g[before], g[here]] -= 1
        score[here] += m[np.arange(len(m)) if len(m) > 1 else 0, g[before], g[here]]
    node = np.exp(alpha + beta - z[:, None])
    node[every, g] -= 1
    node, edge, bad = node[stack.rows], edge[stack.rows].reshape(p, y * y), (best_paths(stack, emit, move)[0] != g)[stack.rows]
    for u in uni:
        np.add.at(grad, (u[:, None] + np.arange(y)).ravel(), node.ravel())
    for b in bi:
        if (b == b[0]).all():
            grad[b[0] : b[0] + y * y] += edge.sum(0)
        else:
            np.add.at(grad, (b[:, None] + np.arange(y * y)).ravel(), edge.ravel())
    wrong = np.add.reduceat(bad.astype(np.int64), np.cumsum(sizes) - sizes)
    return np.array([total.sum() - score.sum(), wrong.sum(), (wrong > 0).sum(), p, len(sizes)], float)


def batch_gradient(w: np.ndarray, pdf: pd.DataFrame, y: int, grad: np.ndarray) -> tuple[float, int, int, int]:
    """Adds the gradient of all sentences of ``pdf`` to ``grad``; returns loss, wrong tags, wrong sentences and tags.

    The same as ``sentence_gradient`` of each; sentences go through the lattice together.
    """
    out, total = _wide(np.zeros_like(w), y), np.zeros(5)
    for _, row in pdf.iterrows():
        total += _add_gradient(_wide(w, y), row, y, out)
    grad += out[: len(w)]
    return float(total[0]), *map(int, total[1:4])


_BLOCK = 1 << 18  # sums of so many weights make one row


def _blocks(at: np.ndarray, value: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Places, ascending, and their values, by block."""
    cuts = np.searchsorted(at, np.arange(0, (at[-1] if len(at) else 0) + 2 * _BLOCK, _BLOCK))
    for k, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
        if b > a:
            yield k, ((at[a:b] - k * _BLOCK).astype(np.int32), value[a:b])


def _plus(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    out, some = np.zeros(_BLOCK), np.zeros(_BLOCK, bool)
    for at, value in (a, b):
        out[at] += value
        some[at] = True
    at = np.flatnonzero(some).astype(np.int32)
    return at, out[at]


def _total(parts: RDD, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of all parts' counts (block -1) and of their weights' blocks; the driver sees one number per weight."""
    counts, out = np.zeros(5), np.zeros(size)
    for k, (at, value) in parts.reduceByKey(_plus, min(parts.getNumPartitions(), size // _BLOCK + 1)).collect():
        if k < 0:
            counts[at] = value
        else:
            out[at + k * _BLOCK] = value
    return counts, out


def _partials(weights, y: int):
    """Of a partition its counts, as block -1, and its gradient in blocks."""

    def run(rows: Iterator) -> Iterator:
        w = _wide(weights.value, y)
        grad, counts = np.zeros_like(w), np.zeros(5)
        for row in rows:
            counts += _add_gradient(w, row, y, grad)
        if counts[4]:
            at = np.flatnonzero(grad[: len(w) - y * y])
            yield -1, (np.arange(5, dtype=np.int32), counts)
            yield from _blocks(at, grad[at])

    return run


def mira_step(w: np.ndarray, uni, bi, gold: np.ndarray, y: int, room: float = 1.0) -> tuple[int, float, float]:
    """The least change of ``w`` that prefers the gold path to the best one by its number of errors, no longer than ``room``.

    Returns the number of errors, the length of the step, and by how much the
    margin was violated if the step was not cut short.
    """
    emit, move = _lattice(w, uni, bi, y)
    path, score, _ = viterbi(emit, move)
    wrong = int((path != gold).sum())
    if not wrong:
        return 0, 0.0, 0.0
    diff: dict[int, float] = {}

    def add(k: int, by: int) -> None:
        diff[k] = diff.get(k, 0) + by

    for i in range(len(gold)):
        for u in uni[i]:
            add(u + gold[i], 1)
            add(u + path[i], -1)
        for b in bi[i] if i else ():
            add(b + gold[i - 1] * y + gold[i], 1)
            add(b + path[i - 1] * y + path[i], -1)
    norm = sum(v * v for v in diff.values())
    if not norm:
        return wrong, 0.0, 0.0
    margin = wrong - path_score(emit, move, gold) + score
    full = max(0.0, margin / norm)
    step = min(full, room)
    for k, v in diff.items():
        w[k] += step * v
    return wrong, step, margin if full <= room else 0.0


def _mira_row(w: np.ndarray, row, y: int, used: np.ndarray, right: np.ndarray, c: float, shrink: int) -> np.ndarray:
    """``mira_step`` of each sentence of a row, with wide weights; returns wrong tags, wrong sentences, tags, sentences and violations.

    Sentences are decoded some at a time; after the first of them that changes
    the weights, those behind it are decoded again.
    """
    sizes, gold, uni, bi = _numbers(row)
    each, at_uni, square = w.reshape(-1, y), uni // y, np.arange(y * y)
    same = all((b == b[0]).all() for b in bi)
    starts, known, counts = np.cumsum(sizes) - sizes, len(w) - y * y, np.zeros(5)
    counts[2:4] = len(gold), len(sizes)
    todo, done, some = np.flatnonzero(right < shrink), 0, 8
    while done < len(todo):
        ks = todo[done : done + some]
        n = sizes[ks]
        ends = np.cumsum(n)
        places = np.repeat(starts[ks] - ends + n, n) + np.arange(ends[-1])
        stack, g = Stack(n), gold[places]
        emit = each[at_uni[:, places]].sum(0)
        move = w[bi[:, places[:1] if same else places, None] + square].sum(0).reshape(-1, y, y)
        path, scores = best_paths(stack, stack.stacked(emit), stack.stacked(move) if len(move) > 1 else move)
        path = path[stack.rows]
        bad = np.add.reduceat((path != g).astype(np.int64), ends - n)
        upto, step = 0, 0.0
        for j in np.flatnonzero(bad).tolist():
            right[ks[upto:j]] += 1
            upto, k, here = j + 1, ks[j], slice(ends[j] - n[j], ends[j])
            right[k] = 0
            counts[:2] += bad[j], 1
            step, violated = _step_of(w, uni[:, places[here]], bi[:, places[here]], emit[here], move[here] if len(move) > 1 else move, g[here], path[here], scores[j], c - used[k], known)
            used[k] += step
            counts[4] += violated
            if step:
                break
        if step:
            done, some = done + upto, max(8, min(some, 2 * upto))
        else:
            right[ks[upto:]] += 1
            done, some = done + len(ks), min(2 * some, 512)
    return counts


def _step_of(w, uni, bi, emit, move, gold, path, score, room, known) -> tuple[float, float]:
    """Changes ``w`` as ``mira_step`` does, given a wrong best path; returns the length of the step and the violation."""
    y, off = emit.shape[1], path != gold
    turned = np.flatnonzero(off[1:] | off[:-1]) + 1
    at = [[(uni[:, off] + p[off]).ravel(), (bi[:, turned] + p[turned - 1] * y + p[turned]).ravel()] for p in (gold, path)]
    at = np.concatenate(at[0] + at[1])
    by = np.repeat([1.0, -1.0], len(at) // 2)[at < known]
    at, where = np.unique(at[at < known], return_inverse=True)
    by = np.bincount(where, by, len(at))
    norm = float(by @ by)
    if not norm:
        return 0.0, 0.0
    inner = np.arange(1, len(gold))
    margin = int(off.sum()) - float(emit[np.arange(len(gold)), gold].sum() + move[inner if len(move) > 1 else 0, gold[:-1], gold[1:]].sum()) + float(score)
    full = max(0.0, margin / norm)
    step = min(full, room)
    w[at] += step * by
    return step, margin if full <= room else 0.0


def _mira_pass(weights, y: int, c: float, shrink: int, anew: bool):
    """Of a partition the numbers of its sentences, with no key, then its counts and what its weights changed by, in blocks."""

    def run(rows: Iterator) -> Iterator:
        start, counts = weights.value, np.zeros(5)
        w = _wide(start, y)
        for row, (used, right) in rows:
            used, right = used.copy(), np.zeros_like(right) if anew else right.copy()
            counts += _mira_row(w, row, y, used, right, c, shrink)
            yield None, (used, right)
        if counts[3]:
            change = (w[: len(start)] - start) * counts[3]
            at = np.flatnonzero(change)
            yield -1, (np.arange(5, dtype=np.int32), counts)
            yield from _blocks(at, change[at])

    return run


def _fresh(row) -> tuple[np.ndarray, np.ndarray]:
    n = len(row["sizes"]) // 8
    return np.zeros(n), np.zeros(n, np.int32)


def _mira(data: RDD, spark: SparkSession, model: Model, course: list, c: float, shrink: int, rounds: int) -> None:
    state, calm, before = data.map(_fresh), 0, None
    for k in range(rounds):
        # after a round without a violation all sentences are looked at again
        weights = data.context.broadcast(model.weights)
        done = data.zip(state).mapPartitions(_mira_pass(weights, len(model.tags), c, shrink, calm > 0)).persist()
        counts, change = _total(done.filter(lambda x: x[0] is not None), len(model.weights))
        stats = dict(zip(("wrong", "wrong_s", "tokens", "sents", "kkt"), counts.tolist()))
        model.weights = model.weights + change / max(1, stats["sents"])
        course.append(_step(k, stats, float(model.weights @ model.weights), model))
        calm = calm + 1 if stats["kkt"] <= 0 else 0
        state = done.filter(lambda x: x[0] is None).map(lambda x: x[1])
        if k % 8 == 7:
            state = cut_rdd(spark, state)
        if before:
            before.unpersist()
        before = done
        if calm == 2 or not stats["sents"]:
            break
    if before:
        before.unpersist()


def _sum(sentences: RDD, model: Model) -> tuple[np.ndarray, dict]:
    weights = sentences.context.broadcast(model.weights)
    counts, out = _total(sentences.mapPartitions(_partials(weights, len(model.tags))), len(model.weights))
    weights.destroy()
    return out, dict(zip(("loss", "wrong", "wrong_s", "tokens", "sents"), counts.tolist()))


class _Memory:
    """The two-loop recursion over the last ``m`` steps."""

    def __init__(self, m: int = 5):
        self.m, self.s, self.y = m, [], []

    def push(self, s: np.ndarray, y: np.ndarray) -> None:
        if s @ y > 1e-10:
            self.s, self.y = [*self.s, s][-self.m :], [*self.y, y][-self.m :]

    def direction(self, grad: np.ndarray) -> np.ndarray:
        q, a = grad.copy(), []
        for s, y in zip(reversed(self.s), reversed(self.y)):
            a.append((s @ q) / (y @ s))
            q -= a[-1] * y
        if self.s:
            q *= (self.s[-1] @ self.y[-1]) / (self.y[-1] @ self.y[-1])
        for s, y, ai in zip(self.s, self.y, reversed(a)):
            q += (ai - (y @ q) / (y @ s)) * s
        return -q


def train(
    sentences: DataFrame,
    algorithm: str = "crf-l2",
    least: int = 1,
    c: float = 1.0,
    eta: float = 1e-4,
    rounds: int = 100,
    templates: list[str] | None = None,
    shrink: int = 20,
) -> tuple[Model, list[dict]]:
    """A model of sentences ``(tokens, tags)`` and the course of its training.

    ``algorithm``: ``crf-l2``, ``crf-l1`` or ``mira``. It stops when the objective changes by less
    than ``eta`` of itself three times in a row (MIRA: after two rounds without a violated margin),
    or after ``rounds``.
    """
    if algorithm not in ("crf-l2", "crf-l1", "mira"):
        raise ValueError(f"unknown algorithm: {algorithm}")
    used = [Template(t) for t in templates or TEMPLATES]
    # in the order of a key, so that every run sees the same partitions
    order = F.xxhash64("tokens", "tags")
    data = sentences.select("tokens", "tags").repartition(order).sortWithinPartitions(order).persist()
    tags = sorted(r["t"] for r in data.select(F.explode("tags").alias("t")).distinct().collect())
    keyed = data.select(F.monotonically_increasing_id().alias("key"), F.lit(0).alias("line_no"), "tokens")
    counts = feature_counts(keyed, least, [t.text for t in used])
    feats = [r["feature"] for r in counts.select("feature").limit(MAX_FEATURES + 1).collect()]
    if len(feats) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features occur {least} times")
    ids, size = number_features(feats, len(tags))
    model, course = Model(tags, used, ids, np.zeros(size)), []
    numbered = data.mapInPandas(_number(model), _NUMBERED).rdd.persist()
    if algorithm == "mira":
        _mira(numbered, sentences.sparkSession, model, course, c, shrink, rounds)
    else:
        _quasi_newton(numbered, model, course, algorithm == "crf-l1", c, eta, rounds)
    numbered.unpersist()
    data.unpersist()
    return model, course


def _step(k: int, stats: dict, objective: float, model: Model) -> dict:
    return {
        "iteration": k,
        "objective": objective,
        "token_error": stats["wrong"] / max(1, stats["tokens"]),
        "sentence_error": stats["wrong_s"] / max(1, stats["sents"]),
        "n_active": int(np.count_nonzero(model.weights)),
    }


def _cubic(a: float, fa: float, da: float, b: float, fb: float, db: float) -> float:
    """Where the cubic through two points with their slopes is least; the middle where it has no least point between them."""
    t = da + db - 3 * (fa - fb) / (a - b)
    under = t * t - da * db
    middle = (a + b) / 2
    if under < 0:
        return middle
    root = np.sign(b - a) * np.sqrt(under)
    low = db - da + 2 * root
    x = b - (b - a) * (db + root - t) / low if low else middle
    near, far = sorted((a, b))
    return x if near + 0.05 * (far - near) <= x <= far - 0.05 * (far - near) else middle


def wolfe_step(along, value: float, slope: float, first: float = 1.0, decrease: float = 1e-4, curvature: float = 0.9, tries: int = 20):
    """A step with a sufficient decrease and a slope of at most ``curvature`` of the first: bracketed, then cut by cubics.

    ``along`` returns of a step ``(value, slope, what belongs to it)``; so does
    this, the step in front, and None if no step of ``tries`` decreases the value.
    """
    low = (0.0, value, slope, None)
    high = None
    step, best = first, None
    for _ in range(tries):
        f, d, what = along(step)
        if f <= value + decrease * step * slope and (best is None or f < best[1]):
            best = (step, f, d, what)
        if f > value + decrease * step * slope or (low[3] is not None and f >= low[1]):
            high = (step, f, d)
        elif abs(d) <= -curvature * slope:
            return step, f, d, what
        else:
            if high is None and d >= 0 or high is not None and d * (high[0] - low[0]) >= 0:
                high = low[:3]
            low = (step, f, d, what)
        step = 4 * step if high is None else _cubic(*low[:3], *high)
        if high is not None and abs(high[0] - low[0]) < 1e-12 * max(1.0, low[0]):
            break
    return best


def _quasi_newton(data: RDD, model: Model, course: list, l1: bool, c: float, eta: float, rounds: int) -> None:
    def measure(w: np.ndarray) -> tuple[float, np.ndarray, dict]:
        model.weights = w
        grad, stats = _sum(data, model)
        if l1:
            return stats["loss"] + np.abs(w).sum() / c, grad, stats
        return stats["loss"] + (w @ w) / (2 * c), grad + w / c, stats

    def pseudo(w: np.ndarray, grad: np.ndarray) -> np.ndarray:
        """Of the L1 objective, the gradient of least size where it has several."""
        if not l1:
            return grad
        up, down = grad + 1 / c, grad - 1 / c
        return np.where(w > 0, up, np.where(w < 0, down, np.where(up < 0, up, np.where(down > 0, down, 0.0))))

    def projected(w: np.ndarray, d: np.ndarray, slope: np.ndarray, value: float, step: float):
        """A step with a sufficient decrease that stays in the orthant of the start."""
        sign = np.where(w != 0, np.sign(w), -np.sign(slope))
        while step > 1e-12:
            new = np.where((w + step * d) * sign > 0, w + step * d, 0.0)
            f, grad, stats = measure(new)
            if f <= value + 1e-4 * (slope @ (new - w)):
                return f, new, grad, stats
            step /= 2
        return None

    def straight(w: np.ndarray, d: np.ndarray, slope: np.ndarray, value: float, step: float):
        def along(t: float):
            f, grad, stats = measure(w + t * d)
            return f, float(grad @ d), (grad, stats)

        found = wolfe_step(along, value, float(slope @ d), step)
        return found and (found[1], w + found[0] * d, *found[3])

    w, memory, calm = model.weights, _Memory(), 0
    value, grad, stats = measure(w)
    course.append(_step(0, stats, value, model))
    for k in range(1, rounds):
        slope = pseudo(w, grad)
        d = memory.direction(slope)
        if l1:
            d = np.where(d * -slope > 0, d, 0.0)
        if d @ slope >= 0:
            d = -slope
        step = 1.0 if memory.s else 1.0 / max(1.0, float(np.sqrt(slope @ slope)))
        found = (projected if l1 else straight)(w, d, slope, value, step)
        if not found:
            break  # nothing decreases any more
        new_value, new, new_grad, stats = found
        memory.push(new - w, new_grad - grad)
        change = abs(value - new_value) / max(abs(value), 1e-12)
        w, value, grad = new, new_value, new_grad
        model.weights = w
        course.append(_step(k, stats, value, model))
        calm = calm + 1 if change < eta else 0
        if calm >= 3:
            break
    model.weights = w
