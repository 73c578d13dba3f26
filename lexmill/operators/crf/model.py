"""Models: tags, templates, feature identifiers, weights; text and table forms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd

from lexmill.operators.crf.features import Template, expand


@dataclass
class Model:
    """A feature's weights lie at ``ids[feature]``: one per tag for U, one per pair of tags for B."""

    tags: list[str]
    templates: list[Template]
    ids: dict[str, int]
    weights: np.ndarray
    cost_factor: float = 1.0

    def __post_init__(self):
        if not self.cost_factor > 0:
            raise ValueError("cost factor must be positive")

    def with_cost_factor(self, factor: float) -> Model:
        return Model(self.tags, self.templates, self.ids, self.weights, factor)

    def scores(self, tokens: list) -> tuple[np.ndarray, np.ndarray]:
        """Emissions ``(length, tags)`` and transitions ``(length, tags, tags)`` of a sentence.

        Unknown features score nothing.
        """
        y = len(self.tags)
        emit, move = np.zeros((len(tokens), y)), np.zeros((len(tokens), y, y))
        for i in range(len(tokens)):
            for f in expand(tokens, i, self.templates):
                k = self.ids.get(f)
                if k is None:
                    continue
                if f[0] == "U":
                    emit[i] += self.weights[k : k + y]
                else:
                    move[i] += self.weights[k : k + y * y].reshape(y, y)
        return emit * self.cost_factor, move * self.cost_factor


    def scores_of_batch(self, sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Emissions ``(places, tags)`` of all sentences end to end, and transitions ``(places or 1, tags, tags)``.

        Tokens become numbers, so that every distinct feature of the batch is made
        and looked up once; transitions that depend on no token are one matrix.
        The first place of a sentence has a transition that is not used.
        """
        code, names = pd.factorize(np.array([t for tokens in sentences for t in tokens], object))
        return self.scores_of_codes(code, [str(n) for n in names], np.array([len(s) for s in sentences], np.int64))

    def scores_of_codes(self, code: np.ndarray, names: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``scores_of_batch``, of tokens that are numbers of ``names`` already, in sentences of ``sizes``."""
        y = len(self.tags)
        emit, move = np.zeros((len(code), y)), np.zeros((1, y, y))
        for t, ids, key in self.features_of_codes(code, names, sizes):
            width = y if t.is_unigram else y * y
            rows = np.where(ids[:, None] >= 0, self.weights[np.maximum(ids, 0)[:, None] + np.arange(width)] if len(self.weights) >= width else 0.0, 0.0)
            if t.is_unigram:
                emit += rows[key]
            elif len(ids) == 1:
                move = move + rows[0].reshape(1, y, y)
            else:
                move = move + rows[key].reshape(-1, y, y)
        return emit * self.cost_factor, move * self.cost_factor

    def features_of_codes(self, code: np.ndarray, names: list[str], sizes: np.ndarray) -> Iterator[tuple[Template, np.ndarray, np.ndarray]]:
        """Of each template the identifiers of its distinct features (-1 of an unknown one), and which of them each place has."""
        names = list(names)
        ends = np.cumsum(sizes)
        last = np.repeat(ends, sizes)
        first = last - np.repeat(sizes, sizes)
        at = np.arange(len(code))

        def cells(row: int) -> np.ndarray:
            """Numbers of the tokens ``row`` places on; beyond a sentence, those of names that count the distance."""
            to = at + row
            out = code[np.clip(to, 0, len(code) - 1)].astype(np.int64)
            for k in range(1, abs(row) + 1):
                name = f"_B-{k}" if row < 0 else f"_B+{k}"
                here = to == (first - k if row < 0 else last + k - 1)
                if here.any():
                    if name not in beyond:
                        beyond[name] = len(names)
                        names.append(name)
                    out[here] = beyond[name]
            return out

        beyond: dict[str, int] = {}
        for t in self.templates:
            columns = [cells(p[0]) for p in t.pieces if not isinstance(p, str)]
            key = np.zeros(len(code), np.int64)
            for c in columns:  # pairs of numbers stay small as they are numbered anew
                key = pd.factorize(key * (len(names) + 1) + c)[0]
            distinct, where = np.unique(key, return_index=True)
            ids = np.full(len(distinct), -1, np.int64)
            for j, i in enumerate(where):
                values = iter([names[c[i]] for c in columns])
                ids[j] = self.ids.get("".join(p if isinstance(p, str) else next(values) for p in t.pieces), -1)
            yield t, ids, key


def number_features(features: list[str], n_tags: int) -> tuple[dict[str, int], int]:
    """Identifiers in byte order, with room for the weights of each."""
    ids, at = {}, 0
    for f in sorted(features, key=lambda f: f.encode()):
        ids[f] = at
        at += n_tags if f[0] == "U" else n_tags * n_tags
    return ids, at


def to_text(model: Model) -> str:
    """Header, tags, templates, features and weights, parted by blank lines."""
    head = f"version: 100\ncost-factor: {model.cost_factor:g}\nmaxid: {len(model.weights)}\nxsize: 1"
    body = "\n".join(f"{k} {f}" for f, k in sorted(model.ids.items(), key=lambda kv: kv[1]))
    weights = "\n".join(f"{w:.16g}" for w in model.weights)
    return "\n\n".join([head, "\n".join(model.tags), "\n".join(t.text for t in model.templates), body, weights]) + "\n"


def from_text(text: str) -> Model:
    head, tags, templates, body, weights = text.rstrip("\n").split("\n\n")
    options = dict(line.split(": ", 1) for line in head.split("\n"))
    ids = {f: int(k) for k, f in (line.split(" ", 1) for line in body.split("\n"))}
    w = np.array([float(x) for x in weights.split("\n")])
    if len(w) != int(options["maxid"]):
        raise ValueError("the number of weights is not that of the header")
    return Model(tags.split("\n"), [Template(t) for t in templates.split("\n")], ids, w, float(options["cost-factor"]))
