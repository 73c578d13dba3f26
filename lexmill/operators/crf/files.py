"""Model files in text and binary form, and a model's metadata.

The binary file holds a header, tags, templates, a double array that maps features
to identifiers, and the weights as single floats, all little-endian.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from lexmill.operators.crf.features import Template
from lexmill.operators.crf.model import Model, from_text, to_text

VERSION = 100
_HEAD = struct.Struct("<IidIIII")  # version, kind, cost factor, weights, columns, bytes of the array, bytes of the tags


def _children(keys: list[tuple[bytes, int]], depth: int) -> list[tuple[int, list[tuple[bytes, int]]]]:
    """Labels below a node (0 where a key ends, else its byte and 1) with the keys under each; ``keys`` are sorted."""
    out: list[tuple[int, list]] = []
    for key in keys:
        label = key[0][depth] + 1 if depth < len(key[0]) else 0
        if not out or out[-1][0] != label:
            out.append((label, []))
        out[-1][1].append(key)
    return out


def double_array(ids: dict[str, int]) -> np.ndarray:
    """``(base, check)`` of a double array: the child of a node with base ``b`` by label ``c`` lies at ``b + c`` and has ``b`` for its check.

    Where a key ends, label 0 has the base ``-id - 1``.
    """
    base, check = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
    taken, used = np.zeros(1024, bool), {0}
    taken[0] = True
    free = 1  # below it everything is taken
    waiting = [(0, sorted((f.encode(), k) for f, k in ids.items()), 0)]
    while waiting:
        at, keys, depth = waiting.pop()
        below = _children(keys, depth)
        labels = np.array([label for label, _ in below], np.int64)
        while taken[free]:
            free += 1
            if free + 600 >= len(taken):
                base, check, taken = (np.concatenate([x, np.zeros_like(x)]) for x in (base, check, taken))
        b = max(1, free - int(labels[0]))
        while True:
            if b + 600 >= len(taken):
                base, check, taken = (np.concatenate([x, np.zeros_like(x)]) for x in (base, check, taken))
            if b not in used and not taken[b + labels].any():
                break
            b += 1
        used.add(b)
        base[at] = b
        taken[b + labels] = True
        check[b + labels] = b
        for label, under in below:
            if label == 0:
                base[b] = -under[0][1] - 1
            else:
                waiting.append((b + label, under, depth + 1))
    end = int(np.flatnonzero(taken)[-1]) + 1
    return np.stack([base[:end], check[:end]], 1)


def array_features(units: np.ndarray) -> dict[str, int]:
    """The keys of a double array with their identifiers."""
    order = np.argsort(units[:, 1], kind="stable")
    checks = units[order, 1]
    out: dict[str, int] = {}
    waiting = [(int(units[0, 0]), b"")]
    while waiting:
        b, key = waiting.pop()
        for p in order[np.searchsorted(checks, b) : np.searchsorted(checks, b, "right")].tolist():
            if p == b and units[p, 0] < 0:
                out[key.decode()] = int(-units[p, 0] - 1)
            elif 0 < p - b <= 256:
                waiting.append((int(units[p, 0]), key + bytes([p - b - 1])))
    return out


def to_binary(model: Model, columns: int = 1) -> bytes:
    tags = b"".join(t.encode() + b"\0" for t in model.tags)
    ordered = sorted(model.templates, key=lambda t: not t.is_unigram)
    templates = b"".join(t.text.encode() + b"\0" for t in ordered)
    templates += b"\0" * (-(len(tags) + len(templates)) % 4)
    units = double_array(model.ids).astype("<i4").tobytes()
    head = _HEAD.pack(VERSION, 0, model.cost_factor, len(model.weights), columns, len(units), len(tags))
    return head + tags + struct.pack("<I", len(templates)) + templates + units + model.weights.astype("<f4").tobytes()


def from_binary(data: bytes) -> Model:
    version, _, cost, size, _, n_units, n_tags = _HEAD.unpack_from(data)
    if version // 100 != VERSION // 100:
        raise ValueError(f"model version is different: {version}")
    at = _HEAD.size
    tags = data[at : at + n_tags].rstrip(b"\0").decode().split("\0")
    at += n_tags
    (n_templates,) = struct.unpack_from("<I", data, at)
    at += 4
    texts = [t for t in data[at : at + n_templates].decode().split("\0") if t]
    if any(t[0] not in "UB" for t in texts):
        raise ValueError("unknown type of template")
    at += n_templates
    if len(data) != at + n_units + 4 * size:
        raise ValueError("model file is broken")
    units = np.frombuffer(data, "<i4", n_units // 4, at).reshape(-1, 2).astype(np.int64)
    weights = np.frombuffer(data, "<f4", size, at + n_units).astype(np.float64)
    return Model(tags, [Template(t) for t in texts], array_features(units), weights, cost)


def save(model: Model, path: str, text: bool = False) -> None:
    """Write the binary file, and with ``text`` its text form beside it."""
    with open(path, "wb") as f:
        f.write(to_binary(model))
    if text:
        with open(path + ".txt", "w", encoding="utf-8") as f:
            f.write(to_text(model))


def load(path: str, cost_factor: float | None = None) -> Model:
    """A model from its binary or text file."""
    with open(path, "rb") as f:
        data = f.read()
    model = from_text(data.decode()) if data.startswith(b"version:") else from_binary(data)
    return model if cost_factor is None else model.with_cost_factor(cost_factor)


def shape(spark: SparkSession, model: Model) -> DataFrame:
    """One row of metadata: tags, templates, features, weights, weights other than zero, cost factor."""
    row = (len(model.tags), len(model.templates), len(model.ids), len(model.weights), int(np.count_nonzero(model.weights)), float(model.cost_factor))
    return spark.createDataFrame([row], "ysize int, n_templates int, dsize int, maxid int, n_active int, cost_factor double")
