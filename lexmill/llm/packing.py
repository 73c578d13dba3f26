"""Problem 7: documents packed into containers of fixed capacity.

Vector bin packing with the dot-product heuristic: of the items that fit, a
container takes the one whose demands (tokens, segments, loss-bearing tokens)
have the largest inner product with what the container has left of each; it is
closed when nothing fits any more.

Items are dealt to shards by a hash, each of about ``SHARD_TOKENS`` tokens, and
every shard is packed by itself: the work of a task is bounded, no source or
length can make a shard large, and a shard leaves about one container part full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import map_keyed

CAPACITY = 4096
MAX_SEGMENTS = 64
SHARD_TOKENS = 16_000_000

_PIECES = "doc_id long, piece_no int, start_byte long, tokens int, loss_tokens int"
_PACKED = "doc_id string, piece_no int, start_byte long, tokens int, loss_tokens int, shard long, bin int"


def byte_pieces(data: bytes, capacity: int, prompt: int = 0, max_loss: int | None = None) -> list[tuple[int, int]]:
    """``(start, tokens)`` of the pieces of one text, one token a byte and one at its end.

    A piece is as long as the capacity allows without cutting a character, and as
    ``max_loss`` allows of tokens after the first ``prompt``, which bear no loss.
    """
    total, start, out = len(data) + 1, 0, []
    most = capacity if max_loss is None else max_loss
    while total - start > min(capacity, max(prompt - start, 0) + most):
        end = start + min(capacity, max(prompt - start, 0) + most)
        while end > start + 1 and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append((start, end - start))
        start = end
    out.append((start, total - start))
    return out


def _split(capacity: int, max_loss: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text, prompt in zip(pdf["doc_id"], pdf["text"], pdf["prompt"]):
                for k, (start, tokens) in enumerate(byte_pieces(text.encode(), capacity, int(prompt), max_loss)):
                    rows.append((doc_id, k, start, tokens, tokens - max(0, min(int(prompt) - start, tokens))))
            yield pd.DataFrame(rows, columns=["doc_id", "piece_no", "start_byte", "tokens", "loss_tokens"])

    return split


def pieces(docs: DataFrame, capacity: int = CAPACITY, max_loss: int | None = None) -> DataFrame:
    """``(doc_id, piece_no, start_byte, tokens, loss_tokens)`` of every non-null text.

    Only a text beyond the capacity (or with more than ``max_loss`` tokens that
    bear loss) is split, and only such texts leave the JVM.
    Bytes of a leading title line bear no loss. A null text has no piece; an
    empty one has a single piece of one token; repeated ids are kept apart.
    """
    headed = F.col("title").isNotNull() & F.startswith("text", F.concat("title", F.lit("\n")))
    sized = docs.where(F.col("text").isNotNull()).select(
        "doc_id",
        "text",
        (F.octet_length("text") + 1).alias("tokens"),
        F.when(headed, F.octet_length("title") + 1).otherwise(0).alias("prompt"),
    )
    max_loss = capacity if max_loss is None else max_loss
    fits = (F.col("tokens") <= capacity) & (F.col("tokens") - F.col("prompt") <= max_loss)
    whole = sized.where(fits).select(
        "doc_id",
        F.lit(0).alias("piece_no"),
        F.lit(0).cast("long").alias("start_byte"),
        "tokens",
        (F.col("tokens") - F.col("prompt")).alias("loss_tokens"),
    )
    large = sized.where(~fits).select("doc_id", "text", "prompt")
    split = map_keyed(large, _split(capacity, max_loss), _PIECES, "doc_id")
    return whole.unionAll(split)


def pack(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: int) -> np.ndarray:
    """The container of each item.

    Items of one size wait in a stack, largest loss on top, so the inner product
    is taken over at most ``capacity`` candidates however many items there are:
    of each size the one with the largest loss that still fits.
    """
    n = len(tokens)
    if n and (tokens.max() > capacity or loss.max() > max_loss or max_segments < 1):
        raise ValueError("an item exceeds the limits of a container")
    out = np.full(n, -1, np.int32)
    order = np.lexsort((np.arange(n), loss, tokens))
    first = np.searchsorted(tokens[order], np.arange(capacity + 2))
    bottom, top = first[:-1], first[1:].copy()  # the stack of size t is order[bottom[t]:top[t]]
    waiting = loss[order]  # in the order of ``order``, rising within a stack
    sizes = np.flatnonzero(top > bottom)
    head = np.zeros(capacity + 1, np.int64)
    head[sizes] = waiting[top[sizes] - 1]
    left, b = n, -1
    while left:
        b += 1
        r_tok, r_seg, r_loss = capacity, max_segments, max_loss
        while r_seg and left:
            c = sizes[: np.searchsorted(sizes, r_tok, "right")]
            if not len(c):
                break
            h = head[c]
            below = np.flatnonzero(h > r_loss)
            if len(below):  # of these sizes a smaller loss may fit
                h = h.copy()
                for k in below:
                    t = c[k]
                    at = bottom[t] + int(np.searchsorted(waiting[bottom[t] : top[t]], r_loss, "right"))
                    h[k] = waiting[at - 1] if at > bottom[t] else -1
            score = (r_tok / capacity**2) * c + (r_loss / max_loss**2) * h + r_seg / max_segments**2
            score[h < 0] = -1.0
            k = len(c) - 1 - int(np.argmax(score[::-1]))
            if score[k] < 0:
                break
            t = int(c[k])
            at = bottom[t] + int(np.searchsorted(waiting[bottom[t] : top[t]], h[k], "right")) - 1
            item = order[at]
            top[t] -= 1
            order[at : top[t]], waiting[at : top[t]] = order[at + 1 : top[t] + 1].copy(), waiting[at + 1 : top[t] + 1].copy()
            out[item] = b
            left -= 1
            r_tok, r_seg, r_loss = r_tok - t, r_seg - 1, r_loss - int(loss[item])
            if top[t] > bottom[t]:
                head[t] = waiting[top[t] - 1]
            else:
                sizes = np.delete(sizes, np.searchsorted(sizes, t))
    return out


def _pack_shard(capacity: int, max_segments: int, max_loss: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece_no", "tokens"], kind="stable")
        bins = pack(pdf["tokens"].to_numpy(), pdf["loss_tokens"].to_numpy(), capacity, max_segments, max_loss)
        return pdf.assign(bin=bins)[["doc_id", "piece_no", "start_byte", "tokens", "loss_tokens", "shard", "bin"]]

    return run


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """A container ``(shard, bin)`` for every piece of every document.

    The limits hold for each container together: ``capacity`` tokens,
    ``max_segments`` pieces and ``max_loss`` loss-bearing tokens (by default
    the capacity, which never binds). A text that exceeds the tokens or the
    loss-bearing tokens is split. A null ``doc_id`` is packed like any other.
    """
    max_loss = capacity if max_loss is None else max_loss
    items = pieces(docs, capacity, max_loss)
    total = docs.where(F.col("text").isNotNull()).agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    # the row's place in its file parts what has no id, and copies of one id
    shard = F.pmod(F.xxhash64("doc_id", "piece_no", F.monotonically_increasing_id()), F.lit(shards)).alias("shard")
    packed = (
        items.select("*", shard)
        .withColumn("doc_id", F.col("doc_id").cast("string"))
        .groupBy("shard")
        .applyInPandas(_pack_shard(capacity, max_segments, max_loss), _PACKED)
    )
    return packed.withColumn("doc_id", F.col("doc_id").cast(dict(items.dtypes)["doc_id"]))


def split_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id`` of every document of which more than one piece was packed."""
    return pack_documents(docs, capacity).where(F.col("piece_no") == 1).select("doc_id")
