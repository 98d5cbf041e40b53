"""Problem 9: fill containers of fixed capacity with items of several dimensions.

Vector bin packing by the dot-product heuristic: into the open container goes the item that fits in all
dimensions (tokens, segments, loss-bearing tokens) and whose size has the largest dot product with the
room left, weighted by how scarce a dimension is. Items are grouped by their share of loss-bearing tokens;
in a group the product grows with the size, so a choice looks at one size of each group. An item above the capacity is split into full containers' worth and a remainder;
no other is split.

Items are spread over blocks by a hash of their id; each block is packed for itself and leaves at most one
container badly filled, so the loss is bounded by one container a block, while no task holds more than a
block's sizes, however many items a source or a size has.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.tokens import TOKENIZER_DIR, token_counts

#: Items of one block, about: enough small ones to fill gaps, little enough for one task.
BLOCK_ITEMS = 20_000
#: Specifications are sent to all tasks; more than this are refused.
MOST_SPECS = 10_000
#: A container holds at most so many items (segments) if the specification names no limit.
MOST_SEGMENTS = 1 << 30


#: Items are grouped by the share of their tokens that bears loss, so finely; in a group the dot product grows with the size.
SHARES = 16


class _Group:
    """Sizes of alike loss share in ascending order, each with the items left of it."""

    def __init__(self, size: np.ndarray, loss: np.ndarray, items: list[list[int]], least_share: float):
        self.size, self.loss, self.items, self.least_share = size.tolist(), loss.tolist(), items, least_share
        self.lower = list(range(len(items) + 1))  # of place + 1: the next place at or below that has items left, plus 1

    def _find(self, i: int) -> int:
        root = i
        while self.lower[root] != root:
            root = self.lower[root]
        while self.lower[i] != root:
            self.lower[i], i = root, self.lower[i]
        return root

    def best(self, room: int, loss_room: int) -> int:
        """The place of the largest size that fits; -1 if there is none."""
        most = room if self.least_share * room <= loss_room else min(room, int(loss_room / self.least_share) + 1)
        i = self._find(bisect_right(self.size, most))
        while i and self.loss[i - 1] > loss_room:
            i = self._find(i - 1)
        return i - 1

    def take(self, place: int) -> int:
        item = self.items[place].pop()
        if not self.items[place]:
            self.lower[place + 1] = place
        return item


def pack(tokens: np.ndarray, loss: np.ndarray, capacity: int, segments: int = MOST_SEGMENTS, loss_capacity: int | None = None) -> np.ndarray:
    """The container of each item, numbered from 0. Items of no tokens go into the first container with room.

    Every item must fit an empty container in all dimensions.
    """
    loss_capacity = capacity if loss_capacity is None else loss_capacity
    n = len(tokens)
    out = np.full(n, -1, dtype=np.int64)
    if not n:
        return out
    if int(tokens.max()) > capacity or int(loss.max()) > loss_capacity or segments < 1:
        raise ValueError("an item doesn't fit an empty container")
    share = np.minimum(loss * SHARES // np.maximum(tokens, 1), SHARES).astype(np.int64)
    groups = []
    for g in np.unique(share):
        at = np.flatnonzero(share == g)
        sizes, which = np.unique(np.stack([tokens[at], loss[at]], axis=1), axis=0, return_inverse=True)
        order = np.argsort(which, kind="stable")[::-1]
        items = [x.tolist() for x in np.split(at[order], np.cumsum(np.bincount(which)[::-1])[:-1])][::-1]
        groups.append(_Group(sizes[:, 0], sizes[:, 1], items, g / SHARES))
    total = np.array([tokens.sum() / capacity, n / segments, loss.sum() / max(loss_capacity, 1)])
    scarce = total / total.sum() if total.sum() else np.ones(3) / 3
    per_token, per_loss = float(scarce[0]) / capacity**2, float(scarce[2]) / max(loss_capacity, 1) ** 2
    container, open_left = 0, n
    while open_left:
        room, count, loss_room = int(capacity), segments, int(loss_capacity)
        while open_left and count:
            # the dot product of an item's size with the room left; its third part, one segment, is alike for all items
            a, b = per_token * room, per_loss * loss_room
            best, place, most = None, -1, -1.0
            for g in groups:
                i = g.best(room, loss_room)
                if i >= 0 and (dot := a * g.size[i] + b * g.loss[i]) > most:
                    best, place, most = g, i, dot
            if best is None:
                break
            out[best.take(place)] = container
            room -= best.size[place]
            loss_room -= best.loss[place]
            count -= 1
            open_left -= 1
        container += 1
    return out


def pieces(sizes: DataFrame, specs: DataFrame, id_col: str) -> DataFrame:
    """(spec_id, capacity, segments, loss_capacity, id, piece_no, tokens, loss): items above a capacity are cut, all others are one piece.

    ``sizes`` has the id, the share of an item's tokens, at its end, that bears loss, and a column n_<tokenizer> for each
    tokenizer of ``specs``. Tokens without loss come first, so that the pieces of an item bear it from the end on; a piece
    bears no more than a container may hold.
    """
    names = [c[2:] for c in sizes.columns if c.startswith("n_")]
    long = sizes.select(F.col(id_col).alias("k"), "share", F.explode(F.create_map(*(x for n in names for x in (F.lit(n), F.col(f"n_{n}"))))).alias("tokenizer", "n"))
    x = long.join(F.broadcast(specs), "tokenizer")
    cap = F.least(F.col("capacity_tokens"), F.greatest(F.col("loss_capacity"), F.lit(1)))  # a piece of loss only fits, too
    cap = F.when(F.col("n") * F.col("share") > F.col("loss_capacity"), cap).otherwise(F.col("capacity_tokens"))
    count = F.greatest(F.lit(1), F.ceil(F.col("n") / cap)).cast("int")
    x = x.withColumns({"cap": cap, "free": F.col("n") - F.round(F.col("n") * F.col("share")).cast("bigint")})
    x = x.select("spec_id", F.col("capacity_tokens").alias("capacity"), "segments", "loss_capacity", "k", "n", "cap", "free", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece_no"))
    start = F.col("piece_no") * F.col("cap")
    tokens = F.least(F.col("cap").cast("bigint"), F.col("n") - start)
    x = x.withColumn("tokens", tokens)
    loss = F.col("tokens") - F.greatest(F.lit(0), F.least(F.col("tokens"), F.col("free") - start))
    return x.select("spec_id", "capacity", "segments", "loss_capacity", "k", "piece_no", "tokens", loss.cast("bigint").alias("loss"))


def limits(specs: DataFrame) -> DataFrame:
    """Specifications with their limits: columns segments and loss_capacity where they have them, else none but the tokens'."""
    has = lambda name, otherwise: F.coalesce(F.col(name), otherwise) if name in specs.columns else otherwise
    return specs.select("spec_id", "tokenizer", "capacity_tokens", has("segments", F.lit(MOST_SEGMENTS)).cast("int").alias("segments"), has("loss_capacity", F.col("capacity_tokens")).cast("int").alias("loss_capacity"))


def fill(docs: DataFrame, specs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_dir: str = TOKENIZER_DIR, loss_col: str | None = None, rows: int | None = None) -> DataFrame:
    """(spec_id, id, piece_no, tokens, loss, container): the container of each piece of each text, for each specification.

    ``specs`` has spec_id, tokenizer and capacity_tokens, and may have segments and loss_capacity, the most items and
    loss-bearing tokens of a container (null: no limit). ``loss_col`` is the share of a text's tokens, at its end, that
    bears loss; without it, and where it is null, all do. An item is split only if it exceeds the capacity or by itself
    bears more loss than a container may hold. Containers are named ``block-number`` within a specification. Null and
    empty texts have 0 tokens and are placed, too; repeated rows are placed each; other columns are left out; no
    documents or no specifications give an empty result.
    """
    if specs.count() > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} container specifications")
    names = sorted({r[0] for r in specs.select("tokenizer").distinct().collect()})
    kind = docs.schema[id_col].dataType.simpleString()
    if not names:
        return docs.sparkSession.createDataFrame([], f"spec_id int, `{id_col}` {kind}, piece_no int, tokens bigint, loss bigint, container string")
    share = F.lit(1.0) if loss_col is None else F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col(loss_col).cast("double"), F.lit(1.0))))
    sizes = token_counts(docs.select(F.struct(F.col(id_col).alias("k"), share.alias("share")).alias("key"), F.col(text_col).alias("t")), "key", "t", names, tokenizer_dir)
    sizes = sizes.select(F.col("key.k").alias("k"), F.col("key.share").alias("share"), *(f"n_{n}" for n in names))
    blocks = max(1, -(-(docs.count() if rows is None else rows) // BLOCK_ITEMS))
    parts = pieces(sizes, limits(specs), "k").withColumn("block", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int"))

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["k", "piece_no"], kind="stable")
        tokens, loss = frame["tokens"].to_numpy(dtype=np.int64), frame["loss"].to_numpy(dtype=np.int64)
        at = pack(tokens, loss, *(int(frame[x].iloc[0]) for x in ("capacity", "segments", "loss_capacity")))
        frame["container"] = [f"{b}-{c}" for b, c in zip(frame["block"], at)]
        return frame[["spec_id", "k", "piece_no", "tokens", "loss", "container"]]

    done = parts.groupBy("spec_id", "block").applyInPandas(work, f"spec_id int, k {kind}, piece_no int, tokens bigint, loss bigint, container string")
    return done.withColumnRenamed("k", id_col)


def usage(filled: DataFrame, specs: DataFrame) -> DataFrame:
    """(spec_id, containers, tokens, filled, segments_filled, loss_filled): the containers used and the share filled in each dimension (null: no limit)."""
    each = filled.groupBy("spec_id", "container").agg(F.sum("tokens").alias("tokens"), F.sum("loss").alias("loss"), F.count("*").alias("items"))
    sums = each.groupBy("spec_id").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.sum("loss").alias("loss"), F.sum("items").alias("items"))
    x = sums.join(limits(specs), "spec_id")
    part = lambda used, room: F.col(used) / (F.col("containers") * F.col(room))
    return x.select(
        "spec_id", "containers", "tokens", part("tokens", "capacity_tokens").alias("filled"), F.when(F.col("segments") < MOST_SEGMENTS, part("items", "segments")).alias("segments_filled"), part("loss", "loss_capacity").alias("loss_filled")
    )
