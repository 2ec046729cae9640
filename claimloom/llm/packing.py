"""Filling fixed-capacity containers with documents by vector bin packing.

Each item has three sizes: tokens, segments (one for each piece) and loss-bearing tokens (all but those of heading lines). A container
limits all three. The dot-product heuristic fills one container after another: of the items that still fit it takes the one whose sizes
have the largest dot product with what is left, each dimension weighted by how scarce it is. Items of equal sizes are one type with a
count, so a step looks at types, not items.

Sizes are those of a byte tokenizer: one token for each UTF-8 byte and one end token. A document is whole unless it alone exceeds the
capacity; then it is cut, between characters and at white space where there is some in the last part, into pieces that are packed like
other items. Items are dealt to shards of about SHARD_ITEMS by a hash of id and piece, so shards need no order, no task sees more than
a shard, and only ids and sizes are shuffled. At most the last few containers of a shard stay part empty.

A text whose loss-bearing tokens alone exceed their limit counts as that limit, so it has a container without others that bear loss.

Defined results: null text has the end token only; repeated deliveries of an id with the same sizes count once; empty tables give none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, SEGMENTS, SHARD_ITEMS = 4096, 32, 8192
#: no container holds more than this of loss-bearing tokens, so documents without headings are mixed with such as have some
LOSS = 4090


def cut_bytes(text: str, capacity: int) -> list[int]:
    """Byte sizes of the pieces of a text whose bytes and end token exceed the capacity; the end token goes with the last."""
    raw = text.encode("utf-8", "surrogatepass")
    out, at = [], 0
    while len(raw) - at + 1 > capacity:
        end = min(at + capacity, len(raw) - 1)  # the end token needs a piece with text
        while end > at + 1 and (raw[end] & 0xC0) == 0x80:
            end -= 1
        space = max(raw.rfind(b" ", end - capacity // 16, end), raw.rfind(b"\n", end - capacity // 16, end))
        end = space + 1 if space > at else end
        out.append(end - at)
        at = end
    return [*out, len(raw) - at]


def fill(sizes: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Container number of each item (rows of sizes) by the dot-product heuristic. An item larger than a limit counts as that limit, so
    it has a container of its own as far as that limit goes."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    sizes = np.minimum(sizes, capacity)
    types, inverse, counts = np.unique(sizes, axis=0, return_inverse=True, return_counts=True)
    inverse = inverse.ravel()
    order = np.argsort(inverse, kind="stable")
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    share = types / capacity
    weight = (share * counts[:, None]).sum(0)
    weight = weight / max(weight.max(), 1e-12)
    scaled = share * weight
    alive = np.arange(len(types))
    left_count = counts.copy()
    out = np.empty(len(sizes), np.int64)
    box = 0
    while len(alive):
        left = capacity.astype(float).copy()
        pool = alive
        while len(pool):
            pool = pool[(types[pool] <= left).all(1) & (left_count[pool] > 0)]
            if not len(pool):
                break
            best = pool[int(np.argmax(scaled[pool] @ (left / capacity)))]
            left_count[best] -= 1
            out[order[first[best] + left_count[best]]] = box
            left -= types[best]
        box += 1
        alive = alive[left_count[alive] > 0]
    return out


def items(documents: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece_no, n_pieces, tokens, segments, loss: only the oversized texts go through Python."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    heading = F.octet_length(t) - F.octet_length(F.regexp_replace(t, r"(?m)^#{1,6} [^\n]*$", ""))
    sized = documents.select(F.col(id_col).cast("long").alias("doc_id"), t.alias("t"), (F.octet_length(t) + 1).cast("long").alias("tokens"), heading.cast("long").alias("heading"))
    whole = sized.filter(F.col("tokens") <= capacity).select("doc_id", F.lit(1).alias("piece_no"), F.lit(1).alias("n_pieces"), "tokens", (F.col("tokens") - F.col("heading")).alias("loss"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["doc_id"], pdf["t"]):
                parts = cut_bytes(t, capacity)
                rows += [(i, k, len(parts), n + (k == len(parts)), n + (k == len(parts))) for k, n in enumerate(parts, 1)]
            yield pd.DataFrame(rows, columns=["doc_id", "piece_no", "n_pieces", "tokens", "loss"])

    cut = sized.filter(F.col("tokens") > capacity).select("doc_id", "t").mapInPandas(run, "doc_id long, piece_no int, n_pieces int, tokens long, loss long")
    return whole.unionByName(cut).distinct().withColumn("segments", F.lit(1).cast("long"))


def pack(documents: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY, segments: int = SEGMENTS, loss: int = LOSS) -> DataFrame:
    """container, doc_id, piece_no, n_pieces, tokens, segments, loss for each piece."""
    limits = np.array([capacity, segments, min(loss, capacity)], np.int64)
    shards = max(1, math.ceil(documents.count() / SHARD_ITEMS))
    dealt = items(documents, id_col, text_col, capacity).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(shards)))
    # by number: the packing is heavy for its bytes, and a partitioning by bytes would leave it to few tasks
    dealt = dealt.repartition(min(shards, 10 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "shard")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece_no", "tokens"], ignore_index=True)
        pdf["container"] = fill(pdf[["tokens", "segments", "loss"]].to_numpy(np.int64), limits) + (pdf["shard"].to_numpy(np.int64) << 32)
        return pdf.drop(columns="shard")

    schema = "doc_id long, piece_no int, n_pieces int, tokens long, loss long, segments long, container long"
    return dealt.groupBy("shard").applyInPandas(run, schema)
