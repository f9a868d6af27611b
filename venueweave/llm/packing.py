"""Filling fixed-capacity containers: cost-balanced packing of documents into sequences.

A document's cost is linear plus quadratic in its tokens, as that of attention is. In descending order each document
goes to the sequence of least cost that has room for it; where none has room a new one is opened. Only a text that
alone exceeds the capacity is split, into pieces of the full capacity and a rest. The pieces are dealt by hash to
shards worth a fixed number of sequences, and each shard is packed in one task: what a task holds is bounded
whatever the corpus, and at most the last of its sequences' worth of room is left over per shard.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from importlib import util

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueweave.storage import Stash

#: Weight of the quadratic term, relative to the linear one at full capacity; sequences of a shard.
QUADRATIC, SHARD_SEQUENCES = 1.0, 500
TOKENIZER = "byte_bpe_50k.tiktoken"
TOKENIZER_FOLDER = "/opt/tokenizers"


@lru_cache(maxsize=2)
def _encoding(folder: str, name: str):
    import sys

    import tiktoken

    spec = util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
    public = util.module_from_spec(spec)
    sys.modules.setdefault("public_tokenizers", public)
    spec.loader.exec_module(public)
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(f"{folder}/{name}", "rb") if line.strip())}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZER_FOLDER, name: str = TOKENIZER) -> DataFrame:
    """(key, tokens): tokens of each whole text under a public tokenizer; null and empty texts have none."""
    kind = dict(df.dtypes)[key]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(folder, name)
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "tokens": counts})

    slim = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInPandas(work, f"key {kind}, tokens bigint")


def assign(sizes: np.ndarray, capacity: int, quadratic: float = QUADRATIC) -> np.ndarray:
    """The sequence of each size; sizes in descending order, none above the capacity."""
    opened = max(1, -(-int(sizes.sum()) // capacity))
    room, cost = np.full(opened, capacity, dtype=np.int64), np.zeros(opened)
    out = np.empty(len(sizes), dtype=np.int64)
    for i, size in enumerate(sizes):
        at = int(np.argmin(np.where(room >= size, cost, np.inf)))
        if room[at] < size:
            at, room, cost = len(room), np.append(room, capacity), np.append(cost, 0.0)
        room[at] -= size
        cost[at] += size + quadratic * size * size / capacity
        out[i] = at
    return out


def pack(counts: DataFrame, capacity: int, key: str = "key", tokens: str = "tokens") -> DataFrame:
    """(key, piece, tokens, sequence): every document, in as many pieces as it needs, and the sequence of each piece.

    Documents without tokens go along at no cost; null counts count as none; rows without a key are left out; each row
    is packed, so copies are packed as often as they occur. ``capacity`` must be positive.
    """
    if capacity <= 0:
        raise ValueError("capacity must be positive")
    rows = counts.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.greatest(F.lit(0), F.coalesce(F.col(tokens), F.lit(0))).cast("bigint").alias("all"))
    last = F.greatest(F.lit(0), F.ceil(F.col("all") / capacity) - 1).cast("bigint")
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("tokens", F.least(F.lit(capacity), F.col("all") - F.col("piece") * capacity))
    total = counts.agg(F.coalesce(F.sum(tokens), F.lit(0)), F.count("*")).first()
    shards = max(1, round(total[0] / capacity / SHARD_SEQUENCES), -(-total[1] // (SHARD_SEQUENCES * 100)))
    kind = dict(rows.dtypes)["key"]

    def work(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["tokens", "key", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        frame["sequence"] = assign(frame["tokens"].to_numpy(), capacity) * shards + int(group[0])
        return frame[["key", "piece", "tokens", "sequence"]]

    dealt = pieces.select("key", "piece", "tokens", F.pmod(F.xxhash64("key", "piece"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(work, f"key {kind}, piece bigint, tokens bigint, sequence bigint")


def packed_containers(docs: DataFrame, containers: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(container_id, key, piece, tokens, sequence) for every kind of container, from one count of the tokens."""
    counts = Stash(token_counts(docs, key, text), "tokens")
    kinds = containers.filter("container_id is not null and capacity_tokens > 0").distinct().orderBy("container_id").limit(1001).collect()
    if len(kinds) > 1000:
        raise ValueError("more than 1000 kinds of containers")
    parts = [pack(counts.df, k["capacity_tokens"]).select(F.lit(k["container_id"]).alias("container_id"), F.col("key").alias(key), "piece", "tokens", "sequence") for k in kinds]
    out = parts[0] if parts else pack(counts.df.limit(0), 1).select(F.lit(0).alias("container_id"), F.col("key").alias(key), "piece", "tokens", "sequence")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
