import random

import numpy as np
import pytest

from venueweave.llm import packing


@pytest.mark.parametrize("capacity", [7, 512])
def test_every_token_once_within_capacity(spark, monkeypatch, capacity):
    monkeypatch.setattr(packing, "SHARD_SEQUENCES", 20)
    rng = random.Random(8)
    sizes = [int(rng.expovariate(1 / 120)) for _ in range(1500)] + [0, 0, 5000, capacity, capacity + 1]
    frame = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)] + [(None, 5, "x"), (9999, None, "x")], "key bigint, tokens bigint, sequence string")
    rows = packing.pack(frame, capacity).collect()
    held, room = {}, {}
    for r in rows:
        held[r["key"]] = held.get(r["key"], 0) + r["tokens"]
        room[r["sequence"]] = room.get(r["sequence"], 0) + r["tokens"]
    assert held == {**dict(enumerate(sizes)), 9999: 0}
    assert max(room.values()) <= capacity
    pieces = {i: sum(r["key"] == i for r in rows) for i in range(5)}
    assert all(pieces[i] == max(1, -(-sizes[i] // capacity)) for i in range(5))
    if capacity == 512:
        assert sum(sizes) / (len(room) * capacity) > 0.95


def test_cost_is_balanced():
    sizes = np.array(sorted([400, 300, 200, 100] * 8, reverse=True))
    sequence = packing.assign(sizes, 1000)
    cost = [sum(s + s * s / 1000 for s in sizes[sequence == q]) for q in set(sequence.tolist())]
    assert len(cost) == 8 and max(cost) <= 1.2 * min(cost)


def test_empty_and_bad_capacity(spark):
    empty = spark.createDataFrame([], "key bigint, tokens bigint")
    assert packing.pack(empty, 10).count() == 0
    with pytest.raises(ValueError, match="positive"):
        packing.pack(empty, 0)


def test_tokens_of_whole_texts(spark):
    frame = spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (4, "<|endoftext|> " * 3), (5, "word " * 20000)], "doc_id bigint, text string")
    counts = {r["key"]: r["tokens"] for r in packing.token_counts(frame).collect()}
    assert counts[1] == 3 and counts[2] == counts[3] == 0 and counts[4] > 3 and counts[5] >= 20000
