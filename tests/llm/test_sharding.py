import numpy as np
import pytest
from helpers import documents

from tidemark.llm import sharding


def test_shares_differ_by_one_slot():
    counts = np.bincount(sharding.lookup())
    assert counts.sum() == sharding.SLOTS and counts.max() - counts.min() <= 1


def test_turns_by_hand():
    names, slots = ["a", "b", "c"], 7
    orders = []
    for n in names:
        start = sharding._number(f"offset {n}") % slots
        step = sharding._number(f"stride {n}") % (slots - 1) + 1
        orders.append([(start + i * step) % slots for i in range(slots)])
    table, turn = {}, 0
    while len(table) < slots:
        slot = next(s for s in orders[turn % 3] if s not in table)
        table[slot] = turn % 3
        turn += 1
    assert sharding.lookup(names, slots).tolist() == [table[i] for i in range(slots)]


def test_leaving_shard_moves_little():
    before = sharding.lookup()
    after = sharding.lookup(sharding.SHARDS[:-1])
    stayed = before != len(sharding.SHARDS) - 1
    assert (before[stayed] == after[stayed]).mean() > 0.8


@pytest.mark.parametrize("shards, slots", [((), 7), (("a", "a"), 7), (("a", "b"), 8), (("a", "b", "c"), 2)])
def test_wrong_tables(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup(shards, slots)


def test_places(spark):
    docs = documents(spark, ["x"] * 5, [None, 1, 1, -7, 2**62]).withColumnRenamed("source", "shard")
    rows = sharding.place(docs, "doc_id").collect()
    table = sharding.lookup()
    assert len(rows) == 5 and all(r.shard == sharding.SHARDS[table[r.slot]] for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sharding.place(documents(spark, []), "doc_id").count() == 0
