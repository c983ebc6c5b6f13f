"""The conversation trie against a plain one, its shards, and the message queue."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from usagelake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, as_they_are=False):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    paths = {}
    for c, t in own.items():
        h = 0 if as_they_are else crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - c % 100, [])[:h] + t[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if paths[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, ids, long=0):
    """Turns that repeat, common first turns, equal conversations, null and tied turns."""
    rng = random.Random(seed)
    said = [None, "", "hello", "\U0001F600 ünï", "a longer turn of a conversation"]
    rows = []
    for c in ids:
        n = rng.choice([0, 1, 2, 5, 8]) if rng.random() < 0.7 else 3
        turns = [(c, None if rng.random() < 0.05 else i // rng.choice([1, 1, 1, 2]), rng.choice(["user", "assistant", None]),
                  "first" if i == 0 and rng.random() < 0.5 else rng.choice(said)) for i in range(n)]
        if rng.random() < 0.3:
            turns = [(c, i, "user", "same") for i in range(6)]
        rows += turns or [(c, None, None, None)]
    rows += [(max(ids) + 1, i, "user", f"turn {i % 50}") for i in range(long)]
    rng.shuffle(rows)
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def nodes(spark, rows, shard):
    own = trie.staged(trie.turns(spark.createDataFrame(rows, SCHEMA)), "turns")
    return found(trie.prefix_trie(trie.rebuilt(own), shard))


@pytest.mark.parametrize("shard", [3, 4096])
def test_equals_a_plain_trie(spark, shard):
    rows = conversations(3, [*range(0, 60), *range(100, 130), *range(250, 260), -7, -120, 10**12], long=700)
    assert nodes(spark, rows, shard) == plain(rows)


def test_conversations_as_they_are(spark):
    rows = conversations(8, range(90))
    own = trie.staged(trie.turns(spark.createDataFrame(rows, SCHEMA)), "turns")
    assert found(trie.prefix_trie(trie.whole(own), 5)) == plain(rows, as_they_are=True)


def test_one_common_conversation(spark, monkeypatch):
    """Most conversations are equal; the ids that end at one node make many chunks."""
    monkeypatch.setattr(trie, "IDS_PER_CHUNK", 7)
    rows = [(c, i, "user", f"t{i}") for c in range(0, 100000, 100) for i in range(4)] + conversations(1, range(1, 40))
    assert nodes(spark, rows, 20) == plain(rows)


def test_odd_and_empty_tables(spark):
    rows = [(None, 1, "user", "no conversation"), (5, None, None, None), (5, 2, "user", "x" * 100_000), (5, 2, "user", "x" * 100_000),
            (0, 1, None, "a"), (0, 1, "", "a"), (0, None, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("c", "pos", "h1", "depth", "n_convs")})
    assert found(trie.op13(df)) == plain(rows)
    assert trie.op13(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=120), st.integers(2, 9))
def test_queue_gives_all_messages_in_order(messages, limit):
    queue, want = trie.MessageQueue(limit), defaultdict(list)
    for i, (address, send) in enumerate(messages):
        queue.push((address, i, send))
        want[address].append((address, i, send))
    assert len(queue) == len(messages) and len(queue.heap) <= limit + 1 + len(queue.runs)
    for address in range(10):
        assert list(queue.take((address,))) == sorted(want[address])
        if address < 9:  # a message sent while others are read
            queue.push((9, 1000 + address, 0))
            want[9].append((9, 1000 + address, 0))
    assert len(queue) == 0
