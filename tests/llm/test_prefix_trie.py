"""Operator 11: every node column against a plain trie over Python lists."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickspark.llm import prefix_trie
from tickspark.llm.common import id_bucket

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def plain(rows):
    convs = {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, t in convs.items():
        t.sort(key=lambda r: (r[0], r[1], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
        convs[c] = [r[2:] for r in t]
    rebuilt = {}
    for c, t in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = convs.get(c - int(c / 100) * 0 - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        rebuilt[c] = tuple(base[:h] + t[h:])
    members = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = sorted(c for c in who if rebuilt[c] == node)
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
                    sum(len(n) == len(node) + 1 for n in below), sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in members) for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = prefix_trie.conversation_trie(turns, F.col("conv_id") - F.col("conv_id") % 100, id_bucket(F.col("conv_id"), 6), 5)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_against_a_plain_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 60), *range(-12, 0), *range(100, 140), *range(205, 240)]:
        for k in range(rng.choice([1, 2, 3, 5, 8, 8])):
            rows.append((c, rng.choice([k, k, k, None, 1]), rng.choice(["user", "assistant", None]), rng.choice(["a", "é b", "", None]), "clash"))
    rows += [(7, 50, "user", "x" * 200_000, "long"), (None, 0, "user", "lost", "null id"), *rows[:5]]
    assert got(spark, rows) == plain(rows)


def test_common_openings_and_copies(spark):
    rows = [(c, k, "u", f"t{k}" if k < 4 else f"t{c % 3}", "") for c in range(700) for k in range(6)]
    assert got(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("n", [1, 2])
def test_turnless_conversations_end_in_the_root(spark, n):
    # 201 opens with the turns of an absent conversation and keeps none of its own.
    ids = [c for c in range(201, 299) if zlib.crc32(str(c).encode()) % 6 >= n][:4]
    rows = [(c, k, "u", "t", "") for c in ids for k in range(n)]
    have = got(spark, rows)
    assert have == plain(rows) and len(have) == 1 and have[0][:4] == (min(ids), 0, None, 4)
