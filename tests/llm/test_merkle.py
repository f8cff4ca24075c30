"""Operator 12: multiproofs, proofs and roots against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickspark.llm import merkle
from tickspark.llm.common import id_bucket

NAMES = "doc_id long, source string, lang string, n_chars long, text string, idx string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    for level in tree[:-1]:
        run = range(i - i % 3, min(i - i % 3 + 3, len(level)))
        yield [level[j] for j in run if j != i], i % 3
        i //= 3


def plain(rows):
    def leaf(row, cut=False):
        vals = [str(v).replace("\n", "") if cut and k == 4 and v is not None else v for k, v in enumerate((row[0], *row[1:5]))]
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf(r) for r in sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            steps = [*siblings(trees[s], i), *siblings(top, k)]
            node = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0)
            for sib, place in steps:
                node = h(*sib[:place], node, *sib[place:])
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(*(d for sib, _ in steps for d in sib)), node, node == top[-1][0]))
    return sorted(out, key=str)


def got(spark, rows, **args):
    docs = spark.createDataFrame(rows, NAMES).repartition(3)
    out = merkle.manifest(docs, id_bucket(F.col("doc_id"), 2) == 0, **args)
    return out, sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
                        for r in out.collect()), key=str)


@pytest.mark.parametrize("low", [1, 2, 7])
def test_against_a_plain_tree(spark, low):
    rng = random.Random(low)
    rows = [(k, rng.choice(["a", "hot", "hot", "é", None, ""]), rng.choice(["en", None]), rng.choice([3, None]),
             rng.choice(["x\ny", "plain", "", None, "line\n" * 3, "é\n"]), "clash") for k in range(70)]
    rows += [(None, "a", None, None, None, "n"), rows[5], rows[5], (7, "one", "en", 1, "z" * 300_000 + "\n", "long")]
    out, have = got(spark, rows, low=low)
    assert have == plain(rows)
    assert {r[6] for r in have} == {True, False}


def test_steps_fold_and_empty_table(spark):
    rows = [(k, "s" if k % 4 else "t", "en", 1, f"text {k}\n", "c") for k in range(25)]
    out, have = got(spark, rows, with_steps=True)
    for r in out.collect():
        steps = [*zip(r.siblings, r.places), *zip(r.up_siblings, r.up_places)]
        assert merkle.fold(r.leaf, steps) == r.root
        assert merkle.digest([d for s, _ in steps for d in s]) == r.proof_sha256
    assert got(spark, [])[1] == []
    assert got(spark, rows[:1])[1] == plain(rows[:1])


def test_missing_nodes_are_needed_and_enough():
    rng = random.Random(9)
    for n in (1, 2, 3, 4, 10, 28, 82):
        tree = levels([h(str(i)) for i in range(n)])
        for _ in range(20):
            held = rng.sample(range(n), rng.randint(1, n))
            want = merkle.missing(held, n)
            known = {(0, i): tree[0][i] for i in held} | {(k, i): tree[k][i] for k, i in want}
            for k in range(len(tree) - 1):
                for run in {i // 3 for (level, i) in list(known) if level == k}:
                    mates = [known.get((k, i)) for i in range(run * 3, min(run * 3 + 3, len(tree[k])))]
                    if None not in mates and (k + 1, run) not in known:
                        known[k + 1, run] = h(*mates)
            assert known[len(tree) - 1, 0] == tree[-1][0]
            for i in held:
                assert all(d in known.values() for sib, _ in siblings(tree, i) for d in sib)
            # Fewest: no named node lies above a held leaf, so none can be derived from them.
            assert not any(i // 3 ** k == j for i in held for k, j in want)
            assert len(set(want)) == len(want)
