"""Operator 1 against brute force over all segmentations and the contract's base score."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.llm.common import id_bucket
from tickspark.llm.lattice import Lattice
from tickspark.llm.lattice_lm import score_documents, tokens

FIRST = {b"": 0.2, b"a": 0.3, b"ab": 0.5, b"abc": 0.4}
INNER = {b"a": 0.1, b"b": 0.3, b"c": 0.2, b"bc": 0.5, b"ca": 0.4}


def brute(word):
    f, n, end = sum(FIRST.values()), sum(INNER.values()), 0.25

    def inner(rest):
        if not rest:
            return end
        return sum(INNER.get(rest[:k], 0) / n * (1 - end) * inner(rest[k:]) for k in range(1, len(rest) + 1))

    return sum(p / f * inner(word[len(k):]) for k, p in FIRST.items() if word.startswith(k))


def test_lattice_sums_all_segmentations():
    lattice = Lattice(FIRST, INNER)
    words = [bytes(w) for n in range(6) for w in itertools.product(b"abc", repeat=n)]
    got = np.exp(lattice.log_prob(words))
    assert got == pytest.approx([brute(w) for w in words], rel=1e-9, abs=1e-300)


def test_expected_ends_and_arcs():
    lattice = Lattice(FIRST, INNER)
    a, b, ends = lattice.expect([b"abc", b"ab", b"ca"], np.array([2.0, 1.0, 1.0]))
    assert ends == 4.0
    assert a.sum() == pytest.approx(4.0)  # each word has one initial arc
    lengths = sum(c * len(k) for c, k in zip(a, FIRST)) + sum(c * len(k) for c, k in zip(b, INNER))
    assert lengths == pytest.approx(2 * 3 + 2 + 2)  # arcs cover every byte once


def test_base_score_follows_the_contract(docs_of):
    texts = ["The cat the  CAT", "a dog\x0b\x85b", None, "", "the dog dog", "rare words here", "The cat"] * 3
    ids = [*range(20), None]
    rows = score_documents(docs_of(texts, ids), id_bucket(F.col("doc_id"), 5) == 1).collect()
    train = Counter()
    for i, t in zip(ids, texts):
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            train.update(tokens(t.encode() if t else None))
    n, v = train.total(), len(train)
    assert len(rows) == len(texts)
    for r in rows:
        if r.doc_id is None:
            continue
        own = tokens((texts[r.doc_id] or "").encode())
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(train[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + .5) / (n + .5 * (v + 1))) for w in own))
        assert r.score < 0


def test_joined_and_broadcast_words_agree(docs_of):
    texts = ["one two two three", "two three four four four", "five", "one one"] * 5
    args = dict(held_out=F.col("doc_id") % 4 == 1)
    a = {r.doc_id: r for r in score_documents(docs_of(texts), **args).collect()}
    b = {r.doc_id: r for r in score_documents(docs_of(texts), dict_share=1, **args).collect()}
    for i, r in a.items():
        assert (b[i].n_tokens, b[i].n_known) == (r.n_tokens, r.n_known)
        assert b[i].score == pytest.approx(r.score) and b[i].base_score == pytest.approx(r.base_score)


def test_empty_table(docs_of):
    assert score_documents(docs_of([]), F.lit(False)).collect() == []
