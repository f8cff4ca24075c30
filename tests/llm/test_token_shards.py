"""Operator 9: the permutation, and shards read back against a plain tokenisation."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickspark.llm import common, token_shards
from tickspark.llm.common import tokenizer_file
from tickspark.llm.token_shards import Tokens, feistel, materialise, read_shards, read_slots, slots_of

TEXTS = ["The cat  sat\non the mat.", None, "", "word " * 3000, "é漢字 <|endoftext|> \t\n x", "same", "same", "  lead", "tail  "]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    got = feistel(np.arange(n), n, 99)
    assert sorted(got.tolist()) == list(range(n))
    if n > 100:
        assert (got != feistel(np.arange(n), n, 98)).any() and abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.2


def test_windows_hold_their_numbers():
    got = slots_of(np.arange(1000), 1000, 5, 64)
    assert sorted(got.tolist()) == list(range(1000)) and (got // 64 == np.arange(1000) // 64).all()


def test_shards_hold_every_token(spark, docs_of, tmp_path):
    docs = docs_of(TEXTS, [*range(8), None])
    docs.coalesce(2).write.parquet(str(tmp_path / "docs"))
    tokens = Tokens(tokenizer_file("byte_bpe_50k.tiktoken"))
    want = {i if i < 8 else None: tokens.of(t) for i, t in enumerate(TEXTS)}
    assert all(tokens.text(ids) == (TEXTS[i] or "") for i, ids in want.items() if i is not None)
    out = str(tmp_path / "shards")
    made = materialise(spark.read.parquet(str(tmp_path / "docs")), out, seq_len=16, shard_slots=50)
    rows = made.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and sorted(r.number for r in rows) == list(range(len(rows)))
    assert all(r.shard == r.slot // 50 and r.byte_offset == (r.slot % 50) * (16 + 32) for r in rows)
    got = {}
    for r in sorted(read_shards(spark, out, 16, 50).collect(), key=lambda r: r.part):
        got[r.doc_id] = got.get(r.doc_id, []) + list(r.ids)
    assert got == want
    some = read_slots(out, 45, 20, 16, 50)  # over a shard boundary
    place = {r.slot: (r.doc_id, r.part, r.n_tokens) for r in rows}
    for k, rec in enumerate(some):
        assert place[45 + k] == (int(rec["doc_id"]) if rec["doc_id"] >= 0 else None, int(rec["part"]), int(rec["length"]))


def test_same_slots_at_any_partitioning(spark, docs_of, tmp_path):
    docs_of([f"text {k} " * (k % 7 + 1) for k in range(60)]).coalesce(1).write.option("parquet.block.size", 1024).parquet(str(tmp_path / "docs"))
    src = spark.read.parquet(str(tmp_path / "docs"))
    one = {(r.doc_id, r.part): r.slot for r in materialise(src, str(tmp_path / "a"), seq_len=8).collect()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        two = {(r.doc_id, r.part): r.slot for r in materialise(spark.read.parquet(str(tmp_path / "docs")), str(tmp_path / "b"), seq_len=8).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert one == two


def test_empty_table(spark, docs_of, tmp_path):
    assert materialise(docs_of([]), str(tmp_path / "none")).collect() == []


def test_tokens_of_many_texts_are_those_of_each():
    rng = random.Random(5)
    marks = [" ", " ", "\n", "\t", " ", " ", "　", "\x1c", "\x85", "a", "bc", "é", "漢", "​", "1", "'s", "Â", "<|endoftext|>"]
    texts = [*TEXTS, *("".join(rng.choices(marks, k=rng.randrange(12))) for _ in range(3000))]
    tokens = Tokens(tokenizer_file("byte_bpe_50k.tiktoken"))
    for part in (texts, [None], [""], []):
        ids, bounds = tokens.many(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [tokens.of(t) for t in part]
        assert tokens.counts(pa.array(part, pa.string())).tolist() == np.diff(bounds).tolist()


def test_token_ids_are_written_to_shards_only(spark, docs_of, tmp_path, monkeypatch):
    docs_of([f"text {k} " * (k % 9) for k in range(50)]).write.parquet(str(tmp_path / "docs"))
    seen = []
    monkeypatch.setattr(token_shards, "stored", lambda df, name: seen.append(df.columns) or common.stored(df, name))
    rows = materialise(spark.read.parquet(str(tmp_path / "docs")), str(tmp_path / "out"), seq_len=8).collect()
    assert seen and not any("ids" in columns or "text" in columns for columns in seen)
    assert sorted(r.number for r in rows) == list(range(len(rows)))


def test_numbers_follow_the_table_where_rows_are_left_out(spark, docs_of, tmp_path):
    docs_of([f"text {k} " * (k % 5) for k in range(5000)]).coalesce(1).write.parquet(str(tmp_path / "docs"))
    for docs in (spark.read.parquet(str(tmp_path / "docs")).where("doc_id % 3 = 1"),
                 spark.read.parquet(str(tmp_path / "docs")).where("doc_id % 3 = 1").coalesce(1).select("doc_id", F.upper("text").alias("text"))):
        rows = sorted(materialise(docs, str(tmp_path / f"out{len(docs.columns)}"), seq_len=8).collect(), key=lambda r: r.number)
        assert [r.number for r in rows] == list(range(len(rows))) and len({r.doc_id for r in rows}) == 1667
        assert [(r.doc_id, r.part) for r in rows] == sorted((r.doc_id, r.part) for r in rows)
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
