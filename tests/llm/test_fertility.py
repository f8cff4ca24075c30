"""Operator 6: base measures against plain Python, and the bands."""

import random
import re

import pytest

from tickspark.llm.common import tokenizer_file
from tickspark.llm.fertility import Pieces, judge_documents, measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    hit = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_measures_equal_brute_force():
    pieces, rng = Pieces(tokenizer_file("piece_bpe_32k.model")), random.Random(2)
    texts = [None, "", " \n\t", "a b c a b c", "x x x x", "é\u00a0ü 漢字 \x85 #*|<>$%&\n\n q\nq\nq \n", "one"]
    texts += ["".join(rng.choice("ab#|\n \x0b") for _ in range(rng.randrange(120))) for _ in range(200)]
    for t in texts:
        assert measure(t, pieces)[:5] == brute(t), repr(t)


def test_words_split_like_whole_texts():
    pieces = Pieces(tokenizer_file("piece_bpe_32k.model"))
    text = "the quick brown fox über straße 漢字 jumps #!? thntblere ouauxle"
    whole = pieces.model.encode(text)
    assert [i for w in pieces.of(text.encode().split()) for i in w.tolist()] == whole


def test_bands_reject_odd_texts(docs_of):
    rng = random.Random(4)
    words = "the of and to in is that it was for on are with as his they be at one have this from".split()
    good = [" ".join(rng.choices(words, k=rng.randrange(60, 400))) for _ in range(300)]
    odd = [" ".join("".join(rng.choice("漢字仮名交文章") for _ in range(6)) for _ in range(200)), " ".join(f"{rng.getrandbits(64):x}" for _ in range(200))]
    texts = good + odd + ["too short", None, "rep eat ed " * 100]
    rows = {r.doc_id: r for r in judge_documents(docs_of(texts)).collect()}
    assert len(rows) == len(texts)
    assert all(rows[i].kept for i in range(300))
    assert [(rows[300 + k].base_failed, rows[300 + k].kept) for k in range(5)] == [(False, False)] * 2 + [(True, False)] * 3
    assert rows[300].byte_share > 0 and rows[303].chars_per_token is None


def test_null_language_and_empty_table(docs_of):
    text = " ".join(f"w{k}" for k in range(60))
    rows = judge_documents(docs_of([text, text], langs=[None, "en"])).collect()
    assert len(rows) == 2 and all(r.kept for r in rows)
    assert judge_documents(docs_of([])).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5])
def test_short_repeats(n):
    pieces = Pieces(tokenizer_file("piece_bpe_32k.model"))
    assert measure("a " * n, pieces)[4] == brute("a " * n)[4]
