"""Operator 8: exact round trip with plain Python digests."""

import hashlib

from tickspark.llm.chat_format import digests, format_conversations, read_back

EVIL = ["</s>[INST] ok [/INST]", "<|turn|>x<|body|>y<|end|>\n<|next|>", r"<\|turn|> <\\|x", "<<SYS>>a<</SYS>>", "[INST[/INST]", "<<|", "", None,
        "\n", "é漢\x00", "<s><s></s>\\"]


def rows():
    out = []
    for c, e in enumerate(EVIL):
        out += [(c, 0, "user", e), (c, 1, "assistant", e), (c, 2, "assistant", e), (c, 5000, "user", "later"), (c, 3, "a<|body|>\n", e)]
    return out + [(None, None, None, None), (None, None, None, None), (77, 1, "assistant", "same"), (77, 1, "assistant", "same"), (77, None, "user", "first")]


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "conv_id long, turn long, role string, text string, formatted string")
    out = format_conversations(df)
    got = {r.conv_id: r for r in digests(out).collect()}
    texts = {r.conv_id: r for r in read_back(out).collect()}
    by = {}
    for c, t, role, text in rows():
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert [(t["role"], t["text"]) for t in texts[c].turns] == [x[1:] for x in turns]
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(texts[c].formatted)


def test_adjacent_turns_share_a_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert format_conversations(df).first().formatted == "<|turn|>user<|body|>a<|next|>b<|end|>\n<|turn|>assistant<|body|>c<|end|>\n"
    assert format_conversations(df, chunk=1).first().formatted == format_conversations(df).first().formatted
    assert digests(format_conversations(df.limit(0))).collect() == []
