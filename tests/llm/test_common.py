"""Word hashes: long texts in pieces equal the same words in short texts."""

import numpy as np
import pyarrow as pa

from tickspark.llm import common


def hashes(texts):
    return [h for _, h in common.hashed_words(pa.array(texts))]


def test_pieces_keep_words_whole():
    words = [f"word{k % 977}" if k % 50 else "é" * 40 for k in range(60_000)]
    words[100], words[-1] = "x" * (common._STEP + 5), "y" * (2 * common._STEP)
    text = " ".join(words)
    long, short, empty = hashes([text, "Word7 word8", None])
    assert len(text.encode()) > 4 * common._STEP and len(long) == len(words) and len(empty) == 0
    one = dict(zip(set(words), np.concatenate(hashes(list(set(words))))))
    assert [one[w] for w in words] == long.tolist()
    assert short.tolist() == [one["word7"], one["word8"]]
