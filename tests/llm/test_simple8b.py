import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from proofmark.llm import simple8b as S
from proofmark.llm import tokens


@pytest.mark.parametrize("high", [1, 2, 3, 9, 200, 3000, 32766, 32768, 49407, 65535])
def test_words_round_trip(high):
    rng = np.random.default_rng(high)
    for n in (0, 1, 2, 59, 240, 241, 5000):
        ids = rng.integers(0, high, n).astype("<u2")
        ids[rng.random(n) < 0.5] //= 50
        words = S.pack_words(ids)
        assert np.array_equal(S.unpack_words(words)[:n], ids)
        data = S.encode_block(ids, [n // 2, n - n // 2])
        got, lengths = S.decode_block(data)
        assert np.array_equal(got, ids) and lengths.sum() == n
        for first, count in ((0, n), (n // 3, n // 2), (n, 0), (max(0, n - 1), min(1, n))):
            assert np.array_equal(S.decode_range(data, first, count), ids[first : first + count])


def test_greedy_uses_the_fullest_word():
    assert len(S.pack_words(np.zeros(240, "<u2"))) == 1
    assert len(S.pack_words(np.ones(60, "<u2"))) == 1
    assert len(S.pack_words(np.full(8, 127, "<u2"))) == 1
    assert len(S.pack_words(np.full(8, S.ESCAPE, "<u2"))) == 2


def test_files_round_trip(spark):
    rnd = random.Random(2)
    texts = [None, "", " \n", "Word " * 3000, "<|endoftext|> x", "日本語 É é ½"]
    texts += [" ".join(rnd.choices(["the", "Word's", "naïve", "\t", "x1", "#"], k=rnd.randint(0, 200))) for _ in range(200)]
    rows = [(i * 7 % 601, t, "x") for i, t in enumerate(texts)] + [(7, "again", "x")] * 2 + [(None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, data string").repartition(5)
    out = S.read(S.write(docs, shard=3000, block=500), with_ids=True).collect()
    coder = Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, []).append(coder.encode(t or "", add_special_tokens=False).ids + [2])
    assert len(out) == len(rows)
    at, before = 0, -1
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids in want[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert (-1 if r.doc_id is None else r.doc_id) >= before
        before, at = -1 if r.doc_id is None else r.doc_id, at + r.n_tokens


def test_empty(spark):
    assert S.read(S.write(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
