import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from proofmark.llm import alignment as A
from proofmark.llm import tokens

FILES = tokens.path("byte_bpe_50k.json"), tokens.path("piece_bpe_32k.model")


def brute(rows):
    """Whole texts, every token against every token of the other side."""
    a, b = Tokenizer.from_file(FILES[0]), SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    back = {c: k for k, c in tokens.byte_alphabet().items()}
    out, counts = [], Counter()
    for i, text, *_ in rows:
        ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        x = [bytes(back[c] for c in a.id_to_token(k)) for k in ids]
        y = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            out.append((i, [], [], [], []))
            continue
        ends = [np.cumsum([len(t) for t in z]).tolist() for z in (x, y)]
        links = []
        for p, (e, t) in enumerate(zip(ends[0], x)):
            links += [(ids[p], ids_b[q]) for q, (f, u) in enumerate(zip(ends[1], y)) if e - len(t) < f and f - len(u) < e]
        groups, low = [], (0, 0)
        for end in sorted(set(ends[0]) & set(ends[1])):
            high = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, ids[low[0] : high[0]])) + "|" + ",".join(map(str, ids_b[low[1] : high[1]])))
            low = high
        counts.update(links)
        out.append((i, ids, ids_b, groups, links))
    most = {}
    for (_, q), n in counts.items():
        most[q] = max(most.get(q, 0), n)
    return sorted(
        (
            (
                i, len(p), len(q), len(g), len(k), sum(counts[x] == most[x[1]] for x in k), sum(counts[x] for x in k),
                hashlib.sha256(";".join(g).encode()).hexdigest() if p else "", ";".join(g),
            )
            for i, p, q, g, k in out
        ),
        key=repr,
    )


def corpus():
    rnd = random.Random(8)
    words = ["the", "Word's", "naïve", "日本語", "x1", "<|endoftext|>", "<s>", "a\nb", "2024-11-05", "über.", "don't", "😀!", "\x00", "\x1c", "été,", "#"]
    texts = [None, "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "a▁b", "▁", "a  b", "a　b", "x\x85 y", "́a", "﻿a", "-" * 500, "a" * 3000, "<0x41>", "é ​ z"]
    for _ in range(160):
        gap = rnd.choice([" ", " ", " ", "  ", " \n", "\n", "\t"])
        texts.append("".join(rnd.choice(words) + rnd.choice([" ", " ", " ", gap]) for _ in range(rnd.randint(0, 60))).rstrip(rnd.choice([" ", "x"])))
    rows = [(k * 7 % 1009, t, "x", 1) for k, t in enumerate(texts)]
    return rows + rows[30:34] + [(None, texts[50], "x", 1)]


@pytest.mark.parametrize("cache,pairs", [(A.CACHE, A.PAIRS), (20_000, 100)])
def test_align_equals_brute_force(spark, cache, pairs):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, groups int").repartition(4)
    out = sorted((tuple(r) for r in A.align(docs, *FILES, pairs_at_once=pairs, cache=cache, with_groups=True).collect()), key=repr)
    assert out == brute(rows) and sum(r[1] == 0 for r in out) > 3


def test_common_ends():
    rnd = random.Random(1)
    for n, m in [(0, 0), (0, 5), (1, 1), (1, 1000), (40, 3), (300, 300), (5, 2000)]:
        x, y = (sorted(rnd.sample(range(3000), k)) for k in (n, m))
        both = sorted(set(x) & set(y))
        ranks = A.common_ends(np.array(x, int), np.array(y, int))
        assert [r.tolist() for r in ranks] == [[x.index(v) for v in both], [y.index(v) for v in both]]


def test_pieces_are_as_whole_texts():
    """Cutting at single spaces changes no token."""
    both = A.Tokenizers.of(*FILES)
    for _, text, *_ in corpus():
        if text and both.encode(text) is not None:
            pieces = A.Pieces(both)
            ranks, _ = pieces.ranks([text])
            a, b = both.encode(text)
            assert pieces.numbers[ranks].sum(axis=0)[:2].tolist() == [len(a), len(b)]


def test_a_long_text_and_an_empty_table(spark):
    text = "\n\n".join(f"word{k} and" for k in range(60_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = A.align(docs, *FILES).first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups
    assert A.align(docs.limit(0), *FILES).collect() == []
