import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from proofmark.llm import tokens
from tests.llm.test_entropy_secrets import base, entropy
from tests.llm.test_host_rules import brute
from tests.llm.test_simhash_trees import brute_components, brute_fp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rows = []
    for i in range(60):
        words = [f"word{(i * 37 + j * j) % 701}" for j in range(60 + i % 5)]
        rows.append((i, " ".join(words), "en", f"s{i % 4}" if i % 9 else None, 1))
    rows.append((100, rows[3][1], "en", "s0", 1))  # a copy
    rows.append((101, rows[5][1] + " password=hunter2222", "en", "s1", 1))
    rows += [(102, "too short", "en", "s1", 1), (103, "again and again " * 60, "en", "s2", 1), (104, None, "en", "s2", 1)]
    return rows


def masked(text):
    out, at = "", 0
    for a, _, b in sorted(base(text) + entropy(text)):
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs, stored = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        stored.append(docs.collect())
        assert k == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {}
    for i, text, *_ in rows:
        n, _, _, _, repeats = brute(text)
        if n >= 50 and 100 * repeats <= 50 * n:
            kept[i] = text
    assert {r.doc_id: r.text for r in stored[0]} == kept
    linked = brute_components([(i, brute_fp(t)) for i, t in kept.items()])
    kept = {i: t for i, t in kept.items() if linked[i] == i}
    assert 100 not in kept and {r.doc_id: r.text for r in stored[1]} == kept
    kept = {i: masked(t) for i, t in kept.items()}
    assert {r.doc_id: r.text for r in stored[2]} == kept
    source = {r[0]: r[3] for r in rows}
    sizes, taken = {}, {}
    for i, t in kept.items():
        sizes[source[i]] = sizes.get(source[i], 0) + len(t.split())
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s)), [5, 2, 1] * 9))
    targets, left = {}, set(sizes)
    while left:  # the plain form of the contract: stop those above, share the rest again
        rest = 1.5 * sum(sizes.values()) - sum(targets.values())
        shares = {s: rest * weights[s] / sum(weights[x] for x in left) for s in left}
        over = {s for s in left if shares[s] > 2 * sizes[s]}
        targets |= {s: 2 * sizes[s] for s in over} if over else shares
        left = left - over if over else set()
    for r in stored[3]:
        words = kept[r.doc_id].split()
        assert r.text.split() == words[: len(r.text.split())] and r.text.split()
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    for s in sizes:
        assert abs(sum(n for i, n in taken.items() if source[i] == s) - targets[s]) <= 1
    assert all(n <= 2 * len(kept[i].split()) for i, n in taken.items())
    coder = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    ids = [(r.doc_id, coder.encode(r.text, add_special_tokens=False).ids + [0]) for r in stored[3]]
    assert sum(r.length for r in stored[4]) == sum(len(x) for _, x in ids)
    for r in stored[4]:
        cuts = [x[r.start : r.start + r.length] for i, x in ids if i == r.doc_id and len(x) == r.doc_tokens]
        assert r.ids_crc32 in {zlib.crc32(np.array(x, "<u4").tobytes()) for x in cuts}
    assert len({(r.sequence_id, r.offset) for r in stored[4]}) == len(stored[4])
    again = C.run(spark, str(tmp_path)).collect()
    assert sum(r.length for r in again) == sum(r.length for r in stored[4])


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_empty(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
