import random
import re
from collections import Counter

from pyspark.sql import functions as F

from proofmark.llm import host_rules as H

SCHEMA = "doc_id long, text string, source string, n_words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def corpus():
    rnd = random.Random(5)
    texts = [None, "", " \n\t", "a b c a b c", "x " * 4000, "é b #<>\nb\nb\n\nb"]
    for _ in range(120):
        words = rnd.choices("alpha beta gamma delta of the 😀 #tag".split(), k=rnd.randint(1, 90))
        texts.append("".join(w + rnd.choice([" ", "\n", "\t ", "\x0b"]) for w in words))
    for _ in range(80):
        texts.append(" ".join(rnd.choices([f"word{i}" for i in range(900)], k=rnd.randint(50, 90))))
    rows = [(i, t, rnd.choice(["a", "b", None]), "clash") for i, t in enumerate(texts)]
    junk = ["#" * 5 + f"w{i} " + " ".join(f"n{i}{j} |" for j in range(60)) for i in range(40)]
    rows += [(1000 + i, t, "bad", "clash") for i, t in enumerate(junk)]
    rows += [(2000, " ".join(f"clean{j}" for j in range(70)), "bad", "clash"), rows[8], rows[8]]
    return rows


def test_measures_and_verdicts(spark):
    rows = corpus()
    out = H.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        assert tuple(r[m] for m in H.MEASURES) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    by_id = {r.doc_id: r for r in out}
    assert not any(by_id[1000 + i].kept for i in range(40))  # strict rules count on the bad host
    assert by_id[2000].kept and by_id[2000].host_failed  # a clean document stays there


def test_prior_shrinks_small_hosts(spark):
    judged = spark.createDataFrame(
        [("big", i < 20, False) for i in range(100)] + [("other", i < 60, False) for i in range(100)] + [("one", True, False)],
        "source string, base_failed boolean, strict_failed boolean",
    )
    rate = {r._host: r.rate for r in H.host_verdicts(judged, F.col("source")).collect()}
    assert abs(rate["big"] - 0.2) < 0.05 and abs(rate["other"] - 0.6) < 0.05
    assert 0.4 < rate["one"] < 0.8  # one failure is no rate of 1


def test_keep_returns_columns_and_empty(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    kept = H.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == H.judge(docs).filter("kept").count()
    assert H.judge(docs.limit(0)).count() == 0 and H.keep(docs.limit(0)).count() == 0
