import re
from collections import Counter

import numpy as np
from llm_data import SF, docs, empty, odd  # noqa: F401

from terrasol.llm import collocations as co


def brute(rows, least=10, share=50, top=2000, order=3):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, order + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    around = Counter()
    for (lang, w), a in cands.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                around[lang, w[i:i + m]] = max(around[lang, w[i:i + m]], a)
    out = {}
    for (lang, w), a in cands.items():
        if (lang, w) in around and 100 * around[lang, w] >= share * a:
            continue
        score, _, l, r = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for k, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force(spark, docs):  # noqa: F811
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert result(co.collocations(docs)) == brute(rows)
    assert result(co.collocations(docs, least=4, top=30)) == brute(rows, 4, top=30)
    assert result(co.collocations(docs, order=2)) == brute(rows, order=2)


def test_hot_heads_are_split_without_changing_counts(spark, monkeypatch):
    rows = [("en", f"new york {k % 40} is big. new york {k % 7}, new york") for k in range(300)] + [(None, "new york is. new york is")] * 12
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    monkeypatch.setattr(co, "HOT_SHARE", 20)
    assert {"new york en", "new en"} <= set(co.hot_heads(df))
    salts = {r["salt"] for r in co.window_counts(df, 3, ["new york en", "new en"]).collect()}
    assert len(salts) > 10
    assert result(co.collocations(df)) == brute(rows)
    assert result(co.collocations(df, order=2)) == brute(rows, order=2)


def test_chunks_and_many_words_agree(spark, docs):  # noqa: F811
    count = lambda d: sorted(map(tuple, co.opened(d).groupBy("first", "w2", "w3").sum("c").collect()))
    assert count(co.window_counts(docs, chunk=500)) == count(co.window_counts(docs))
    w = np.array([[1, 2, 1, 3], [5, 6, 5, 0], [9, 0, 9, 0]])
    for size in (10, 1 << 22):
        windows, n = co.counted_windows(w, size)
        assert sorted(zip(*windows.tolist(), n.tolist())) == [(1, 5, 9, 2), (2, 6, 0, 1), (3, 0, 0, 1)]


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, big + 1, big + 7), (10, 10, 10), (10, 1000, 10)], "a long, l long, r long")
    got = [r[0] for r in df.select(co.exact_score(df["a"], df["l"], df["r"]).cast("long")).collect()]
    assert got == [1000000 * big * big // ((big + 1) * (big + 7)), 1000000, 10000]


def test_odd_rows_and_empty_table(spark, odd, empty):  # noqa: F811
    assert result(co.collocations(odd)) == brute([(r["lang"], r["text"]) for r in odd.collect()])
    spaced = spark.createDataFrame([("a b", "x y z\x85w, x y")] * 10 + [("", "p q")] * 10, "lang string, text string")
    assert result(co.collocations(spaced)) == brute([tuple(r) for r in spaced.collect()])
    assert co.collocations(empty).collect() == []
