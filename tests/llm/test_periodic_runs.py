import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_data import docs, empty, odd, words  # noqa: F401

from terrasol.llm import periodic_runs as pr


def brute(seq, least=12):
    """Every maximal stretch with its smallest period, straight from the definition."""
    n, found = len(seq), {}
    for q in range(1, n // 2 + 1):
        s = 0
        while s < n - q:
            e = s
            while e < n - q and seq[e] == seq[e + q]:
                e += 1
            if e + q - s >= max(least, 2 * q):
                found.setdefault((s, e + q), q)
            s = max(e, s + 1) if e > s else s + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs_of(texts):
    sizes = [len(t) for t in texts]
    x, text = [], []
    for k, t in enumerate(texts):
        x += [*t, -1 - k]
        text += [k] * (len(t) + 1)
    s, length, p = pr.runs(np.array(x, np.int64), np.array(text, np.int64))
    first = np.cumsum([0, *(n + 1 for n in sizes)])
    out = [[] for _ in texts]
    for a, b, c in zip(s.tolist(), length.tolist(), p.tolist()):
        k = text[a]
        out[k].append((a - int(first[k]), b, c))
    return out


def test_runs_equal_brute_force_on_random_texts():
    rng = random.Random(1)
    texts = []
    for _ in range(400):
        n, letters = rng.randrange(0, 90), rng.choice([1, 2, 2, 3, 6])
        t = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(3)):  # plant repetitions
            if n > 14:
                a, p = rng.randrange(n - 12), rng.randrange(1, 9)
                stop = min(n, a + rng.randrange(12, 60))
                for i in range(a + p, stop):
                    t[i] = t[i - p]
        texts.append(t)
    assert runs_of(texts) == [brute(t) for t in texts]


def test_common_extensions_equal_direct_comparison():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, 300)
    x[150:280] = x[20:150]
    lce = pr.CommonExtensions(x)
    i, j = np.triu_indices(len(x), 1)
    got = lce.lce(i, j)
    for a, b, n in list(zip(i, j, got))[::37]:
        m = 0
        while b + m < len(x) and x[a + m] == x[b + m]:
            m += 1
        assert n == m


def test_a_word_repeated_many_times_and_long_texts():
    long = [k % 5000 for k in range(40_000)]
    assert runs_of([[7] * 50_000, long, []]) == [[(0, 50_000, 1)], [(0, 40_000, 5000)], []]


def expected(doc_id, text):
    w = [x.encode() for x in (text or "").split()] if text is None else [x for x in text.encode().split()]
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w) if n < 3000 else None
    if found is None:
        return None
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


COLS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_rows_equal_brute_force(spark, docs):  # noqa: F811
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in pr.periodic_runs(docs, pr.repeated, batch=3000).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got.keys() == texts.keys()
    want = {k: expected(k, t) for k, t in texts.items()}
    assert {k: got[k] for k in got if want[k]} == {k: v for k, v in want.items() if v}
    assert sum(v is not None for v in want.values()) > 150 and any(v and v[0] for v in want.values())


def test_odd_rows_and_empty_table(odd, empty):  # noqa: F811
    got = pr.periodic_runs(odd).collect()
    assert len(got) == 12
    by = {r["doc_id"]: r for r in got}
    nothing = hashlib.sha256(b"").hexdigest()
    assert by[1]["n_runs"] == 0 and by[1]["start"] is None and by[1]["runs_sha256"] == by[1]["collapsed_sha256"] == nothing
    assert (by[9]["n_runs"], by[9]["start"], by[9]["length"], by[9]["period"], by[9]["exponent_milli"]) == (1, 0, 20000, 1, 20_000_000)
    assert pr.periodic_runs(empty).collect() == [] and pr.periodic_runs(empty).columns == pr.periodic_runs(odd).columns


@pytest.mark.parametrize("n", [1, 2, 11, 12, 13])
def test_shortest_runs(n):
    assert runs_of([[5] * n]) == [[(0, n, 1)] if n >= 12 else []]
