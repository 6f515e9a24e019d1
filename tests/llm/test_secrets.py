import hashlib
import random
import re

from terrasol.llm import secrets
from terrasol.llm.queries import op5_secrets
from llm_data import SF, docs, empty, odd  # noqa: F401

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base(text):
    """The contract's base spans, by the regular expressions as stated."""
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def test_query_equals_regular_expressions(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in op5_secrets(spark, SF).collect():
        want = base(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[3] == k for s in want) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == ([] if not want else joined(want).split(","))


NASTY = ["", None, "token: ab token: abcdefgh", "password = password=abcdef", "api_key:'AKIA" + "A1" * 8 + "'", "AKIAAKIA" + "B" * 11, "AKIA" + "B" * 15,
         "é\U0001F600 SECRET=\"" + "0123456789abcdef" * 2 + "\" x", "apikey=12345", "apikey=123456", "toKen = Keyeyey", "paſſword=abcdefg",
         "deadbeef" * 3, "DEADBEEF" * 3, "deadbeef" * 2 + "dead" + "xyz", "passwd:\x20\x20=abcdefgh", "token=\nabcdefgh", "token" * 50 + "=zzzzzz", "\n".join(f"token={i:06d}" for i in range(1500))]


def test_spans_of_odd_texts(spark):
    rows = list(enumerate(NASTY))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, spans string, base string")
    got = {r.doc_id: [tuple(s) for s in r.base] for r in secrets.scan(df, [0.0] * len(secrets.ALPHABET) ** 2).collect()}
    for i, t in rows:
        assert got[i] == base(t), t


def test_random_strings_are_told_from_identifiers(spark, docs):
    rng = random.Random(9)
    table = secrets.train(docs)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    random_ = ["".join(rng.choice(alphabet) for _ in range(32)) for alphabet in (b64, b64[:-2], "0123456789ABCDEF", b64[:26] + b64[52:62]) for _ in range(40)]
    vocabulary = sorted({w.lower() for r in docs.limit(60).collect() for w in re.findall("[A-Za-z]{4,}", r.text or "")})
    plain = ["_".join(rng.sample(vocabulary, 4)) for _ in range(80)] + ["".join(w.title() for w in rng.sample(vocabulary, 4)) for _ in range(40)] + ["-" * 40, "=" * 30, "_" * 25]
    df = spark.createDataFrame([(i, f"see {s} end") for i, s in enumerate(random_ + plain)], "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in secrets.scan(df, table).collect()}
    assert sum("markov" in got[i] for i in range(len(random_))) >= 0.95 * len(random_)
    assert sum("markov" in got[i + len(random_)] for i in range(len(plain))) <= 0.05 * len(plain)


def test_redaction(spark, odd, empty):
    df = spark.createDataFrame([(1, 'é token = "abcdef0123456789abcdef0123", AKIA' + "Z" * 16 + " end"), (2, "clean"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(secrets.scan(df, secrets.train(df))).collect()}
    assert got == {1: 'é <secret>", <secret> end', 2: "clean", 3: None}
    assert secrets.scan(empty, secrets.train(empty)).collect() == []
    assert len(secrets.scan(odd, secrets.train(odd)).collect()) == odd.count()


def test_random_keys_inside_longer_runs(spark, docs):
    rng = random.Random(4)
    table = secrets.train(docs)
    vocabulary = sorted({w.lower() for r in docs.limit(60).collect() for w in re.findall("[A-Za-z]{4,}", r.text or "")})
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    rows = [(n, sep.join(rng.sample(vocabulary, n)) + sep, key(20)) for n in (4, 10, 20) for sep in "/_-" for _ in range(20)]
    texts = [f"see {p}{k} end" for _, p, k in rows] + [f"see {p}{k}/{p}{key(20)}/the-end end" for _, p, k in rows]
    # a run that touches a base span: what follows the digest is scored by itself
    texts += [f"see {'0123456789abcdef' * 2}_{k} end" for _, _, k in rows]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(secrets.scan(df, table)).collect()}
    hidden = [rows[i % len(rows)][2] not in got[i] for i in range(len(texts))]
    for at in range(0, len(texts), len(rows)):
        assert sum(hidden[at:at + len(rows)]) >= 0.95 * len(rows)
    # both keys of a run, and the words of the path stay
    second = [got[i].count("<secret>") >= 2 and rows[i % len(rows)][1][:4] in got[i] for i in range(len(rows), 2 * len(rows))]
    assert sum(second) >= 0.9 * len(rows)
    plain = spark.createDataFrame([(i, f"see {sep.join(rng.sample(vocabulary, 12))} end") for i, sep in enumerate("/_-" * 40)], "doc_id long, text string")
    assert sum(bool(r.spans) for r in secrets.scan(plain, table).collect()) <= 6


def test_short_random_keys_are_found_and_words_are_not(spark, docs):
    rng = random.Random(11)
    table = secrets.train(docs)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = [(n, "".join(rng.choice(alphabet) for _ in range(n))) for n in (12, 14, 16, 18, 19) for _ in range(100)]
    df = spark.createDataFrame([(i, f"see {k} end") for i, (_, k) in enumerate(keys)], "doc_id long, text string")
    found = {r.doc_id for r in secrets.scan(df, table).collect() if r.spans}
    for n in (12, 14, 16, 18, 19):
        assert sum(i in found for i, (m, _) in enumerate(keys) if m == n) >= (90 if n == 12 else 95)
    long_words = sorted({w for r in docs.collect() for w in re.findall("[A-Za-z]{12,}", r.text or "")})
    plain = spark.createDataFrame([(i, f"the {w} end") for i, w in enumerate(long_words)], "doc_id long, text string")
    assert len(long_words) > 100 and secrets.scan(plain, table).where("size(spans) > 0").count() <= 0.05 * len(long_words)


def markov(text, table):
    """The spans that look random, step by step."""
    n, out = len(secrets.ALPHABET), []
    for run in re.finditer("[A-Za-z0-9+/_=-]{12,}", text):
        at, parts = run.start(), []
        for s, _, e, _ in base(text):
            if s < run.end() and e > run.start():
                if s > at:
                    parts.append((at, s))
                at = max(at, e)
        if at < run.end():
            parts.append((at, run.end()))
        for lo, hi in parts:
            if hi - lo < secrets.LEAST:
                continue
            code = [secrets.ALPHABET.index(c) for c in text[lo:hi]]
            ratio = [table[a * n + b] for a, b in zip(code, code[1:])]
            if sum(ratio) >= secrets.THRESHOLD:
                out.append((lo, hi))
                continue
            total = best = 0.0
            first = end = 0
            found = []
            for k, x in enumerate([*ratio, None]):
                if x is None or total + x <= 0 or total + x < best - secrets.THRESHOLD:
                    if best >= secrets.THRESHOLD and end - first >= secrets.LEAST:
                        found.append((first, end))
                    total = best = 0.0
                    first = end = k + 1
                else:
                    total += x
                    if total > best:
                        best, end = total, k + 2
            part = text[lo:hi]
            for a, b in found:
                while a and part[a - 1] not in secrets.SEPARATORS:
                    a -= 1
                while b < len(part) and part[b] not in secrets.SEPARATORS:
                    b += 1
                if (lo + a, lo + b) not in out:
                    out.append((lo + a, lo + b))
    return out


def test_markov_spans_equal_a_direct_scan(spark, docs):
    rng = random.Random(12)
    table = secrets.train(docs)
    key = lambda n: "".join(rng.choice(secrets.ALPHABET) for _ in range(n))
    words = ["horizon", "of", "the-long", "parser_state", "AKIA" + "B1" * 9, "0123456789abcdef" * 2, "token=abcdefgh12", "a/b/c", "configuration"]
    texts = [rng.choice(["", " ", "/", "_", "="]).join(rng.choice([*words, key(rng.randrange(3, 30))]) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: sorted((s.start, s.end) for s in r.spans if s.kind == "markov") for r in secrets.scan(df, table).collect()}
    assert got == {i: sorted(markov(t, table)) for i, t in enumerate(texts)} and sum(map(bool, got.values())) > 100
