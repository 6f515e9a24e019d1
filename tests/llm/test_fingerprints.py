import hashlib
import statistics

from terrasol.llm import fingerprints as fp
from terrasol.llm.queries import op7_fingerprints
from llm_data import SF, docs, empty, odd  # noqa: F401


def brute_force(rows):
    """doc_id, n_chars, digest of the edited text, in the order of ids (null first) and texts."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (d, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_query(spark, docs):
    got = op7_fingerprints(spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert order((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == order(brute_force(rows))
    texts, prints = dict(rows), {}
    for r in got:  # equal texts, equal fingerprints; different texts, different ones
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)
    long_ = [r for r in got if r.n_chars >= 400 and r.near_edited < 1]
    assert 0.65 < statistics.median(r.near_edited for r in long_) < 0.85
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    assert sum(r.near_edited > r.near_next for r in long_) >= 0.95 * len(long_)


def test_many_parts_give_the_same_rows(spark, docs, odd):
    one = sorted(map(tuple, fp.fingerprint_edits(docs).collect()))
    assert sorted(map(tuple, fp.fingerprint_edits(docs, part_chars=10_000).collect())) == one
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for chars in (8_000_000, 20):
        got = fp.fingerprint_edits(odd, part_chars=chars).collect()
        assert order((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == order(brute_force(rows))


def test_small_tables(spark, empty):
    assert fp.fingerprint_edits(empty).collect() == []
    one = fp.fingerprint_edits(spark.createDataFrame([(3, "ab cd ef gh")], "doc_id long, text string")).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"ab cd ef ab").hexdigest() and one.near_next == 1.0


def test_edits_are_located(spark):
    lines = [f"line {i} of the text" for i in range(300)]
    a = "\n".join(lines).encode()
    b = "\n".join([*lines[:70], "a new line", *lines[70:200], "another text", *lines[201:]]).encode()
    ta, tb = fp.tree(a), fp.tree(b)
    assert [a[lo:hi] for lo, hi in fp.edits(ta, tb)] == [b"line 200 of the text"]
    assert [b[lo:hi] for lo, hi in fp.edits(tb, ta)] == [b"a new line", b"another text"]
    assert fp.edits(ta, fp.tree(a)) == [] and ta.root != tb.root
    assert len({d for d, _ in ta.sections} & {d for d, _ in tb.sections}) > len(ta.sections) / 2
    r = fp.merkle_trees(spark.createDataFrame([(1, a.decode()), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert r[0].root == ta.root.hex() and sum(len(s.paragraphs) for s in r[0].sections) == 300 and r[1].root == fp.tree(b"").root.hex()


def marks(text, s=fp.Sketcher()):
    raw = text.encode()
    return fp.tree(raw), s(raw)


def test_likeness_follows_edits():
    words = [f"w{i * 7919 % 1000}" for i in range(600)]
    for glue in (" ", "\n"):
        full, shares = marks(glue.join(words)), []
        for kept in (600, 540, 450, 300, 0):
            shares.append(fp.likeness(full, marks(glue.join(words[:kept] + [f"x{i}" for i in range(600 - kept)]))))
        assert shares[0] == 1 and shares == sorted(shares, reverse=True) and shares[-1] < 0.05 and abs(shares[2] - 0.75) < 0.12


def test_likeness_is_one_for_equal_roots_only():
    import random
    rng = random.Random(2)
    words = [f"w{rng.randrange(3000)}" for _ in range(5000)]
    for _ in range(50):  # one changed word in a long text: the sketches alone are often equal
        at = rng.randrange(5000)
        near = fp.likeness(marks(" ".join(words)), marks(" ".join([*words[:at], "changed", *words[at + 1:]])))
        assert 0.97 < near < 1
    lines = [f"paragraph {i} has its own words {i * 7}" for i in range(200)]
    moved = lines[:]
    rng.shuffle(moved)
    assert 0.7 < fp.likeness(marks("\n".join(lines)), marks("\n".join(moved))) < 1
    swapped = fp.likeness(marks("\n".join(lines)), marks("\n".join(lines[100:] + lines[:100])))
    assert 0.7 < swapped < 1 and fp.likeness(marks(""), marks("a")) < 1 and fp.likeness(marks(""), marks("")) == 1


def test_query_locates_the_edits(spark):
    rows = [(1, "\n".join(f"first line {i}" for i in range(40))), (2, "another text\nof two lines"), (3, None)]
    got = {r.doc_id: r for r in fp.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    cut = len(rows[0][1]) // 4
    edited = (rows[0][1][:len(rows[0][1]) - cut] + rows[1][1][:cut]).encode()
    lines = rows[0][1].encode().split(b"\n")
    assert [edited[s.first:s.end] for s in got[1].edited_spans] == [x for x in edited.split(b"\n") if x not in lines]
    assert got[3].edited_spans == [] and got[3].near_edited == 1
