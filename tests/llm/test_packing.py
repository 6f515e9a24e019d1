import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from terrasol.llm import packing
from terrasol.llm.queries import op9_pack, tokenizer_file
from llm_data import SF, docs, empty, odd  # noqa: F401

TOKENIZER, RANKS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")


def check(got, rows, capacity=1024):
    """Every token of every document once, at its place in gapless sequences."""
    t = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for d, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            want[d, k, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query(spark, docs):
    got = op9_pack(spark, SF).collect()
    n = check(got, [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= 1.02 * -(-sum(r.length for r in got) // 1024) + 1


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for capacity, ranks in ((1024, None), (7, RANKS)):
        check(packing.pack_documents(odd, TOKENIZER, capacity, ranks).collect(), rows, capacity)
    assert packing.pack_documents(empty, TOKENIZER).collect() == []


def test_word_memo_equals_whole_texts():
    whole = Tokenizer.from_file(TOKENIZER)
    texts = ["", " ", "a", " a b", "a b ", "a  b", "a\n b\tc", "x \xa0y", "it's a'll 12 ,", "a \n", "\n a", "é  b", "a\x1c b", "x <|endoftext|> y", "<|endoftext|>", "aa bb " * 30]
    rng = random.Random(2)
    texts += ["".join(rng.choice("ab 1,\n'é\U0001F600\x85\t") for _ in range(rng.randrange(60))) for _ in range(400)]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.Encoder(TOKENIZER).encode(texts) == want
    assert packing.Encoder(TOKENIZER, RANKS, limit=5).encode(texts) == want


def test_plans_use_every_piece_once():
    rng = random.Random(3)
    for capacity in (1, 7, 64, 1024):
        for _ in range(20):
            h = {rng.randrange(1, capacity + 1): rng.randrange(1, 500) for _ in range(rng.randrange(0, 40))}
            plan = packing.packing_plan(h, capacity)
            used = Counter()
            for lengths, times in plan:
                assert sum(lengths) <= capacity and times > 0
                for n in lengths:
                    used[n] += times
            assert used == h
            best = -(-sum(n * c for n, c in h.items()) // capacity)
            assert sum(times for _, times in plan) <= 2 * best + 1
    exact = {600: 10, 424: 4, 200: 12, 224: 6, 24: 6}
    assert sum(t for _, t in packing.packing_plan(exact)) == -(-sum(n * c for n, c in exact.items()) // 1024)


def test_sum_index_finds_what_exists():
    rng = random.Random(6)
    for _ in range(60):
        top = rng.choice([12, 30, 64])
        index = packing.SumIndex({rng.randrange(1, top + 1): rng.randrange(1, 4) for _ in range(rng.randrange(1, 14))}, top)
        while index.left:  # counts fall, lookups must keep up with them
            pool = [n for n, c in index.left.items() for _ in range(min(c, 3))]
            for total in range(1, top + 1):
                exists = any(sum(c) == total for k in (1, 2, 3) for c in itertools.combinations(pool, k))
                found = index.exact(total)
                assert (found is not None) == exists and (found is None or sum(found) == total and index.has(*found))
            index.take((rng.choice(sorted(index.left)),), 1)


def test_pieces_alike_in_everything_are_dealt(spark):
    same = spark.createDataFrame([(None, "a b c d e")] * 3000, "doc_id long, text string")
    got = packing.pack_documents(same, TOKENIZER, 64).collect()
    check(got, [(None, "a b c d e")] * 3000, 64)
