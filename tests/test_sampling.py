import hashlib
import math

from terrasol.operators.sampling import stratified_split


def test_split_exact_counts_and_membership(spark):
    rows = [(i, 0 if i < 3000 else (1 if i < 3010 else 2)) for i in range(3013)]   # one dominant stratum
    df = spark.createDataFrame(rows, "id long, s int")
    got = {r.id: r.split for r in stratified_split(df, "id", "s", 0.2, "42").collect()}
    for s, members in ((0, range(0, 3000)), (1, range(3000, 3010)), (2, range(3010, 3013))):
        # reference: rank the whole stratum by md5(key || seed), first ceil(0.2 n) are test
        ranked = sorted(members, key=lambda i: (hashlib.md5(f"{i}42".encode()).hexdigest(), i))
        k = math.ceil(0.2 * len(ranked))
        assert {i for i in members if got[i] == "test"} == set(ranked[:k]), s
