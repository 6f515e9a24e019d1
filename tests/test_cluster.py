import numpy as np

from terrasol.operators.cluster import dbscan, vincenty_km


def brute_dbscan(lat, lon, eps, min_samples):
    n = len(lat)
    d = vincenty_km(np.repeat(lat, n), np.repeat(lon, n), np.tile(lat, n), np.tile(lon, n)).reshape(n, n)
    nb = d <= eps
    core = nb.sum(1) >= min_samples
    labels = np.full(n, -1)
    c = 0
    for i in range(n):                      # points in id order, like a scan of the table
        if labels[i] != -1 or not core[i]:
            continue
        labels[i] = c
        stack = [i]
        while stack:
            j = stack.pop()
            if not core[j]:
                continue
            for k in np.nonzero(nb[j])[0]:
                if labels[k] == -1:
                    labels[k] = c
                    stack.append(k)
        c += 1
    return labels


def test_dbscan_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centers = np.array([[45.0, 2.0], [45.05, 2.0], [-21.1, 55.5], [16.2, -61.5]])
    pts = np.concatenate([c + rng.normal(0, 0.004, (25, 2)) for c in centers] + [rng.uniform(-1, 1, (10, 2)) + [40, 0]])
    pts = np.concatenate([pts, pts[:3]])    # duplicates
    lat, lon = pts[:, 0], pts[:, 1]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, latitude double, longitude double")
    for ms in (2, 3, 5):
        got = {r.id: r.labels for r in dbscan(df, "id", min_samples=ms).collect()}
        want = brute_dbscan(lat, lon, 1.0, ms)
        # same partition; border points may legitimately differ only when claimed by two clusters
        assert [got[i] for i in range(len(pts))] == list(want), ms


def test_vincenty_known_distance():
    # one degree of latitude at the equator on WGS-84
    assert abs(vincenty_km(np.array([0.0]), np.array([0.0]), np.array([1.0]), np.array([0.0]))[0] - 110.574) < 1e-3


def test_dbscan_shared_border_point(spark):
    # on the equator 0.001 deg of longitude is about 0.111 km
    lons = [0.0, 0.0005, 0.001, 0.002,            # cluster 0 (ids 0-3)
            0.019, 0.0195, 0.020, 0.021,          # cluster 1 (ids 4-7)
            0.0105,                               # border point near both clusters (id 8)
            1.0]                                  # isolated (id 9)
    df = spark.createDataFrame([(i, 0.0, x) for i, x in enumerate(lons)], "id long, latitude double, longitude double")
    got = [r.labels for r in dbscan(df, "id", min_samples=4).orderBy("id").collect()]
    assert got == [0, 0, 0, 0, 1, 1, 1, 1, 0, -1]
    assert list(brute_dbscan(np.zeros(len(lons)), np.array(lons), 1.0, 4)) == got


def test_dbscan_hot_spots_against_brute_force(spark):
    rng = np.random.default_rng(11)
    a = np.array([45.0, 2.0]) + rng.normal(0, 0.0003, (600, 2))        # ~30 m spread: one dense cube
    b = np.array([45.0, 2.005]) + rng.normal(0, 0.0003, (600, 2))      # ~0.4 km away: linked cubes
    c = np.array([45.1, 2.0]) + rng.normal(0, 0.0003, (50, 2))          # 11 km away: own cluster
    pts = np.concatenate([a, b, c, [[46.0, 3.0]]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                               "id long, latitude double, longitude double")
    got = [r.labels for r in dbscan(df, "id", min_samples=5).orderBy("id").collect()]
    assert got == list(brute_dbscan(pts[:, 0], pts[:, 1], 1.0, 5))
    assert sorted(set(got)) == [-1, 0, 1]
