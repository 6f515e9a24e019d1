import random

from terrasol.operators import ml


def test_classifiers_beat_the_majority_on_separable_data(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        y = i % 3
        words = [rng.choice(("le", "la", "site", "zone", "parc")) for _ in range(20)] + [("friche", "forêt", "vigne")[y]] * 2
        rng.shuffle(words)
        vec = [rng.gauss(3.0 if k == y else 0.0, 1.0) for k in range(3)]
        rows.append((" ".join(words), float(y), "test" if i % 5 == 0 else "train", vec))
    df = spark.createDataFrame(rows, "chunk_text string, label double, split string, embedding array<double>")
    for got in (ml.text_classifier(df).first(), ml.embedding_classifier(df).first()):
        assert (got.n_train, got.n_test) == (192, 48) and got.accuracy > 0.8
