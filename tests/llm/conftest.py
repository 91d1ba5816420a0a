import random

import pytest


@pytest.fixture
def frame(spark):
    """A small table that goes through several partitions."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make


@pytest.fixture
def prose():
    """Random prose with shared passages; the same for the same seed."""
    def make(seed, docs=40, words=120, vocabulary=60):
        rng = random.Random(seed)
        vocab = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(vocabulary)]
        texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, words))) for _ in range(docs)]
        for _ in range(docs // 3):                                   # passages and near copies
            a, b = rng.randrange(docs), rng.randrange(docs)
            part = texts[a][:rng.randint(0, len(texts[a]))]
            at = rng.randint(0, len(texts[b]))
            texts[b] = texts[b][:at] + part + texts[b][at:]
        return texts
    return make
