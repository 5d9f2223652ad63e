"""What the driver's Python holds while models are fitted."""

import tracemalloc

import numpy as np

from millrace.llm import toxicity


def test_toxicity_counts_are_held_as_arrays(spark):
    """300,000 distinct pairs; as tuples in counters each took over 250 bytes in the driver."""
    rng = np.random.default_rng(5)
    table = [(i, " ".join(f"w{w:05d}" for w in rng.integers(0, 20_000, 1500)), i % 2) for i in range(200)]
    docs = spark.createDataFrame(table, "doc_id long, text string, toxic int").cache()
    docs.count()
    del table
    tracemalloc.start()
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    docs.unpersist()
    assert len(model.number) > 20_000
    assert peak < 150 * 300_000
