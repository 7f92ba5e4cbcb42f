from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidemark.llm import ann


def test_recall_on_a_table_larger_than_the_sample(spark, monkeypatch):
    """Exact search inside the probed lists reaches the target; vectors without clusters."""
    monkeypatch.setattr(ann, "SAMPLE", 2_000)
    total = 62_500
    x = np.random.default_rng(3).standard_normal((total, 64))
    table = pa.table({"vec_id": np.arange(total), "vector": pa.array(x.tolist(), pa.list_(pa.float64()))})
    rows = spark.createDataFrame(table)
    lists = ann.fit(rows, total, 10)
    queries = np.arange(0, total, total // 300)
    own = np.concatenate([ann._squared(part, lists.centroids).argmin(1) for part in np.array_split(x, 20)])
    sizes = np.bincount(own, minlength=len(lists.centroids))
    distance = ann._squared(x[queries], x)
    distance[np.arange(len(queries)), queries] = np.inf
    neighbours = np.argpartition(distance, 10, 1)[:, :10]
    order = ann._squared(x[queries], lists.centroids).argsort(1)
    probed = np.zeros(order.shape, bool)
    np.put_along_axis(probed, order, sizes[order].cumsum(1) - sizes[order] < lists.share * total, 1)
    recall = np.take_along_axis(probed, own[neighbours], 1).mean()
    assert recall >= ann.TARGET_RECALL - 0.005
