"""Vectors against all pairs of a label: every link is found, whatever the size of the table."""

import numpy as np
import pytest

from sitepulse.llm import embedding


@pytest.mark.parametrize("block", [300, 4_096])
def test_every_link_at_the_limit_is_found(spark, monkeypatch, block):
    monkeypatch.setattr(embedding, "BLOCK", block)
    rng = np.random.default_rng(8)
    base = embedding.unit_rows(rng.normal(size=(700, 64)))
    side = rng.normal(size=(700, 64))
    side = embedding.unit_rows(side - (side * base).sum(axis=1, keepdims=True) * base)
    cosine = rng.uniform(0.9301, 0.935, (700, 1))
    vectors = np.concatenate([base, base * cosine + side * np.sqrt(1 - cosine**2)])
    unit = embedding.unit_rows(vectors)
    linked = unit @ unit.T >= 0.93
    expected = linked.sum(axis=1) - 1
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in embedding.link_vectors(table).collect()}
    assert [found[i]["n_links"] for i in range(len(rows))] == expected.tolist()
    assert all(found[i + 700]["component_id"] == found[i]["component_id"] for i in range(700))


def test_the_bound_is_never_below_the_cosine():
    rng = np.random.default_rng(9)
    x = embedding.unit_rows(rng.normal(size=(300, 64)))
    y = embedding.unit_rows(x + rng.normal(size=(300, 64)) * rng.uniform(0, 0.3, (300, 1)))
    turn = embedding.rotation(embedding.CODE_BITS)
    turned, _, _ = embedding.codes_of(x, turn)
    _, code, factor = embedding.codes_of(y, turn)
    assert (embedding.highest(turned, code, factor) >= x @ y.T).all()
