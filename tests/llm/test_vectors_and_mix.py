"""Shared pivots of vectors, links of a large table with a large cluster, and mixes of the given documents."""

from __future__ import annotations

import numpy as np
import pytest

from coverspark.llm.queries import QUERIES
from coverspark.llm.sharding import best_fit_decreasing
from coverspark.llm.toxicity import fit_toxicity
from coverspark.llm.vector_dedup import permutations, plan_index, shared_counts, unit_rows, vector_dedup
from tests.llm.test_llm import by_id


@pytest.mark.parametrize("shift", [0, 1, 3, 8])
def test_shared_counts(shift):
    rng = np.random.default_rng(1)
    x, y = (np.array([rng.permutation(20)[:8] for _ in range(n)]) for n in (40, 70))
    want = [[sum(p == q and abs(i - j) <= shift for i, p in enumerate(a) for j, q in enumerate(b)) for b in y] for a in x]
    assert shared_counts(x, y, shift).tolist() == want
    assert shared_counts(x + 100, y, shift).sum() == 0 and shared_counts(x, y[:0], shift).shape == (40, 0) and shared_counts(x[:0], y, shift).shape == (0, 70)


def test_plan_keeps_its_target():
    rng = np.random.default_rng(2)
    x = unit_rows(list(rng.normal(size=(4000, 32))))
    own = plan_index(x, 500, 0.9, 0.998)
    a = x[:1000]
    away = rng.normal(size=a.shape)
    away -= (away * a).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * away / np.linalg.norm(away, axis=1, keepdims=True)
    near = [permutations(v, own.pivots, own.nearest) for v in (a, b)]
    assert np.mean([shared_counts(p[None], q[None], own.shift)[0, 0] >= own.common for p, q in zip(*near)]) > 0.98


def test_links_of_20000_vectors_with_a_third_in_one_cluster(spark):
    rng = np.random.default_rng(3)
    n, hot, d = 20_000, 6_667, 64
    x = rng.normal(size=(n, d))
    x[:hot] = rng.normal(size=d) + 0.31 * rng.normal(size=(hot, d))  # cosines of about 0.91 within
    pairs = np.arange(hot, hot + 6000, 2)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(len(pairs), d))
    away -= (away * x[pairs]).sum(1, keepdims=True) * x[pairs]
    x[pairs + 1] = 0.905 * x[pairs] + np.sqrt(1 - 0.905**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    x = np.float32(x)
    got = by_id(vector_dedup(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")), "vec_id")
    u = unit_rows(list(x))
    true = np.zeros(n, np.int64)
    for a in range(0, n, 2000):
        true[a : a + 2000] = (u[a : a + 2000] @ u.T >= 0.9).sum(1) - 1
    found = np.array([got[k]["n_links"] for k in range(n)])
    assert (found <= true).all() and found.sum() >= 0.98 * true.sum()
    assert found[hot:].sum() >= 0.98 * true[hot:].sum() > 5000 and true[:hot].sum() > 1_000_000


@pytest.mark.parametrize("sf,most", [("sf0.1", 5), ("sf0.01", 40)])
def test_mix_of_documents_comes_near_its_targets(spark, sf, most):
    """Words taken of each source of the given documents, against its target: the rows that fill up, and one exchange."""
    rows = QUERIES["op7_mixing"](spark, f"/root/testdata/{sf}").select("size", "source_size", "target", "taken").collect()
    words = {}
    for r in rows:
        words[(r.source_size, r.target)] = words.get((r.source_size, r.target), 0) + r.taken
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0
    assert len(words) == 20 and max(abs(n - target) for (_, target), n in words.items()) < most


def test_best_fit_decreasing_against_a_list():
    """Random instances against a search of all bins, item by item, the largest first; of equally tight bins the first."""
    rng = np.random.default_rng(21)
    for _ in range(300):
        sizes = rng.integers(1, 40, rng.integers(0, 60)).tolist()
        capacity = int(rng.integers(40, 90))
        rooms, want = [], [0] * len(sizes)
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
            fits = [(room, b) for b, room in enumerate(rooms) if room >= sizes[k]]
            if fits:
                want[k] = min(fits)[1]
            else:
                want[k] = len(rooms)
                rooms.append(capacity)
            rooms[want[k]] -= sizes[k]
        got = best_fit_decreasing(sizes, capacity)
        fill = lambda bins: sorted(sum(s for s, x in zip(sizes, bins) if x == b) for b in set(bins))
        assert fill(got) == fill(want) and len(set(got)) == len(rooms)


def test_repeated_ids_are_learned_from_once(spark):
    rows = [(k, f"plain word{k} text" if k % 2 else f"vile nasty word{k} text") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(60)], "doc_id long, toxic int")
    assert fit_toxicity(docs.unionByName(docs.where("doc_id < 20")).unionByName(docs.where("doc_id = 2")), labels) == fit_toxicity(docs, labels)
