"""Windows near an item: only asked places come back, with the cosines of the plain comparison."""

from types import SimpleNamespace

import numpy as np

from varloom.llm import decontaminate as D


def test_cosines_of_held_windows(monkeypatch):
    monkeypatch.setattr(D, "LOT", 8)
    rng = np.random.default_rng(2)
    blocks, terms, rank = 61, 30, 5
    basis = rng.normal(size=(terms, rank)).astype(np.float32)
    vectors = rng.normal(size=(4, rank)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    sizes = np.array([2, 3, 2, 4])
    index = SimpleNamespace(basis=basis, vectors=vectors, sizes=sizes, wider=sizes + 1, seqs=[np.zeros(3), np.zeros(2), np.zeros(0), np.zeros(5)])
    number = rng.integers(-1, terms, 300)
    block = np.sort(rng.integers(0, blocks - 6, 300))
    held = np.unique(rng.integers(0, 4 * blocks, 120))
    want = {}
    for k, key in enumerate(held.tolist()):
        item, at = divmod(key, blocks)
        for size in (sizes[item], sizes[item] + 1):
            inside = (block >= at) & (block < at + size) & (number >= 0)
            window = basis[number[inside]].sum(0)
            if item != 2 and inside.any() and at + size <= blocks:
                near = window @ vectors[item] / np.linalg.norm(window)
                if near >= D.COSINE:
                    want[k] = max(want.get(k, -1), near)
    got = {}
    for at, near in D._near(index, number, block, blocks, held):
        for k, v in zip(at.tolist(), near.tolist()):
            got[k] = max(got.get(k, -1), v)
    assert want and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-4 for k in want)
