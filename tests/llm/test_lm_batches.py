"""Scores of tokens do not depend on the batch, nor on the shift before the exponential."""

from types import SimpleNamespace

import numpy as np

from varloom.llm import lmscore as L


def _model(rng, n=40, scale=0.3):
    f32 = lambda *shape: rng.normal(0, scale, shape).astype(np.float32)
    return SimpleNamespace(inputs=f32(n, L.WIDTH), outputs=f32(n, L.WIDTH), bias=f32(n), scale=f32(3, L.WIDTH), end=0)


def _plain(ids, first, m):
    out = np.empty(len(ids))
    for a, b in zip(first[:-1], first[1:]):
        for i in range(a, b):
            r = m.inputs.astype(np.float64)
            one, two = (r[ids[i - 1]] if i - 1 >= a else r[m.end]), (r[ids[i - 2]] if i - 2 >= a else r[m.end])
            recent = r[ids[max(a, i - L.RECENT) : i]]
            h = one * m.scale[0] + two * m.scale[1] + (recent.mean(0) if len(recent) else 0) * m.scale[2]
            z = m.outputs.astype(np.float64) @ h + m.bias
            out[i] = (z[ids[i]] - z.max() - np.log(np.exp(z - z.max()).sum())) / np.log(10)
    return out


def test_scores_of_batches(monkeypatch):
    rng = np.random.default_rng(1)
    first = np.array([0, 1, 60, 60, 211])
    ids = rng.integers(0, 40, 211)
    for scale in (0.3, 9.0):  # outputs of the second are far too large for an exponential without a shift
        model = _model(rng, scale=scale)
        for rows in (7, 512):
            monkeypatch.setattr(L, "SCORED", rows)
            assert np.allclose(L._logp(ids, first, model), _plain(ids, first, model), rtol=1e-3, atol=1e-3)


def _first_step(ids, first, m, start, stop):
    """Inputs after a first update, their gradient summed token by token."""
    rng, n = np.random.default_rng(3), len(m.bias)
    noise = np.searchsorted(m.heap, rng.random(L.NOISE)).clip(0, n - 1)
    r, out = m.inputs.astype(np.float64), m.outputs.astype(np.float64)
    scale, shift = m.scale.astype(np.float64), np.log(L.NOISE) + m.logp
    grad = np.zeros_like(r)
    for a, b in zip(first[:-1], first[1:]):
        for i in range(max(a, start), min(b, stop)):
            one, two = (ids[i - 1] if i - 1 >= a else m.end), (ids[i - 2] if i - 2 >= a else m.end)
            recent = ids[max(a, i - L.RECENT) : i]
            h = r[one] * scale[0] + r[two] * scale[1] + (r[recent].mean(0) if len(recent) else 0) * scale[2]
            good = h @ out[ids[i]] + (m.bias - shift)[ids[i]]
            bad = out[noise] @ h + (m.bias - shift)[noise]
            gh = out[ids[i]] / (1 + np.exp(good)) - (out[noise] / (1 + np.exp(-bad))[:, None]).sum(0)
            grad[one] += gh * scale[0]
            grad[two] += gh * scale[1]
            for w in recent:
                grad[w] += gh * scale[2] / len(recent)
    g = grad / (stop - start)
    return m.inputs + L.RATE * g / (np.sqrt(1e-6 + g * g) + 1e-4)


def test_gradient_of_a_batch_is_that_of_its_tokens():
    rng = np.random.default_rng(2)
    first = np.array([0, 1, 30, 30, 32, 150, 211])
    ids = rng.integers(0, 40, 211)
    for start, stop in ((0, 211), (0, 1), (0, 2), (40, 170), (32, 33), (160, 211)):
        model = _model(rng)
        p = np.full(40, 1 / 40)
        model.logp, model.heap = np.log(p).astype(np.float32), np.cumsum(p)
        expected = _first_step(ids, first, model, start, stop)
        memory = {k: np.full_like(getattr(model, k), 1e-6, dtype=np.float64) for k in L.PARTS}
        L._step(ids, L._begins(first), start, stop, model, memory, np.random.default_rng(3))
        assert np.allclose(model.inputs, expected, rtol=1e-3, atol=1e-4)


def test_batches_make_no_wide_arrays_of_noise(monkeypatch):
    """The noise of a batch, its largest arrays, stays in single precision."""
    rng = np.random.default_rng(4)
    ids, model, kinds = rng.integers(0, 40, 200), _model(rng), []
    model.logp, model.heap = np.full(40, np.log(1 / 40), np.float32), np.cumsum(np.full(40, 1 / 40))
    memory = {k: np.full_like(getattr(model, k), 1e-6, dtype=np.float64) for k in L.PARTS}
    plain = np.exp

    def watched(x, *more, **options):
        if np.ndim(x) == 2:
            kinds.append(x.dtype)
        return plain(x, *more, **options)

    monkeypatch.setattr(np, "exp", watched)
    L._step(ids, L._begins(np.array([0, 200])), 0, 200, model, memory, rng)
    assert kinds == [np.float32]
