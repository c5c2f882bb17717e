"""The penalty of events is found with few solutions."""

import numpy as np

from lumenflow.functions import kernels


def _halved(x, gamma, least, finest=1e-4):
    """The bracket is doubled, then halved, with a solution each time."""
    lo, hi, kept, found = 0.0, 0.1, None, None
    while found is None or hi - lo > finest:
        penalty = hi if found is None else (lo + hi) / 2
        sizes = kernels.decaying_steps(x, gamma, penalty)
        some = sizes[sizes > 0]
        if len(some) and some.min() < least:
            lo, kept, hi = penalty, (sizes, penalty), (2 * hi if found is None else hi)
        else:
            hi, found = penalty, (sizes, penalty)
    return found if found[0].any() or kept is None else kept


def test_few_solutions_give_the_same_events(monkeypatch):
    rng, calls, steps = np.random.default_rng(3), [0], kernels.decaying_steps

    def counted(*args):
        calls[0] += 1
        return steps(*args)

    monkeypatch.setattr(kernels, "decaying_steps", counted)
    totals = [0, 0]
    for _ in range(25):
        x, least = rng.normal(0, 1, 80) + 30 * rng.random(80) * (rng.random(80) < 0.1), rng.uniform(0.2, 3)
        got = []
        for k, rule in enumerate((_halved, kernels.events)):
            calls[0] = 0
            got.append(rule(x, 0.8, least))
            totals[k] += calls[0]
        assert got[0][1] == got[1][1] and np.allclose(got[0][0], got[1][0], atol=1e-9)
    assert totals[1] < 0.7 * totals[0]
