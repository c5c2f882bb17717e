"""Rules on one trace as a numpy array, for use inside grouped tasks."""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np


def mirrored(x: np.ndarray, half: int) -> np.ndarray:
    """Values mirrored at both ends, the end itself included, as often as needed."""
    n = len(x)
    at = np.arange(-half, n + half) % (2 * n)
    return x[np.where(at < n, at, 2 * n - 1 - at)]


def rank_filter(x: np.ndarray, size: int, rank: int, held: bool = False) -> np.ndarray:
    """The value of this rank (from 0) in each window of odd ``size``, edges mirrored or held; a window is kept sorted as it slides."""
    padded = (np.pad(x, size // 2, mode="edge") if held else mirrored(x, size // 2)).tolist()
    held = sorted(padded[:size])
    out = [held[rank]]
    for old, new in zip(padded, padded[size:]):
        del held[bisect_left(held, old)]
        insort(held, new)
        out.append(held[rank])
    return np.array(out[: len(x)])


#: Windows up to this size are laid out side by side, this many values at a time.
_SHORT, _CELLS = 129, 4_000_000


def windows_at(padded: np.ndarray, at: np.ndarray, size: int, rule) -> np.ndarray:
    """``rule`` of the windows of ``size`` values that begin at the places ``at``, which it gets as rows."""
    view, step = np.lib.stride_tricks.sliding_window_view(padded, size), max(1, _CELLS // size)
    parts = [rule(view[at[lo : lo + step]]) for lo in range(0, len(at), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def padded_all(x: np.ndarray, starts: np.ndarray, half: int, held: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Traces that begin at ``starts`` one after the other, each with ``half`` values more at both ends (mirrored or, if ``held``,
    the end repeated), and for each value the place where its window begins."""
    size = np.diff(np.append(starts, len(x)))
    wide = size + 2 * half
    begin = np.cumsum(wide) - wide
    own = np.arange(int(wide.sum())) - np.repeat(begin, wide) - half
    n = np.repeat(size, wide)
    turned = own % (2 * n)
    inner = np.clip(own, 0, n - 1) if held else np.where(turned < n, turned, 2 * n - 1 - turned)
    return x[np.repeat(starts, wide) + inner], np.arange(len(x)) - np.repeat(starts - begin, size)


def rank_filter_all(x: np.ndarray, starts: np.ndarray, size: int, rank: int, held: bool = False) -> np.ndarray:
    """``rank_filter`` of traces one after the other. Traces with NaN must be left out by the caller."""
    if size <= _SHORT:
        padded, at = padded_all(x, starts, size // 2, held)
        return windows_at(padded, at, size, lambda w: np.partition(w, rank, axis=1)[:, rank])
    parts = np.split(x, starts[1:])
    return np.concatenate([rank_filter(p, size, rank, held) for p in parts])


def median_image(image: np.ndarray, size: int, rows_at_once: int = 32) -> np.ndarray:
    """Median over windows of odd ``size`` in both directions, edges mirrored; NaN don't count, and stay where they are."""
    half, gaps = size // 2, np.isnan(image)
    padded = np.pad(image, half, mode="symmetric")
    median = np.nanmedian if gaps.any() else np.median
    out = np.empty_like(image)
    for lo in range(0, len(image), rows_at_once):
        part = np.lib.stride_tricks.sliding_window_view(padded[lo : lo + rows_at_once + 2 * half], (size, size))
        out[lo : lo + rows_at_once] = np.where(gaps[lo : lo + rows_at_once], np.nan, median(np.where(gaps[lo : lo + rows_at_once, :, None, None], 0.0, part), axis=(2, 3)))
    return out


def median_filter(x: np.ndarray, size: int) -> np.ndarray:
    return rank_filter(x, size, size // 2)


def percentile_filter(x: np.ndarray, size: int, percentile: float) -> np.ndarray:
    """Nearest rank, without interpolation."""
    return rank_filter(x, size, min(int(size * percentile / 100), size - 1))


def known_median_filter(x: np.ndarray, size: int) -> np.ndarray:
    """Median of the values that aren't NaN; windows without any get a line between their neighbours."""
    padded, held, out = mirrored(x, size // 2).tolist(), [], []
    for k, new in enumerate(padded):
        if new == new:
            insort(held, new)
        if k >= size and padded[k - size] == padded[k - size]:
            del held[bisect_left(held, padded[k - size])]
        if k >= size - 1:
            m = len(held) // 2
            out.append((held[m] + held[~m]) / 2 if held else math.nan)
    out = np.array(out)
    ok = np.isfinite(out)
    return np.interp(np.arange(len(out)), np.flatnonzero(ok), out[ok]) if ok.any() else out


def robust_std(x: np.ndarray) -> float:
    """1.4826 times the median distance from the median; NaN for no values or any NaN."""
    return float(1.4826 * np.median(np.abs(x - np.median(x)))) if len(x) and not np.isnan(x).any() else math.nan


def noise_std(x: np.ndarray, size: int) -> float:
    """Robust deviation of what a median filter leaves, without large and low outliers."""
    if np.isnan(x).any():
        return math.nan
    return deviation_left(x - median_filter(x, size))


def deviation_left(left: np.ndarray) -> float:
    """Robust deviation without large and low outliers."""
    left = left[left < 1.5 * abs(left.min())]
    return robust_std(left[np.abs(left) < 2.5 * robust_std(left)])


def dff(x: np.ndarray, short: int, long: int, percentile: float = 10, noise=noise_std) -> tuple[np.ndarray, float, int]:
    """(F - baseline) / max(baseline, noise), its own noise, and the frames whose baseline is within the noise.
    Frames three deviations above a low percentile don't count for the baseline."""
    if np.isnan(x).all():
        return x, math.nan, 0
    sigma = noise(x, short)
    if 0 < percentile < 100:
        base = known_median_filter(np.where(x > percentile_filter(x, long, percentile) + 3 * sigma, np.nan, x), long)
    else:
        base = median_filter(x, long)
    out = (x - base) / np.maximum(base, sigma)
    return out, noise(out, short), int((base <= sigma).sum())


def half_sample_mode(x: np.ndarray) -> float:
    """Mode by halving: the shortest half of the sorted values again and again. Of three values the closer
    two are averaged if they are the lower ones, else the middle one counts; NaN counts as -999, last."""
    x = np.sort(x)
    x = np.where(np.isnan(x), -999.0, x)
    while len(x) > 3:
        n = len(x) // 2 + len(x) % 2
        j = int(np.argmin(x[n - 1 : 2 * n - 1] - x[:n]))
        x = x[j : j + n]
    if len(x) == 3:
        lower, upper = x[1] - x[0], x[2] - x[1]
        # the second test of the rule can't hold when the first fails
        return float(x[:2].mean() if lower < upper else x[1])
    return float(x.mean())


def tail_log(z: np.ndarray) -> np.ndarray:
    """Logarithm of the normal distribution's upper tail."""
    tail = np.array([0.5 * math.erfc(v / math.sqrt(2)) if v == v else math.nan for v in z])
    with np.errstate(divide="ignore"):
        return np.log(tail)


def activity(x: np.ndarray, frames: int = 5) -> np.ndarray:
    """Sum of tail logarithms of the last ``frames`` frames; the deviation is that of values below the mode."""
    middle = half_sample_mode(x)
    below = middle - x[x < middle]
    sigma = math.sqrt((below**2).sum() / len(below)) if len(below) else math.nan
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = tail_log((x - middle) / (3 * sigma))
    return np.array([logs[max(0, k - frames + 1) : k + 1].sum() for k in range(len(x))])


def smooth_split(x: np.ndarray, weight: float) -> np.ndarray:
    """What smoothing with a penalty on steps takes away, by columns: solves (I + weight L'L) s = x, gives s - x."""
    n = len(x)
    diagonal = np.full(n, 1 + 2 * weight)
    diagonal[[0, -1]] = 1 + weight if n > 1 else 1
    ratio, s = np.zeros(n), x.astype(float).copy()
    for k in range(1, n):
        ratio[k] = -weight / diagonal[k - 1]
        diagonal[k] += weight * ratio[k]
        s[k] -= ratio[k] * s[k - 1]
    s[-1] /= diagonal[-1]
    for k in range(n - 2, -1, -1):
        s[k] = (s[k] + weight * s[k + 1]) / diagonal[k]
    return s - x


def contamination_ratio(roi: np.ndarray, neuropil: np.ndarray, folds: int = 4, weight: float = 0.05, reach: float = 2.0, steps=(0.1, 0.01, 0.001)) -> tuple[float, float]:
    """The share r of neuropil that leaves the smoothest rest, and its error: root mean square of roughness over
    the mean signal, averaged over the folds. The rest is linear in r, so a fold's error takes three sums. A fold
    without frames or with a mean signal of zero or less has no error to compare: NaN."""
    size = len(roi) // folds
    if not size or (roi[: size * folds].reshape(folds, size).mean(1) <= 0).any():
        return math.nan, math.nan
    cut = lambda x: x[: size * folds].reshape(folds, size).T
    rough = smooth_split(np.concatenate([cut(roi), cut(neuropil)], axis=1), weight)
    u, v, level = rough[:, :folds], rough[:, folds:], cut(roi).mean(0)
    uu, uv, vv = (u * u).mean(0), (u * v).mean(0), (v * v).mean(0)
    error = lambda r: float((np.sqrt(np.maximum(uu - 2 * r * uv + r * r * vv, 0)) / level).mean())
    lo, hi, best = 0.0, reach, (math.inf, 0.0)
    for step in steps:
        while True:
            grid = np.arange(lo, hi, step)
            errors = [error(r) for r in grid]
            at = int(np.argmin(errors))
            best = min(best, (errors[at], float(grid[at])), key=lambda x: x[0])
            if at < len(grid) - 1 or len(grid) < 2:
                break
            lo, hi = grid[-1], 2 * grid[-1] - grid[0]  # least at the upper end: look further up
        lo, hi = grid[max(at - 1, 0)], grid[min(at + 1, len(grid) - 1)]
    return best[1], best[0]


def decaying_steps(y: np.ndarray, gamma: float, penalty: float) -> np.ndarray:
    """Sizes of the upward jumps of the decaying signal c (c[t] >= gamma c[t-1] >= 0) that is closest to ``y`` when
    each jump costs ``penalty``. The least cost by the current value is kept as quadratic pieces
    (from, to, a, b, c, jump), a jump being (frame, value before it, jump before)."""
    y = [float(v) for v in y]
    pieces = [(0.0, math.inf, 0.5, -y[0], 0.5 * y[0] * y[0], None)]
    for t in range(1, len(y)):
        best, where, origin, out = math.inf, 0.0, None, []

        def flat(lo, hi):
            jump = (t, where, origin)
            if out and out[-1][2] == 0 and out[-1][5][:2] == jump[:2]:
                out[-1] = (out[-1][0], hi, *out[-1][2:])
            elif hi > lo:
                out.append((lo, hi, 0.0, 0.0, best + penalty, jump))

        for lo, hi, a, b, c, jump in pieces:
            x = min(max(-b / (2 * a), lo), hi) if a else lo
            least = a * x * x + b * x + c
            if least > best + penalty:
                flat(lo, hi)
                continue
            start = lo
            if a and a * lo * lo + b * lo + c > best + penalty:
                start = max(lo, (-b - math.sqrt(max(b * b - 4 * a * (c - best - penalty), 0))) / (2 * a))
                flat(lo, start)
            if least < best:
                best, where, origin = least, x, jump
            end = min(hi, (-b + math.sqrt(max(b * b - 4 * a * (c - best - penalty), 0))) / (2 * a)) if a else hi
            end = max(end, x)
            if end > start:
                out.append((start, end, a, b, c, jump))
            if end < hi:
                flat(end, hi)
        v = y[t]
        pieces = [(lo * gamma, hi * gamma, a / gamma**2 + 0.5, b / gamma - v, c + 0.5 * v * v, jump) for lo, hi, a, b, c, jump in out]
    best, value, jump = math.inf, 0.0, None
    for lo, hi, a, b, c, j in pieces:
        x = min(max(-b / (2 * a), lo), hi)
        if a * x * x + b * x + c < best:
            best, value, jump = a * x * x + b * x + c, x, j
    sizes, end = np.zeros(len(y)), len(y) - 1
    while jump is not None:
        at, before, earlier = jump
        sizes[at] = value / gamma ** (end - at) - gamma * before
        value, end, jump = before, at - 1, earlier
    return sizes


def events(x: np.ndarray, gamma: float, least: float, finest: float = 1e-4) -> tuple[np.ndarray, float]:
    """Events under the least penalty (to ``finest``) with which none is smaller than ``least``; where no penalty
    leaves any such event, under the highest penalty tried that leaves some. The bracket is doubled, then halved."""
    lo, hi, kept, found, below = 0.0, 0.1, None, None, None
    while found is None or hi - lo > finest:
        penalty = hi if found is None else (lo + hi) / 2
        # the least cost is a line for each number of jumps: of two that differ by one, the other holds up to where both cost the same
        if found is not None and below is not None and below[1] == len(found[0].nonzero()[0]) + 1:
            turn = _cost(x, found[0], gamma) - below[2]
            if abs(penalty - turn) > 1e-9 * max(1.0, abs(turn)):
                if penalty < turn:
                    lo, kept = penalty, (below[0], penalty)
                else:
                    hi, found = penalty, (found[0], penalty)
                continue
        sizes = decaying_steps(x, gamma, penalty)
        some = sizes[sizes > 0]
        if len(some) and some.min() < least:
            lo, kept, hi = penalty, (sizes, penalty), (2 * hi if found is None else hi)
            below = sizes, len(some), _cost(x, sizes, gamma)
        else:
            hi, found = penalty, (sizes, penalty)
    return found if found[0].any() or kept is None else kept


def _cost(y: np.ndarray, sizes: np.ndarray, gamma: float) -> float:
    """Half the squared distance from ``y`` of the decaying signal with these jumps, its first value the best (0 at least)."""
    n = len(y)
    own, made, level = gamma ** np.arange(n), np.zeros(n), 0.0
    for t in range(n):
        level = gamma * level + sizes[t]
        made[t] = level
    left = y - made
    left = left - max(0.0, float(own @ left) / float(own @ own)) * own
    return 0.5 * float(left @ left)


def whitened(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` without mean and correlation, and the symmetric matrix that does it (the inverse root of the covariance)."""
    x = x - x.mean(axis=1, keepdims=True)
    spread, axes = np.linalg.eigh(x @ x.T / x.shape[1])
    root = axes / np.sqrt(spread) @ axes.T
    return root @ x, root


def _orthonormal(w: np.ndarray) -> np.ndarray:
    """The closest turns (or mirrored ones) to 2 by 2 matrices in closed form: (w w')^(-1/2) w."""
    (a, b), (c, d) = w[..., 0, :].T, w[..., 1, :].T
    sign = np.where(a * d - b * c < 0, -1.0, 1.0)
    p, q = a + sign * d, b - sign * c
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / np.hypot(p, q), q / np.hypot(p, q)
    return np.stack([np.stack([p, q], -1), np.stack([-sign * q, sign * p], -1)], -2)


def independent_pairs(pairs: list[np.ndarray], starts: np.ndarray, steps: int = 10_000, close: float = 1e-4) -> np.ndarray:
    """The rotations of whitened pairs of rows towards independence, from the matrices ``starts``: Hyvarinen's fixed point with
    tanh, both rows of all pairs at a time. Pairs of about a length go side by side, and leave once they have come to rest."""
    out = _orthonormal(starts)
    size = np.array([x.shape[1] for x in pairs])
    order = np.argsort(size, kind="stable")
    while len(order):
        # as many as fill the cells when all are as long as the longest of them, one at least
        fit = size[order] * np.arange(1, len(order) + 1) <= _CELLS // 4
        some, order = np.split(order, [max(1, int(np.argmin(fit)) if not fit.all() else len(order))])
        x = np.zeros((2, len(some), int(size[some].max())))
        for k, i in enumerate(some):
            x[:, k, : size[i]] = pairs[i]  # zeros behind the end add nothing
        n, w = size[some].astype(float), out[some]
        for _ in range(steps):
            g = [np.tanh(w[:, i, 0, None] * x[0] + w[:, i, 1, None] * x[1]) for i in (0, 1)]
            new = np.stack([np.stack([np.einsum("kn,kn->k", g[i], x[j]) / n - (1 - np.einsum("kn,kn->k", g[i], g[i]) / n) * w[:, i, j] for j in (0, 1)], -1) for i in (0, 1)], -2)
            new = _orthonormal(new)
            rest = np.abs(np.abs((new * w).sum(axis=2)) - 1).max(axis=1) < close
            w = new
            if rest.any():
                out[some[rest]] = w[rest]
                some, n, w, x = some[~rest], n[~rest], w[~rest], x[:, ~rest]
                if not len(some):
                    break
        out[some] = w
    return out


def unmixed_all(pairs: list[np.ndarray], tries: int, seeds) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """``unmixed`` of many pairs of traces, each with its seed."""
    out, held = [(x, np.eye(2), False) for x in pairs], {}
    for i, x in enumerate(pairs):
        if x.shape[1] >= 3 and np.linalg.matrix_rank(x - x.mean(axis=1, keepdims=True)) == 2:
            held[i] = (*whitened(x), np.random.RandomState(int(seeds[i])))
    for k in range(tries + 1):
        if not held:
            break
        turns = independent_pairs([white for white, _, _ in held.values()], np.array([rng.normal(size=(2, 2)) for _, _, rng in held.values()]))
        for (i, (_, root, _)), turn in zip(list(held.items()), turns):
            raw = np.linalg.inv(root) @ np.linalg.pinv(turn)
            mixing = raw * np.linalg.solve(raw, np.ones(2))
            done = k < tries and bool(((0 <= mixing[[0, 1], [1, 0]]) & (mixing[[0, 1], [1, 0]] <= 0.3)).all())
            if not done and k < tries:
                continue
            sources = np.linalg.solve(mixing, pairs[i])
            like = np.abs(np.corrcoef(np.vstack([sources[:1], pairs[i]]))[0, 1:])
            if like[0] <= like[1]:
                sources, mixing = sources[::-1], mixing[:, ::-1]
            out[i] = sources, mixing, done
            del held[i]
    return out


def unmixed(x: np.ndarray, tries: int, seed: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Sources of two mixed traces, the mixing matrix (rows sum to 1), and whether its off-diagonal parts lie within 0 and 0.3.

    Up to ``tries`` fits from one random stream are judged; if none is good, the one after them counts. The source that is
    closest to the first trace comes first; where the order is turned, so are the matrix's columns.
    """
    return unmixed_all([x], tries, [seed])[0]
