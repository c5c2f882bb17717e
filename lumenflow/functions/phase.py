"""Shifts between images by phase correlation."""

from __future__ import annotations

import numpy as np


def taper(rows: int, columns: int, slope: float) -> np.ndarray:
    """Weights near 1 inside and falling to 0 at the edges over about ``slope`` pixels, starting two slopes inside."""

    def side(n: int) -> np.ndarray:
        from_middle = np.abs(np.arange(n) - np.arange(n).mean())
        return 1 / (1 + np.exp((from_middle - ((n - 1) / 2 - 2 * slope)) / slope))

    return np.outer(side(rows), side(columns)) if slope > 0 else np.ones((rows, columns))


def blur(rows: int, columns: int, sigma: float) -> np.ndarray:
    """The transform of a centred Gaussian of unit sum."""
    if sigma <= 0:
        return np.ones((rows, columns))
    y, x = (np.exp(-(((np.arange(n) - n // 2) / sigma) ** 2) / 2) for n in (rows, columns))
    g = np.outer(y, x)
    return np.real(np.fft.fft2(np.fft.ifftshift(g / g.sum())))


def whitened(spectrum: np.ndarray) -> np.ndarray:
    """Phases only."""
    return spectrum / (np.abs(spectrum) + 1e-5)


class Reference:
    """An image that frames are held against: its edge weights, their offset, and its phases."""

    def __init__(self, image: np.ndarray, sigma: float, most: float, slope: float = 3.0):
        rows, columns = image.shape
        self.weight = taper(rows, columns, slope * sigma)
        self.offset = image.mean() * (1 - self.weight)
        self.phases = np.conj(whitened(np.fft.fft2(image))) * blur(rows, columns, sigma)
        self.reach = min(round(most * min(rows, columns)), min(rows, columns) // 2)

    def maps(self, frames: np.ndarray) -> np.ndarray:
        """Correlation of each frame with the image for all shifts up to the reach: frame, dy + reach, dx + reach."""
        held = frames * self.weight + self.offset
        whole = np.real(np.fft.ifft2(whitened(np.fft.fft2(held)) * self.phases))
        at = np.arange(-self.reach, self.reach + 1)
        return whole[:, at[:, None] % frames.shape[1], at[None, :] % frames.shape[2]]

    def shifts(self, maps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """dy, dx and the correlation there; of equal ones the first in reading order."""
        flat = maps.reshape(len(maps), -1)
        best = flat.argmax(axis=1)
        width = 2 * self.reach + 1
        return best // width - self.reach, best % width - self.reach, flat[np.arange(len(flat)), best]


def gaussian_weights(sigma: float) -> np.ndarray:
    """Weights of unit sum over four deviations on both sides."""
    half = int(4 * sigma + 0.5)
    w = np.exp(-((np.arange(-half, half + 1) / sigma) ** 2) / 2)
    return w / w.sum()
