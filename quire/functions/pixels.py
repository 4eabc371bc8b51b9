"""Page images as arrays: grey, speckle, ink, skew and ruled tables. Rows and columns of a grid are found by runs of ink."""

from __future__ import annotations

from collections.abc import Sequence
from math import cos, degrees, radians, sin

import numpy as np

#: Grey below this is ink; skews outside these bounds (degrees) are left alone.
INK = 128
LEAST_SKEW, MOST_SKEW = 0.1, 15.0
#: Fixed values of ruled tables: a rule is a run of this share of the page; a table's share of the page; rules
#: each way; a rule's share of the strongest projection; a cell's pixels, its share of its box, and of the table's sides.
RULE_SHARE, TABLE_SHARE, LEAST_RULES, PROJECTION_SHARE = 1 / 40, 0.02, 3, 0.5
CELL_AREA, CELL_FILL, CELL_SIDE = 100, 0.5, 0.98


def grey(image: np.ndarray) -> np.ndarray:
    """The luma of an RGB image; a grey image as it is."""
    if image.ndim == 2:
        return image
    return np.rint(image[..., :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def denoise(image: np.ndarray) -> np.ndarray:
    """Each pixel's median of the 3 by 3 around it, edges repeated; no pixel moves."""
    padded = np.pad(image, [(1, 1), (1, 1), *[(0, 0)] * (image.ndim - 2)], mode="edge")
    h, w = image.shape[:2]
    return np.median([padded[i : i + h, j : j + w] for i in range(3) for j in range(3)], axis=0).astype(image.dtype)


def otsu(values: np.ndarray) -> int:
    """The grey value that parts the histogram into two classes of the largest variance between them."""
    counts = np.bincount(values.ravel(), minlength=256).astype(np.float64)
    below, mass = np.cumsum(counts), np.cumsum(counts * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return int(np.argmax(np.nan_to_num(between)))


def binarize(image: np.ndarray) -> np.ndarray:
    values = grey(image)
    return np.where(values > otsu(values), 255, 0).astype(np.uint8)


def skew(image: np.ndarray) -> float:
    """The turn, in degrees, that levels the least rectangle around the ink; 0 without ink.

    The rectangle has a side along an edge of the ink's convex hull, so every edge is tried.
    """
    y, x = np.nonzero(grey(image) < INK)
    if len(x) < 2:
        return 0.0
    first, last = (np.unique(y, return_index=True)[1], len(y) - 1 - np.unique(y[::-1], return_index=True)[1])
    ends = np.unique(np.concatenate([np.stack([x[first], y[first]], 1), np.stack([x[last], y[last]], 1)]), axis=0).astype(np.float64)
    hull = _hull(ends)
    edges = np.roll(hull, -1, axis=0) - hull
    angles = np.unique(np.arctan2(edges[:, 1], edges[:, 0]) % (np.pi / 2))
    areas = []
    for a in angles:
        turned = hull @ np.array([[cos(a), -sin(a)], [sin(a), cos(a)]])
        areas.append(np.prod(np.ptp(turned, axis=0)))
    found = degrees(angles[int(np.argmin(areas))])
    return found - 90 if found > 45 else found


def _hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull, from points sorted by x and y (Andrew's monotone chain)."""

    def chain(run: Sequence[np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in run:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1] or out

    return np.array(chain(list(points)) + chain(list(points[::-1])))


def applies(angle: float) -> bool:
    """Whether a skew is worth a turn and not a sign of something else."""
    return LEAST_SKEW <= abs(angle) <= MOST_SKEW


def deskewed(image: np.ndarray) -> tuple[np.ndarray, float, tuple[float, ...]]:
    """The levelled image, the angle and the affine map from the image to it; as it is with (1, 0, 0, 0, 1, 0) if no turn applies."""
    angle = skew(image)
    if not applies(angle):
        return image, 0.0, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
    h, w = image.shape[:2]
    a, b = cos(radians(angle)), sin(radians(angle))
    matrix = (a, b, w / 2 - a * w / 2 - b * h / 2, -b, a, h / 2 + b * w / 2 - a * h / 2)
    y, x = np.mgrid[0:h, 0:w].astype(np.float64)
    dx, dy = x - matrix[2], y - matrix[5]
    at_x, at_y = (np.clip(v, 0, n - 1) for v, n in ((a * dx - b * dy, w), (b * dx + a * dy, h)))
    x0, y0 = np.floor(at_x).astype(int), np.floor(at_y).astype(int)
    x1, y1 = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1)
    fx, fy = ((v - f).reshape(h, w, *[1] * (image.ndim - 2)) for v, f in ((at_x, x0), (at_y, y0)))
    mixed = (image[y0, x0] * (1 - fx) + image[y0, x1] * fx) * (1 - fy) + (image[y1, x0] * (1 - fx) + image[y1, x1] * fx) * fy
    return np.rint(mixed).astype(image.dtype), angle, matrix


def _runs(mask: np.ndarray) -> np.ndarray:
    """Rows (line, start, stop) of the runs of true values along the last axis."""
    edges = np.diff(np.pad(mask.astype(np.int8), [(0, 0), (1, 1)]), axis=1)
    line, start = np.nonzero(edges == 1)
    return np.stack([line, start, np.nonzero(edges == -1)[1]], axis=1)


def long_runs(mask: np.ndarray, least: int) -> np.ndarray:
    """The mask without horizontal runs shorter than `least`."""
    out = np.zeros_like(mask)
    for line, start, stop in _runs(mask):
        if stop - start >= least:
            out[line, start:stop] = True
    return out


def components(mask: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(x, y, w, h, pixels) of the areas of true values that touch, corners included: runs that touch runs of the line before are one."""
    runs = _runs(mask)
    up = list(range(len(runs)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    begin = np.searchsorted(runs[:, 0], np.arange(mask.shape[0] + 1))
    for line in range(1, mask.shape[0]):
        above, own = range(begin[line - 1], begin[line]), range(begin[line], begin[line + 1])
        k = begin[line - 1]
        for i in own:
            while k < above.stop and runs[k, 2] < runs[i, 1]:
                k += 1
            j = k
            while j < above.stop and runs[j, 1] <= runs[i, 2]:
                up[root(i)] = root(j)
                j += 1
    if not len(runs):
        return []
    label = np.array([root(i) for i in range(len(runs))])
    out = []
    for r in np.unique(label):
        line, start, stop = runs[label == r].T
        out.append((int(start.min()), int(line.min()), int(stop.max() - start.min()), int(line.max() - line.min() + 1), int((stop - start).sum())))
    return out


def rule_places(mask: np.ndarray) -> list[int]:
    """The middles of the stretches where the projection of a mask onto its first axis is over half of its largest value."""
    sums = mask.sum(axis=1)
    if not sums.any():
        return []
    return [int(a + b - 1) // 2 for _, a, b in _runs((sums > sums.max() * PROJECTION_SHARE)[None, :])]


def table_grids(image: np.ndarray) -> list[dict]:
    """Ruled tables from the top: box (x, y, w, h), n_rows, n_cols and cells (r0, c0, r1, c1, box).

    Rules are long runs of ink; tables are areas of touching rules with three or more each way; cells are the areas between them.
    """
    values = grey(image)
    ink = values <= otsu(values)
    h, w = ink.shape
    across, down = long_runs(ink, max(1, int(w * RULE_SHARE))), long_runs(ink.T, max(1, int(h * RULE_SHARE))).T
    rules, out = across | down, []
    for x, y, bw, bh, _ in components(rules):
        part = np.s_[y : y + bh, x : x + bw]
        ys, xs = rule_places(across[part]), rule_places(down[part].T)
        if bw * bh < TABLE_SHARE * h * w or min(len(ys), len(xs)) < LEAST_RULES:
            continue
        cells = [c for c in (_cell(box, ys, xs, bw, bh) for box in components(~rules[part])) if c]
        if cells:
            placed = [(r0, c0, r1, c1, (cx + x, cy + y, cw, ch)) for r0, c0, r1, c1, (cx, cy, cw, ch) in cells]
            out.append({"box": (x, y, bw, bh), "n_rows": len(ys) - 1, "n_cols": len(xs) - 1, "cells": placed})
    return sorted(out, key=lambda t: t["box"][1])


def _cell(area: tuple[int, int, int, int, int], ys: list[int], xs: list[int], width: int, height: int) -> tuple | None:
    """An area between rules as a cell with the rules nearest to its sides; None for noise, hollow areas and the whole table."""
    x, y, w, h, pixels = area
    if pixels < max(CELL_AREA, CELL_FILL * w * h) or (w >= CELL_SIDE * width and h >= CELL_SIDE * height):
        return None
    (r0, r1), (c0, c1) = (np.abs(np.array(places)[None, :] - np.array(sides)[:, None]).argmin(axis=1).tolist() for places, sides in ((ys, (y, y + h)), (xs, (x, x + w))))
    return (r0, c0, r1, c1, (x, y, w, h)) if r1 > r0 and c1 > c0 else None
