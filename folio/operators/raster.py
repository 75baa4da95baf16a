"""Pages as pixels: steps that prepare a picture, and the lines of a table's grid found in it.

A raster is a row (width, height, pixels: one byte of grey per place, row by row; `channels` 3 for red, green, blue). Each step works on a whole picture in numpy, a batch of rows at a time;
pictures do not depend on each other, so nothing is shuffled. Sums are whole numbers, so results depend on no order. A picture whose pixels do not fill its width and height is null in all results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tiles a side and clip limit of the contrast step; window and offset of the threshold; spread and strength of sharpening; weights of red, green and blue in 1/16384.
TILES, CLIP = 8, 2.0
WINDOW, OFFSET = 35, 10
SHARP_WINDOW, SHARP_SIGMA = 7, 1.0
GREY = (4899, 9617, 1868)
# Share of a picture's side that a line has at least, by sensitivity; least length of a line; places between two lines; places within which lines are one.
SCALE, SHORTEST, GAP, TOLERANCE = {"normal": 80, "high": 50}, 10, 5, 2


def weights(size: int, sigma: float | None = None) -> np.ndarray:
    """A bell curve of `size` whole numbers that sum to 65,536; without a sigma the window's own: 0.3 ((size - 1) / 2 - 1) + 0.8."""
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.exp(-((np.arange(size) - (size - 1) / 2) ** 2) / (2 * sigma * sigma))
    w = np.rint(x / x.sum() * 65536).astype(np.int64)
    w[size // 2] += 65536 - w.sum()
    return w


def blurred(image: np.ndarray, w: np.ndarray, edge: str) -> np.ndarray:
    """The weighted mean of each place's surroundings, rounded; `edge` says what lies beyond the picture (numpy.pad)."""
    r = len(w) // 2
    x = np.pad(image.astype(np.int64), r, edge)
    x = sum(int(k) * x[:, i : i + image.shape[1]] for i, k in enumerate(w))
    x = sum(int(k) * x[i : i + image.shape[0]] for i, k in enumerate(w))
    return (x + (1 << 31)) >> 32


def reflected(image: np.ndarray) -> str:
    """The edge that mirrors a picture about its last places; one place wide has no other."""
    return "reflect" if min(image.shape) > 1 else "edge"


def adaptive(image: np.ndarray) -> np.ndarray:
    """White where a place is brighter than the mean around it less OFFSET, else black."""
    return np.where(image > blurred(image, weights(WINDOW), "edge") - OFFSET, 255, 0).astype(np.uint8)


def unsharp(image: np.ndarray) -> np.ndarray:
    """Half again the picture less half of the blurred one."""
    soft = blurred(image, weights(SHARP_WINDOW, SHARP_SIGMA), reflected(image))
    return np.clip((3 * image.astype(np.int64) - soft + 1) // 2, 0, 255).astype(np.uint8)


def tile_curves(tiles: np.ndarray) -> np.ndarray:
    """(tile, 256) -> the new brightness of each old one: the share of places no brighter, with counts above the clip limit dealt out evenly. tiles: (tile, places)."""
    n, area = tiles.shape
    counts = np.bincount((np.arange(n)[:, None] * 256 + tiles).ravel(), minlength=n * 256).reshape(n, 256)
    limit = max(1, int(CLIP * area / 256))
    over = np.maximum(counts - limit, 0).sum(1)
    counts = np.minimum(counts, limit) + (over // 256)[:, None]
    rest = over % 256
    step = np.maximum(256 // np.maximum(rest, 1), 1)
    at = np.arange(256)
    counts += (at % step[:, None] == 0) & (at // step[:, None] < rest[:, None])
    return (counts.cumsum(1) * 510 + area) // (2 * area)


def clahe(image: np.ndarray) -> np.ndarray:
    """Contrast by tiles (TILES a side): each place takes the curves of its four nearest tiles, weighted by nearness. Pictures that tiles do not divide are mirrored on the right and below."""
    h, w = image.shape
    th, tw = -(-h // TILES), -(-w // TILES)
    x = image
    while x.shape != (th * TILES, tw * TILES):  # mirrored more than once only if a picture is smaller than what it lacks
        more = (min(th * TILES - x.shape[0], max(x.shape[0] - 1, 1)), min(tw * TILES - x.shape[1], max(x.shape[1] - 1, 1)))
        x = np.pad(x, ((0, more[0]), (0, more[1])), reflected(x))
    curves = np.minimum(tile_curves(x.reshape(TILES, th, TILES, tw).swapaxes(1, 2).reshape(TILES * TILES, th * tw)), 255).reshape(TILES, TILES, 256)

    def near(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tile before and after each place, and how much of the latter, in 1 / (2 size)."""
        p = 2 * np.arange(n) + 1 - size
        first = p // (2 * size)
        return np.clip(first, 0, TILES - 1), np.clip(first + 1, 0, TILES - 1), p - first * 2 * size

    (y0, y1, fy), (x0, x1, fx) = near(h, th), near(w, tw)
    gy, gx = 2 * th - fy, 2 * tw - fx
    at = lambda y, x: curves[y[:, None], x[None, :], image]
    total = gy[:, None] * (gx * at(y0, x0) + fx * at(y0, x1)) + fy[:, None] * (gx * at(y1, x0) + fx * at(y1, x1))
    whole = 4 * th * tw
    return ((2 * total + whole) // (2 * whole)).astype(np.uint8)


def grey(image: np.ndarray) -> np.ndarray:
    """One channel of three."""
    if image.ndim == 2:
        return image
    return ((image.astype(np.int64) @ np.array(GREY) + 8192) >> 14).astype(np.uint8)


#: name -> function of a grey picture; further steps register here.
STEPS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"grayscale": grey, "clahe": clahe, "unsharp": unsharp, "adaptive": adaptive}


def steps_of(names: object) -> list[str]:
    """The names of steps as given: one, a list (what is no text in it is left out), or none."""
    given = [names] if isinstance(names, str) else names if isinstance(names, (list, tuple)) else []
    return [n.strip().lower() for n in given if isinstance(n, str) and n.strip()]


def _pictures(batch: tuple[pa.Array, ...]) -> Iterator[np.ndarray | None]:
    for w, h, c, p in zip(*(x.to_pylist() for x in batch)):
        fits = None not in (w, h, c, p) and w > 0 and h > 0 and c in (1, 3) and len(p) == w * h * c
        yield np.frombuffer(p, np.uint8).reshape((h, w) if c == 1 else (h, w, 3)) if fits else None


def prepared(width: Column, height: Column, pixels: Column, steps: object, channels: Column | None = None) -> Column:
    """The grey pixels after the steps, in their order. A name that is no step is an error at once, not a step left out."""
    names = steps_of(steps)
    if unknown := [n for n in names if n not in STEPS]:
        raise ValueError(f"unknown steps: {', '.join(unknown)}")
    todo = [STEPS[n] for n in names]

    @F.arrow_udf("binary")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for b in batches:
            out = []
            for x in _pictures(b):
                if x is not None:
                    x = grey(x)
                    for f in todo:
                        x = f(x)
                out.append(None if x is None else x.tobytes())
            yield pa.array(out, pa.binary())

    return run(width, height, F.lit(1) if channels is None else channels, pixels)


def dark_level(image: np.ndarray) -> int:
    """Otsu's level: that which parts the places into two classes whose means lie furthest apart for their sizes; the least of equals."""
    counts = np.bincount(image.ravel(), minlength=256).astype(np.int64)
    n, total = counts.sum(), (counts * np.arange(256)).sum()
    low, held = counts.cumsum(), (counts * np.arange(256)).cumsum()
    both = (low > 0) & (low < n)
    apart = np.where(both, (total * low - held * n).astype(float) ** 2 / np.where(both, low * (n - low), 1).astype(float), 0.0)
    return int(apart.argmax())


def ink(image: np.ndarray) -> np.ndarray:
    """Which places are drawn: the rarer of the two classes of the softened picture."""
    soft = blurred(image, np.array([16384, 32768, 16384]), reflected(image))
    light = soft > dark_level(soft)
    return ~light if light.sum() * 255 > 127 * light.size else light


def long_runs(marks: np.ndarray, least: int) -> np.ndarray:
    """The marks that lie, along their row, in runs of at least `least`."""
    x = np.zeros((marks.shape[0], marks.shape[1] + 2), np.int8)
    x[:, 1:-1] = marks
    edge = np.diff(x, axis=1)
    begin, end = np.argwhere(edge == 1), np.argwhere(edge == -1)
    keep = end[:, 1] - begin[:, 1] >= least
    out = np.zeros((marks.shape[0], marks.shape[1] + 1), np.int32)
    np.add.at(out, tuple(begin[keep].T), 1)
    np.add.at(out, tuple(end[keep].T), -1)
    return out.cumsum(axis=1)[:, :-1] > 0


def peaks(profile: np.ndarray) -> list[int]:
    """Middles of the groups of places that hold more than a tenth of the most (and more than 5); places up to GAP apart are one group, and of middles within TOLERANCE the first stays."""
    at = np.flatnonzero(profile > max(5, int(profile.max(initial=0)) // 10))
    if not len(at):
        return []
    out: list[int] = []
    for g in np.split(at, np.flatnonzero(np.diff(at) > GAP) + 1):
        middle = int(g.sum() // len(g))
        if not out or middle - out[-1] > TOLERANCE:
            out.append(middle)
    return out


def grid_lines(image: np.ndarray, sensitivity: str = "normal") -> tuple[list[int], list[int]]:
    """(heights of the lines across, places of the lines down) of a picture."""
    marks, (h, w) = ink(grey(image)), image.shape[:2]
    across = long_runs(marks, max(SHORTEST, w // SCALE[sensitivity]))
    down = long_runs(marks.T, max(SHORTEST, h // SCALE[sensitivity]))
    return peaks(across.sum(axis=1)), peaks(down.sum(axis=1))


def lines(width: Column, height: Column, pixels: Column, sensitivity: str = "normal", channels: Column | None = None) -> Column:
    """struct(rows, cols): where the lines of a grid lie."""

    @F.arrow_udf("rows array<int>, cols array<int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("rows", pa.list_(pa.int32())), ("cols", pa.list_(pa.int32()))])
        for b in batches:
            yield pa.array([None if x is None else dict(zip(("rows", "cols"), grid_lines(x, sensitivity))) for x in _pictures(b)], kind)

    return run(width, height, F.lit(1) if channels is None else channels, pixels)


def tables(rasters: DataFrame, sensitivity: str = "normal") -> DataFrame:
    """(other columns of rasters, rows, cols, cells, mean_width, mean_height): the grid of each picture; fewer than two lines either way make no cells."""
    x = rasters.withColumn("__l", lines(F.col("width"), F.col("height"), F.col("pixels"), sensitivity, F.col("channels") if "channels" in rasters.columns else None))
    x = x.select(*[c for c in rasters.columns if c not in ("width", "height", "pixels", "channels")], "__l.rows", "__l.cols")
    r, c = F.size("rows") - 1, F.size("cols") - 1
    mean = lambda a, n: F.when((r > 0) & (c > 0), F.round((F.element_at(a, -1) - F.element_at(a, 1)) / n, 3))
    return x.withColumns({"cells": F.when((r > 0) & (c > 0), r * c).otherwise(F.lit(0)), "mean_width": mean("cols", c), "mean_height": mean("rows", r)})
