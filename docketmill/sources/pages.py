"""Files to pages: a hook for a page extractor, with its retry and its error rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: (path, bytes, plain) to the pages' texts; plain asks for the simpler mode of a second try.
Extractor = Callable[[str, bytes, bool], list[str]]


def extract_pages(files: DataFrame, extractor: Extractor, tries: int = 2, pause: float = 0.5) -> DataFrame:
    """files (path, content) to path, pag, text, error: a row for each page, or one row with the error.

    The first failure is tried again in the plain mode after a pause; one file is in memory at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pages, error = [], None
                for k in range(tries):
                    try:
                        pages, error = extractor(path, content or b"", k > 0), None
                        break
                    except Exception as e:  # noqa: BLE001  the error becomes a row
                        error = str(e)
                        if k + 1 < tries:
                            time.sleep(pause)
                rows = [(path, i, t, None) for i, t in enumerate(pages, 1)] if error is None else [(path, None, None, error)]
                cols = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string()))], ["path", "pag", "text", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, pag int, text string, error string")


def text_pages(path: str, content: bytes, plain: bool) -> list[str]:
    """The extractor of plain text files: pages end with a form feed."""
    return content.decode("utf-8", "replace").split("\f")


def page_hash(layout: str) -> str:
    import hashlib

    return hashlib.md5(layout.encode()).hexdigest()[:16]


def dots_per_inch(width: float, height: float, limits: tuple[float, float] = (1200.0, 800.0)) -> int:
    """200 for large pages, 250 for middling ones, 300 for small ones, by the longer side in points."""
    side = max(width, height)
    return 200 if side > limits[0] else 250 if side > limits[1] else 300


# Reading modes in their order, the quality that is good enough, the lift of the threshold, the level of
# images of one grey, and entries of the page cache.
MODES, ENOUGH, LIFT, FLAT_LEVEL, CACHED = (3, 6, 4), 0.85, 10, 128, 4000


def best_reading(modes: list[int] | tuple[int, ...], read: Callable[[int], str], quality: Callable[[str], float], enough: float = ENOUGH) -> str:
    """The best text of several reading modes, if its quality is above zero; stops at one that is good enough."""
    readings: list[tuple[float, int, str]] = []
    for k, mode in enumerate(modes):
        text = read(mode)
        readings.append((quality(text), -k, text))
        if readings[-1][0] >= enough:
            break
    return max([r for r in readings if r[0] > 0], default=(0.0, 0, ""))[2]


class PageCache:
    """Texts of pages by page hash, resolution and mode, in one worker; when it is full the oldest half goes."""

    def __init__(self, most: int = CACHED):
        self.most, self.held = most, {}

    def read(self, key: str, make: Callable[[], str]) -> str:
        if key not in self.held:
            if len(self.held) >= self.most:
                self.held = dict(list(self.held.items())[self.most // 2 :])
            self.held[key] = make()
        return self.held[key]


def otsu_threshold(gray) -> int:
    """The level that parts an image's grey values with the most variance between the parts; 128 for one grey."""
    import numpy as np

    counts = np.bincount(np.asarray(gray, np.uint8).ravel(), minlength=256).astype(float)
    below = np.cumsum(counts)
    mass = np.cumsum(counts * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.nan_to_num(below * above * (mass / below - (mass[-1] - mass) / above) ** 2)
    return int(between.argmax()) if between.max() > 0 else FLAT_LEVEL


def binarize(gray, lift: int = LIFT):
    """White from `lift` above the threshold on, else black."""
    import numpy as np

    image = np.asarray(gray, np.uint8)
    return np.where(image >= min(255, otsu_threshold(image) + lift), 255, 0).astype(np.uint8)


def smallest_rectangle_angle(x, y) -> float:
    """The tilt in degrees, between -45 and 45, of the rectangle of least area around points."""
    import numpy as np

    points = np.unique(np.stack([x, y], axis=1), axis=0).astype(float)
    hull = _hull(points)
    if len(hull) < 2:
        return 0.0
    edges = np.diff(np.vstack([hull, hull[:1]]), axis=0)
    angles = np.arctan2(edges[:, 1], edges[:, 0])
    turn = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    along, across = hull @ turn.T, hull @ np.stack([-turn[:, 1], turn[:, 0]])
    area = np.ptp(along, axis=0) * np.ptp(across, axis=0)
    angle = float(np.degrees(angles[area.argmin()]))
    return (angle + 45) % 90 - 45


def _hull(points):
    """Corners of the convex hull of points in lexicographic order."""
    import numpy as np

    def half(rows):
        out = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(points) + half(points[::-1])) if len(points) > 2 else points


def skew_angle(gray, least: float = 0.5, most: float = 15.0) -> float:
    """The tilt in degrees of the smallest rectangle around the dark pixels; 0 where it is not within the corrected range."""
    import numpy as np

    y, x = np.nonzero(np.asarray(gray) < 128)
    if len(x) < 2:
        return 0.0
    angle = smallest_rectangle_angle(x, y)
    return angle if least <= abs(angle) <= most else 0.0


def deskew(gray):
    """The image turned back by its tilt around its centre, by nearest pixels, white where there was none."""
    import numpy as np

    image = np.asarray(gray, np.uint8)
    angle = np.radians(skew_angle(image))
    if not angle:
        return image
    height, width = image.shape
    y, x = np.mgrid[:height, :width]
    dx, dy = x - (width - 1) / 2, y - (height - 1) / 2
    sx = np.rint(np.cos(angle) * dx - np.sin(angle) * dy + (width - 1) / 2).astype(int)
    sy = np.rint(np.sin(angle) * dx + np.cos(angle) * dy + (height - 1) / 2).astype(int)
    inside = (sx >= 0) & (sx < width) & (sy >= 0) & (sy < height)
    return np.where(inside, image[np.clip(sy, 0, height - 1), np.clip(sx, 0, width - 1)], 255).astype(np.uint8)
