"""Image operators over decoded gray matrices (page, h, w, gray: bytes by row), as numpy functions behind Arrow UDFs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix(h: int, w: int, gray: bytes) -> np.ndarray:
    return np.frombuffer(gray, np.uint8).reshape(h, w)


def mapped(pages: DataFrame, work, schema: str, kept: str = "page") -> DataFrame:
    """work(matrix) -> a tuple of the schema's values, for every page."""
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(batches):
        for frame in batches:
            out = [work(matrix(h, w, g)) for h, w, g in zip(frame.h, frame.w, frame.gray, strict=True)]
            yield pd.concat([frame[[kept]].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    return pages.select(kept, "h", "w", "gray").mapInPandas(run, f"{kept} long, {schema}")


def pixel_rows(pages: DataFrame) -> DataFrame:
    """(page, h, y, max_px, white_share): one row per pixel row, white being above 245."""

    def run(batches):
        for frame in batches:
            for page, h, w, g in zip(frame.page, frame.h, frame.w, frame.gray, strict=True):
                m = matrix(h, w, g)
                yield pd.DataFrame({"page": page, "h": h, "y": np.arange(h), "max_px": m.max(1).astype(int), "white_share": (m > 245).mean(1)})

    return pages.select("page", "h", "w", "gray").mapInPandas(run, "page long, h int, y int, max_px int, white_share double")


# --- filters by hand: no image library is needed -------------------------------------------------------------------
def mirrored(m: np.ndarray, by: int = 1) -> np.ndarray:
    """Padded by reflection about the edge pixel, or by the edge where there is nothing to reflect."""
    return np.pad(m.astype(float), by, mode="reflect" if min(m.shape) > by else "edge")


def laplacian(m: np.ndarray) -> np.ndarray:
    p = mirrored(m)
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]


def blurred(m: np.ndarray) -> np.ndarray:
    """Gaussian blur by 1 2 1, rounded to whole levels."""
    p = mirrored(m)
    rows = p[:-2] + 2 * p[1:-1] + p[2:]
    return np.rint((rows[:, :-2] + 2 * rows[:, 1:-1] + rows[:, 2:]) / 16)


def otsu(m: np.ndarray) -> int:
    """The level that separates dark from light with the greatest variance between both."""
    count = np.bincount(m.ravel(), minlength=256).astype(float)
    weight, mass = np.cumsum(count), np.cumsum(count * np.arange(256))
    rest = weight[-1] - weight
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.where((weight > 0) & (rest > 0), weight * rest * (mass / weight - (mass[-1] - mass) / rest) ** 2, 0)
    return int(np.argmax(between))


def quality(m: np.ndarray) -> tuple:
    """Size, ratio, sharpness, contrast, brightness, ink, ink at the border, fine energy, and two flags."""
    h, w = m.shape
    ink = m <= otsu(m)
    border = float(np.mean([ink[0].mean(), ink[-1].mean(), ink[:, 0].mean(), ink[:, -1].mean()]))
    size = w / max(1, h)
    return w, h, size, float(laplacian(m).var()), float(m.std()), float(m.mean()), float(ink.mean()), float(1 - ink.mean()), border, float(np.abs(laplacian(blurred(m))).mean()), int(h < 18), int(size > 15)


QUALITY = "w int, h int, ratio double, lap_var double, std double, mean double, black double, white double, edge_ink double, jpeg_hf double, too_small_h int, crazy_ratio int"


def three_channels(m: np.ndarray) -> np.ndarray:
    """Gray, one-channel or four-channel images as three channels."""
    if m.ndim == 2:
        m = m[:, :, None]
    return np.repeat(m, 3, axis=2) if m.shape[2] == 1 else m[:, :, :3]


def resized(m: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear, sampled at pixel centres."""
    ys = np.clip((np.arange(h) + 0.5) * m.shape[0] / h - 0.5, 0, m.shape[0] - 1)
    xs = np.clip((np.arange(w) + 0.5) * m.shape[1] / w - 0.5, 0, m.shape[1] - 1)
    y0, x0 = ys.astype(int), xs.astype(int)
    y1, x1 = np.minimum(y0 + 1, m.shape[0] - 1), np.minimum(x0 + 1, m.shape[1] - 1)
    fy, fx = (ys - y0)[:, None], (xs - x0)[None, :]
    f = m.astype(float)
    top = f[y0][:, x0] * (1 - fx) + f[y0][:, x1] * fx
    low = f[y1][:, x0] * (1 - fx) + f[y1][:, x1] * fx
    return top * (1 - fy) + low * fy


def letterbox(m: np.ndarray, h: int, w: int) -> np.ndarray:
    """Scaled to the height, cut or padded with white to the width."""
    new_w = max(1, int(m.shape[1] * h / m.shape[0]))
    scaled = np.rint(resized(m, h, new_w)).astype(np.uint8)
    return scaled[:, :w] if new_w >= w else np.pad(scaled, ((0, 0), (0, w - new_w)), constant_values=255)


def recognition_input(m: np.ndarray, h: int = 48, w: int = 320) -> np.ndarray:
    """Scaled within h x w keeping its ratio, to -1..1, zero beyond."""
    size = m.shape[1] / m.shape[0]
    new_h, new_w = (max(1, int(w / size)), w) if size > w / h else (h, max(1, int(h * size)))
    out = np.zeros((h, w), np.float32)
    out[:new_h, :new_w] = resized(m, new_h, new_w) / 255 * 2 - 1
    return out


def warped(m: np.ndarray, quad: np.ndarray) -> np.ndarray:
    """The quadrilateral (top left, top right, bottom right, bottom left) as an upright image, edges held."""
    w, h = int(np.linalg.norm(quad[0] - quad[1])), int(np.linalg.norm(quad[0] - quad[3]))
    if w < 2 or h < 2:
        raise ValueError("the quadrilateral is too small")
    target = np.array([[0, 0], [w, 0], [w, h], [0, h]], float)
    rows, right = [], []
    for (u, v), (x, y) in zip(target, np.asarray(quad, float), strict=True):
        rows += [[u, v, 1, 0, 0, 0, -u * x, -v * x], [0, 0, 0, u, v, 1, -u * y, -v * y]]
        right += [x, y]
    t = np.append(np.linalg.solve(np.array(rows), np.array(right)), 1).reshape(3, 3)
    grid = np.stack([*np.meshgrid(np.arange(w), np.arange(h)), np.ones((h, w))])
    x, y, z = np.tensordot(t, grid, 1)
    xs, ys = (np.clip(np.nan_to_num(c / z), 0, n - 1) for c, n in ((x, m.shape[1]), (y, m.shape[0])))
    x0, y0 = xs.astype(int), ys.astype(int)
    x1, y1 = np.minimum(x0 + 1, m.shape[1] - 1), np.minimum(y0 + 1, m.shape[0] - 1)
    fx, fy, f = xs - x0, ys - y0, m.astype(float)
    return np.rint((f[y0, x0] * (1 - fx) + f[y0, x1] * fx) * (1 - fy) + (f[y1, x0] * (1 - fx) + f[y1, x1] * fx) * fy).astype(np.uint8)


def best_cut(m: np.ndarray, longest: int, shortest: int = 40, back: int = 80, window: int = 10) -> int:
    """The column to cut at: the middle of the emptiest window before ``longest``, by sums of dark pixels up to each column."""
    dark = np.concatenate(([0], np.cumsum((m < 200).sum(0))))
    first, last = max(shortest, longest - back), min(longest, m.shape[1])
    places = np.arange(first, last - window + 1)
    return int(places[np.argmin(dark[places + window] - dark[places])]) + window // 2 if len(places) else last


def split_long(m: np.ndarray, most: float = 12.0, shortest: int = 40) -> list[np.ndarray]:
    """Pieces of a line, cut where it is emptiest, none wider than about ``most`` times its height; a last column alone is left out."""
    h, w = m.shape
    if not m.size:
        return []
    n = max(1, int(np.ceil(w / h / most)))
    edges = [0]
    while len(edges) < n and edges[-1] + w // n < w:
        ahead = m[:, edges[-1] : edges[-1] + w // n]
        edges.append(edges[-1] + max(shortest, best_cut(ahead, ahead.shape[1])))
    if edges[-1] < w - 1 or len(edges) == 1:
        edges.append(w)
    return [m[:, a:b] for a, b in zip(edges, edges[1:], strict=False)]


def correlation(m: np.ndarray, template: np.ndarray, band: int = 64) -> np.ndarray:
    """Normalised cross-correlation of a template at every place; 0 where either is flat.  A band of rows at a time is held."""
    th, tw = template.shape
    if m.shape[0] < th or m.shape[1] < tw:
        return np.zeros((0, 0))
    t = template - template.mean()
    out = []
    for y in range(0, m.shape[0] - th + 1, band):
        views = np.lib.stride_tricks.sliding_window_view(m[y : y + band + th - 1].astype(float), (th, tw))
        dots = np.einsum("yxij,ij->yx", views, t)
        spread = views.var((2, 3)) * th * tw
        norm = np.sqrt(np.maximum(spread, 0) * (t * t).sum())
        out.append(np.divide(dots, norm, out=np.zeros_like(dots), where=norm > 1e-9))
    return np.vstack(out)


def without_templates(m: np.ndarray, templates: list[np.ndarray], least: float = 0.3, foot: int = 200) -> np.ndarray:
    """The rows of each template's lowest hit cut out, as long as any hits; then the foot."""
    hit = True
    while hit:
        hit = False
        for t in templates:
            found = np.argwhere(correlation(m, t) >= least)
            if len(found):
                y = int(found[:, 0].max())
                m = np.vstack((m[:y], m[y + len(t) :]))
                hit = True
                break
    return m[:-foot] if foot else m


def popup_box(scores: np.ndarray, shape: tuple[int, int], least: float = 0.7) -> tuple[int, int, int, int] | None:
    """x0, y0, x1, y1 of the lowest hit, of its row the leftmost."""
    found = np.argwhere(scores >= least)
    if not len(found):
        return None
    y = int(found[:, 0].max())
    x = int(found[found[:, 0] == y, 1].min())
    return x, y, x + shape[1], y + shape[0]


def patched(view: np.ndarray, after: np.ndarray, box: tuple[int, int, int, int], scroll: int = 835) -> np.ndarray:
    """The box of a view filled from the next view, scrolled; the view itself where the patch does not fit."""
    x0, y0, x1, y1 = box
    patch = after[max(0, y0 - scroll) : min(y1 - scroll, after.shape[0]) if y1 > scroll else 0, x0:x1]
    if patch.shape != (y1 - y0, x1 - x0):
        return view
    out = view.copy()
    out[y0:y1, x0:x1] = patch
    return out


def overlap(first: np.ndarray, second: np.ndarray, most: int = 300, least: int = 20) -> int:
    """The number of rows in which the end of one view is most like the start of the next; 0 if none can be compared."""
    scores = {y: np.abs(first[-y:].astype(int) - second[:y].astype(int)).mean() for y in range(least, min(most, len(first) + 1, len(second) + 1))}
    return min(scores, key=scores.get, default=0)


def stitched(views: list[np.ndarray], box: tuple[int, int, int, int] = (400, 80, 1500, 880), repeated: int = 370) -> np.ndarray:
    """Views cut to a box, those after the first without the rows that repeat, one below the other."""
    x0, y0, x1, y1 = box
    parts = [v[y0:y1, x0:x1] for v in views]
    return np.vstack([parts[0], *(p[repeated:] for p in parts[1:])])


def slices(m: np.ndarray, cuts: list[int], window: int | None = None) -> list[np.ndarray]:
    """The image between neighbouring cuts, all of its width or ``window`` columns from the tenth on."""
    cut = m if window is None else m[:, 10 : 10 + window]
    return [cut[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def paper(width: int = 640, height: int = 480, seed: int = 0) -> np.ndarray:
    """A sheet of paper: white with noise, a yellowing gradient, and ten gray stains."""
    rng = np.random.default_rng(seed)
    base = np.minimum(255, 255 + rng.normal(0, 25, (height, width)))
    sheet = 0.7 * base + 0.3 * np.linspace(230, 255, width)
    y, x = np.ogrid[:height, :width]
    for _ in range(10):
        cx, cy, r, level = rng.integers(0, width), rng.integers(0, height), rng.integers(10, 40), rng.integers(180, 230)
        sheet[(x - cx) ** 2 + (y - cy) ** 2 <= r * r] = level
    return np.clip(np.rint(sheet), 0, 255).astype(np.uint8)


def from_text(text: Column, width: int = 64) -> list[Column]:
    """A stand-in image: the text's bytes as gray levels, a fixed width, at least 32 rows."""
    raw = F.rpad(text.cast("binary"), F.greatest(F.lit(32 * width), (F.octet_length(text) / width).cast("int") * width), F.lit(b"\xff"))
    return [raw.alias("gray"), (F.octet_length(raw) / width).cast("int").alias("h"), F.lit(width).alias("w")]
