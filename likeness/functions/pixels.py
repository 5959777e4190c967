"""NumPy image kernels for batches of decoded images.

Sizes, rounding and constants follow the published behaviour of the common 8-bit
image routines, so that descriptors can be compared with stored ones.
"""

from functools import lru_cache

import numpy as np

# Fixed values of the colour descriptor.
HSV_SIZE = 100
HS_BINS = (12, 12)
V_BINS = 32
LOW_S = 16
LOW_V = 16
LEAST_SHARE = 0.05
# Fixed values of the shape descriptor.
HOG_SIZE = 64
HOG_CELL = 8
HOG_BLOCK = 16
HOG_ORIENTATIONS = 9
HOG_SIGMA = 4.0
HOG_CLIP = 0.2
# Fixed values of the model input.
MODEL_SIZE = 224
MODEL_MEAN = (0.485, 0.456, 0.406)
MODEL_STD = (0.229, 0.224, 0.225)


def to_bgr(data, height, width, channels):
    """Three-channel image from raw bytes; grey is repeated, alpha dropped."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    return pixels[:, :, :3]


def unit(rows: np.ndarray, least: float = 0.0) -> np.ndarray:
    """Rows at unit length; NaN where the norm is not above ``least``."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > least, length, np.nan)


@lru_cache(maxsize=64)
def axis_weights(source: int, target: int, how: str):
    """Bands of the (target x source) matrix that resamples one axis.

    ``area``: overlap of each target cell with the source cells. ``linear``: between
    the two nearest centres. ``near``: what area averaging becomes for enlargement, a
    blend only where a target cell crosses a source border. Each band covers some
    target cells, about eight or those of eight source cells, and just the source rows they need.
    """
    step = source / target
    at = np.arange(target)
    weights = np.zeros((target, source))
    if how == "area":
        low, high = at[:, None] * step, (at[:, None] + 1) * step
        cell = np.arange(source)[None, :]
        weights = np.clip(np.minimum(high, cell + 1) - np.maximum(low, cell), 0.0, None) / step
    else:
        if how == "near":
            left = np.floor(at * step).astype(int)
            share = np.maximum((at + 1) - (left + 1) / step, 0.0)
            share -= np.floor(share)
        else:
            centre = (at + 0.5) * step - 0.5
            left = np.floor(centre).astype(int)
            share = np.where((left < 0) | (left >= source - 1), 0.0, centre - left)
        left = np.clip(left, 0, source - 1)
        np.add.at(weights, (at, left), 1.0 - share)
        np.add.at(weights, (at, np.minimum(left + 1, source - 1)), share)
    bands, height = [], 8 * max(1, target // source)
    for start in range(0, target, height):
        used = np.flatnonzero(weights[start:start + height].any(axis=0))
        rows = slice(used[0], used[-1] + 1)
        bands.append((slice(start, start + height), rows, np.ascontiguousarray(weights[start:start + height, rows])))
    return bands


def resample(image: np.ndarray, target: int, how: str) -> np.ndarray:
    """Axis 0 of an image resampled to ``target`` rows."""
    flat = image.reshape(len(image), -1)
    out = np.empty((target, flat.shape[1]))
    for place, rows, weights in axis_weights(len(image), target, how):
        np.matmul(weights, flat[rows].astype(np.float64), out=out[place])
    return out.reshape((target,) + image.shape[1:])


def resize(image: np.ndarray, size: int, how: str = "area") -> np.ndarray:
    """Square 8-bit resize of a (height, width[, channels]) image.

    Area averaging only shrinks; if either side grows, both blend. Halving both
    sides averages four pixels under either method.
    """
    height, width = image.shape[:2]
    if height == size and width == size:
        return image
    halved = height == 2 * size and width == 2 * size
    area = halved or (how == "area" and height >= size and width >= size)

    kind = "area" if area else "near" if how == "area" else "linear"
    turned = resample(image, size, kind).swapaxes(0, 1)
    mixed = resample(turned, size, kind).swapaxes(0, 1)
    np.round(mixed, 9, out=mixed)
    # Area means round half to even, blends and four-pixel means half up.
    if area and not halved:
        np.rint(mixed, out=mixed)
    else:
        np.floor(np.add(mixed, 0.5, out=mixed), out=mixed)
    return np.clip(mixed, 0, 255, out=mixed).astype(np.uint8)


@lru_cache(maxsize=1)
def fixed_point_units():
    """12-bit reciprocals for saturation and hue by brightness or channel span."""
    at = np.maximum(np.arange(256), 1)
    return (np.rint((255 << 12) / at).astype(np.int32),
            np.rint((180 << 12) / (6.0 * at)).astype(np.int32))


def bgr_to_hsv(bgr: np.ndarray):
    """(h, s, v) as int arrays; hue 0..179 in two-degree steps, in 12-bit fixed point."""
    b, g, r = (bgr[..., i].astype(np.int32) for i in range(3))
    v = np.maximum(np.maximum(b, g), r)
    span = v - np.minimum(np.minimum(b, g), r)
    s_unit, h_unit = fixed_point_units()
    s = (span * s_unit[v] + 2048) >> 12
    side = np.where(v == r, g - b, np.where(v == g, b - r + 2 * span, r - g + 4 * span))
    h = (side * h_unit[span] + 2048) >> 12
    return np.where(h < 0, h + 180, h), s, v


def unit_histogram(index, keep, bins):
    """Per image: counts of ``index`` where ``keep``, at unit length (or zero)."""
    images = len(index)
    place = (np.arange(images)[:, None] * bins + index)[keep]
    counts = np.bincount(place, minlength=images * bins).reshape(images, bins).astype(np.float64)
    length = np.sqrt(np.einsum("ij,ij->i", counts, counts))
    return counts / np.where(length > 0, length, 1.0)[:, None]


def hs_index(h, s, bins):
    return (h * bins[0] // 180) * bins[1] + s * bins[1] // 256


def adaptive_mask(s, v):
    """Colourful pixels; if they are under 5 %, all bright ones; if none, all.
    Arrays are (images, pixels)."""
    bright = v >= LOW_V
    colourful = bright & (s >= LOW_S)
    few = colourful.sum(axis=1) < LEAST_SHARE * s.shape[1]
    keep = np.where(few[:, None], bright, colourful)
    return keep | (keep.sum(axis=1) == 0)[:, None]


def hsv_descriptors(bgr: np.ndarray) -> np.ndarray:
    """(images, 176): hue/saturation and brightness histograms, each at unit length."""
    h, s, v = (x.reshape(len(bgr), -1) for x in bgr_to_hsv(bgr))
    keep = adaptive_mask(s, v)
    colour = unit_histogram(hs_index(h, s, HS_BINS), keep, HS_BINS[0] * HS_BINS[1])
    light = unit_histogram(v * V_BINS // 256, keep, V_BINS)
    return np.hstack([colour, light]).astype(np.float32)


def colour_signatures(bgr: np.ndarray, bins=(8, 8)) -> np.ndarray:
    """(images, 64): the older hue/saturation histogram without mask."""
    h, s, _ = (x.reshape(len(bgr), -1) for x in bgr_to_hsv(bgr))
    every = np.ones(h.shape, bool)
    return unit_histogram(hs_index(h, s, bins), every, bins[0] * bins[1]).astype(np.float32)


def grey(bgr: np.ndarray) -> np.ndarray:
    """Luma in 15-bit fixed point (weights .114, .587, .299)."""
    b, g, r = (bgr[..., i].astype(np.int32) for i in range(3))
    return ((3735 * b + 19235 * g + 9798 * r + (1 << 14)) >> 15).astype(np.uint8)


@lru_cache(maxsize=1)
def block_weights() -> np.ndarray:
    """(14 x 64): how much each pixel row counts for the two cells of each of the
    seven block rows. The Gaussian and the split between cells are products of one
    factor per axis, so the same matrix serves columns."""
    at = np.arange(HOG_BLOCK)
    bell = np.exp(-((at - HOG_BLOCK / 2) ** 2) / (2 * HOG_SIGMA ** 2))
    cells = HOG_BLOCK // HOG_CELL
    where = (at + 0.5) / HOG_CELL - 0.5
    share = np.clip(1 - np.abs(where[None, :] - np.arange(cells)[:, None]), 0.0, None)
    blocks = (HOG_SIZE - HOG_BLOCK) // HOG_CELL + 1
    matrix = np.zeros((blocks * cells, HOG_SIZE))
    for block in range(blocks):
        start = block * HOG_CELL
        matrix[block * cells:(block + 1) * cells, start:start + HOG_BLOCK] = share * bell
    return matrix


def hog_descriptors(images: np.ndarray) -> np.ndarray:
    """(images, 1764) from 64 x 64 grey images: gradient orientation histograms
    (Dalal and Triggs, 2005) of 7 x 7 blocks, block columns first, at unit length.

    Votes of all pixels are laid out as one plane per orientation; both axes are
    then reduced to cells by the same small matrix.
    """
    wide = np.pad(images.astype(np.float64), ((0, 0), (1, 1), (1, 1)), mode="reflect")
    dx = wide[:, 1:-1, 2:] - wide[:, 1:-1, :-2]
    dy = wide[:, 2:, 1:-1] - wide[:, :-2, 1:-1]
    strength = np.hypot(dx, dy)
    angle = np.mod(np.arctan2(dy, dx), 2 * np.pi) * (HOG_ORIENTATIONS / np.pi) - 0.5
    low = np.floor(angle).astype(int)
    upper = strength * (angle - low)
    planes = np.zeros((HOG_ORIENTATIONS,) + images.shape)
    np.put_along_axis(planes, np.mod(low, HOG_ORIENTATIONS)[None], (strength - upper)[None], axis=0)
    np.put_along_axis(planes, np.mod(low + 1, HOG_ORIENTATIONS)[None], upper[None], axis=0)
    weights = block_weights()
    cells = weights @ planes @ weights.T                      # orientation, image, y, x
    o, n = HOG_ORIENTATIONS, len(images)
    blocks = cells.reshape(o, n, 7, 2, 7, 2).transpose(1, 4, 2, 5, 3, 0).reshape(n, 49, 36)
    blocks = blocks / (np.sqrt((blocks ** 2).sum(axis=2, keepdims=True)) + 3.6)
    blocks = np.minimum(blocks, HOG_CLIP)
    blocks = blocks / (np.sqrt((blocks ** 2).sum(axis=2, keepdims=True)) + 1e-3)
    flat = blocks.reshape(n, -1)
    length = np.linalg.norm(flat, axis=1, keepdims=True)
    return (flat / np.where(length > 0, length, 1.0)).astype(np.float32)


def model_inputs(bgr: np.ndarray) -> np.ndarray:
    """(images, 3, 224, 224) from resized BGR images, channels RGB and standardised."""
    mean, std = (np.array(x, np.float32)[:, None, None] for x in (MODEL_MEAN, MODEL_STD))
    out = np.empty((len(bgr), 3, *bgr.shape[1:3]), np.float32)
    for image, planes in zip(bgr, out):  # in place and image by image: a whole stack makes temporaries of its size
        planes[...] = image[..., ::-1].transpose(2, 0, 1)
        planes /= 255.0
        planes -= mean
        planes /= std
    return out
