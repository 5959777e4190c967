"""Small images and slow reference forms for comparison."""

import numpy as np


def solid(height, width, bgr):
    return np.full((height, width, 3), bgr, np.uint8)


def shapes(bgr):
    """72 x 110: one colour, a yellow disc and a dark bar that leans."""
    image = solid(72, 110, bgr)
    y, x = np.mgrid[:72, :110]
    image[(y - 30) ** 2 + (x - 70) ** 2 < 19 ** 2] = (10, 230, 240)
    image[np.abs(2 * x - y - 30) < 9] = (25, 12, 40)
    return image


def struct_of(image, origin=""):
    return (origin, image.shape[0], image.shape[1], 3, 16, bytearray(image.tobytes()))


def slow_area(image, size):
    height, width = image.shape[:2]
    out = np.zeros((size, size) + image.shape[2:])
    for i in range(size):
        for j in range(size):
            y0, y1, x0, x1 = i * height / size, (i + 1) * height / size, j * width / size, (j + 1) * width / size
            total = 0.0
            for y in range(int(y0), min(height, int(np.ceil(y1)))):
                for x in range(int(x0), min(width, int(np.ceil(x1)))):
                    share = max(0, min(y1, y + 1) - max(y0, y)) * max(0, min(x1, x + 1) - max(x0, x))
                    total = total + image[y, x].astype(float) * share
            out[i, j] = total / ((y1 - y0) * (x1 - x0))
    return np.rint(np.round(out, 9)).astype(np.uint8)


def slow_hsv(b, g, r):
    """Hue in two-degree steps, saturation and value, by the textbook formulas."""
    v, low = max(b, g, r), min(b, g, r)
    span = v - low
    s = 255 * span / v if v else 0
    if not span:
        h = 0.0
    elif v == r:
        h = 60 * (g - b) / span
    elif v == g:
        h = 120 + 60 * (b - r) / span
    else:
        h = 240 + 60 * (r - g) / span
    return (h / 2) % 180, s, v


def slow_hog(grey):
    """Orientation histograms by loops over blocks, pixels and cells."""
    shade = grey.astype(float)
    mirror = lambda i: 1 if i < 0 else 62 if i > 63 else i
    out = []
    for bx in range(7):
        for by in range(7):
            cells = np.zeros((2, 2, 9))
            for py in range(16):
                for px in range(16):
                    y, x = by * 8 + py, bx * 8 + px
                    dx = shade[y, mirror(x + 1)] - shade[y, mirror(x - 1)]
                    dy = shade[mirror(y + 1), x] - shade[mirror(y - 1), x]
                    strength = np.hypot(dx, dy)
                    angle = (np.arctan2(dy, dx) % (2 * np.pi)) * 9 / np.pi - 0.5
                    low = int(np.floor(angle))
                    part = angle - low
                    bell = np.exp(-((px - 8) ** 2 + (py - 8) ** 2) / (2 * 4.0 ** 2))
                    for cx in range(2):
                        for cy in range(2):
                            wx = max(0.0, 1 - abs((px + 0.5) / 8 - 0.5 - cx))
                            wy = max(0.0, 1 - abs((py + 0.5) / 8 - 0.5 - cy))
                            vote = strength * bell * wx * wy
                            cells[cx, cy, low % 9] += vote * (1 - part)
                            cells[cx, cy, (low + 1) % 9] += vote * part
            block = cells.ravel()
            block = np.minimum(block / (np.sqrt((block ** 2).sum()) + 3.6), 0.2)
            out.append(block / (np.sqrt((block ** 2).sum()) + 1e-3))
    flat = np.concatenate(out)
    length = np.linalg.norm(flat)
    return flat / length if length else flat


def slow_top(queries, corpus, k, own=False, keep_zero=False):
    """{query id: [(image id, score)]} by comparing everything."""
    found = {}
    queries, corpus = ({i: np.asarray(v, np.float64) for i, v in t.items()} for t in (queries, corpus))
    for q, a in queries.items():
        scored = []
        for c, b in corpus.items():
            if own and q == c:
                continue
            na, nb = np.linalg.norm(a), np.linalg.norm(b)
            if not np.isfinite(nb) or (nb == 0 and not keep_zero):
                continue
            scored.append((-round(float(a @ b / (na * nb)) if na and nb else 0.0, 12), c))
        found[q] = [(c, -s) for s, c in sorted(scored)[:k]]
    return found
