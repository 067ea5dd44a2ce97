"""NumPy kernels for stacks of patches: first-order, co-occurrence, run, zone, dependence and tone features; raster and shape.

A stack has shape (patches, rows, columns). Levels are 1-based bins; 0 stands outside of the region. Each kernel looks at all
patches of a batch at once and returns one value per patch and feature.
"""

from __future__ import annotations

import numpy as np

EPS = np.spacing(1)
#: Neighbour offsets (row, column) of the four directions in a plane, and the preset of one axis.
PLANE = ((0, 1), (1, 0), (1, 1), (1, -1))
AXIS = ((0, 1),)

FIRSTORDER = (
    "Energy", "TotalEnergy", "Minimum", "Maximum", "Range", "Mean", "Median", "10Percentile", "90Percentile", "InterquartileRange",
    "MeanAbsoluteDeviation", "RobustMeanAbsoluteDeviation", "RootMeanSquared", "Skewness", "Kurtosis", "Variance", "Entropy", "Uniformity",
)
GLCM = (
    "Autocorrelation", "JointAverage", "ClusterTendency", "ClusterShade", "ClusterProminence", "Contrast", "Correlation", "DifferenceAverage",
    "DifferenceEntropy", "DifferenceVariance", "JointEnergy", "JointEntropy", "Imc1", "Imc2", "Id", "Idn", "Idm", "Idmn", "InverseVariance",
    "MaximumProbability", "SumAverage", "SumEntropy", "SumSquares", "MCC",
)
GLRLM = (
    "ShortRunEmphasis", "LongRunEmphasis", "GrayLevelNonUniformity", "GrayLevelNonUniformityNormalized", "RunLengthNonUniformity",
    "RunLengthNonUniformityNormalized", "RunPercentage", "GrayLevelVariance", "RunVariance", "RunEntropy", "LowGrayLevelRunEmphasis",
    "HighGrayLevelRunEmphasis", "ShortRunLowGrayLevelEmphasis", "ShortRunHighGrayLevelEmphasis", "LongRunLowGrayLevelEmphasis", "LongRunHighGrayLevelEmphasis",
)
GLSZM = (
    "SmallAreaEmphasis", "LargeAreaEmphasis", "GrayLevelNonUniformity", "GrayLevelNonUniformityNormalized", "SizeZoneNonUniformity",
    "SizeZoneNonUniformityNormalized", "ZonePercentage", "GrayLevelVariance", "ZoneVariance", "ZoneEntropy", "LowGrayLevelZoneEmphasis",
    "HighGrayLevelZoneEmphasis", "SmallAreaLowGrayLevelEmphasis", "SmallAreaHighGrayLevelEmphasis", "LargeAreaLowGrayLevelEmphasis", "LargeAreaHighGrayLevelEmphasis",
)
GLDM = (
    "SmallDependenceEmphasis", "LargeDependenceEmphasis", "GrayLevelNonUniformity", "DependenceNonUniformity", "DependenceNonUniformityNormalized",
    "GrayLevelVariance", "DependenceVariance", "DependenceEntropy", "LowGrayLevelEmphasis", "HighGrayLevelEmphasis", "SmallDependenceLowGrayLevelEmphasis",
    "SmallDependenceHighGrayLevelEmphasis", "LargeDependenceLowGrayLevelEmphasis", "LargeDependenceHighGrayLevelEmphasis",
)
NGTDM = ("Coarseness", "Contrast", "Busyness", "Complexity", "Strength")
SHAPE2D = ("MeshSurface", "PixelSurface", "Perimeter", "PerimeterSurfaceRatio", "Sphericity", "MaximumDiameter", "MajorAxisLength", "MinorAxisLength", "Elongation")


def ratio(a, b, other=0.0):
    """a / b, `other` where b is 0."""
    a, b = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float))
    return np.where(b != 0, a / np.where(b != 0, b, 1.0), other)


def levels(gray: np.ndarray, mask: np.ndarray, width: int = 25) -> np.ndarray:
    """1-based bins of fixed width from the smallest value of the region; 0 outside."""
    low = np.where(mask, gray, np.inf).reshape(len(gray), -1).min(1)
    return np.where(mask, gray // width - (low // width)[:, None, None] + 1, 0).astype(np.int64)


def luma(rgb: np.ndarray) -> np.ndarray:
    """Gray values of 8-bit RGB in the last axis, in 16-bit fixed point, rounded."""
    return (rgb.astype(np.int64) @ np.array([19595, 38470, 7471]) + 32768) >> 16


#: Point-wise image types besides the original, of an image and its largest absolute value.
FILTERS = {
    "square": lambda x, top: (x / np.sqrt(top)) ** 2,
    "squareroot": lambda x, top: np.sign(x) * np.sqrt(top * np.abs(x)),
    "logarithm": lambda x, top: np.sign(x) * top / np.log(top + 1) * np.log(np.abs(x) + 1),
    "exponential": lambda x, top: np.exp(np.log(top) / top * x),
}


def filtered(gray: np.ndarray, kind: str) -> np.ndarray:
    """A stack of images under a point-wise filter, scaled to the range of each image."""
    top = np.abs(gray).reshape(len(gray), -1).max(1).astype(float)[:, None, None]
    with np.errstate(all="ignore"):
        return FILTERS[kind](gray.astype(float), top)


def percentiles(gray: np.ndarray, mask: np.ndarray, at: tuple[int, ...]) -> np.ndarray:
    """Linear percentiles of the values of a region, shape (percentiles, patches); whole numbers are counted, others sorted."""
    n, many = len(gray), mask.reshape(len(gray), -1).sum(1)
    place = np.array(at)[:, None] / 100 * (many - 1)
    low = np.floor(place).astype(int)
    high = np.minimum(low + 1, many - 1)
    if np.issubdtype(gray.dtype, np.integer) and 0 <= gray.min() and gray.max() < 1 << 12:
        top = int(gray.max()) + 1
        count = np.bincount((np.nonzero(mask)[0] * top + gray[mask]), minlength=n * top).reshape(n, top)
        up_to = np.cumsum(count, 1)
        value = lambda k: np.stack([np.searchsorted(up_to[i], k[:, i], "right") for i in range(n)], 1).astype(float)
    else:
        ordered = np.sort(np.where(mask, gray, np.inf).reshape(n, -1).astype(float), 1)
        value = lambda k: ordered[np.arange(n), k]
    below, above = value(low), value(high)
    return below + (place - low) * (above - below)


def firstorder(gray: np.ndarray, mask: np.ndarray, width: int = 25) -> dict[str, np.ndarray]:
    """18 features of the raw values of a region; entropy and uniformity of its bins."""
    n = len(gray)
    inside = mask.reshape(n, -1)
    many = inside.sum(1)
    flat = gray.reshape(n, -1).astype(float)
    total = lambda v, where: np.where(where, v, 0.0).sum(1)
    mean = total(flat, inside) / many
    low, q1, mid, q3, high = percentiles(gray, mask, (10, 25, 50, 75, 90))
    d = flat - mean[:, None]
    m2, m3, m4 = (total(d**k, inside) / many for k in (2, 3, 4))
    energy = total(flat * flat, inside)
    core = inside & (flat >= low[:, None]) & (flat <= high[:, None])
    robust = total(flat, core) / core.sum(1)
    binned = levels(gray, mask, width).reshape(n, -1)
    top_bin = max(1, int(binned.max()))
    count = np.bincount((np.arange(n)[:, None] * (top_bin + 1) + binned).reshape(-1), minlength=n * (top_bin + 1)).reshape(n, -1)[:, 1:]
    p = count / many[:, None]
    top, bottom = np.where(inside, flat, -np.inf).max(1), np.where(inside, flat, np.inf).min(1)
    values = (
        energy, energy, bottom, top, top - bottom, mean, mid, low, high, q3 - q1, total(np.abs(d), inside) / many,
        total(np.abs(flat - robust[:, None]), core) / core.sum(1), np.sqrt(energy / many), ratio(m3, m2**1.5), ratio(m4, m2 * m2), m2,
        -(p * np.log2(p + EPS)).sum(1), (p * p).sum(1),
    )
    return dict(zip(FIRSTORDER, values, strict=True))


def _views(x: np.ndarray, dy: int, dx: int) -> tuple[np.ndarray, np.ndarray]:
    """Pixels and their neighbours at an offset, both within the image."""
    _, h, w = x.shape
    a = x[:, max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)]
    b = x[:, max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)]
    return a, b


def cooccurrence(level: np.ndarray, offsets=PLANE) -> np.ndarray:
    """Symmetric counts, shape (patches, directions, levels, levels)."""
    n, top = len(level), int(level.max())
    out = np.zeros((n, len(offsets), top, top))
    for k, (dy, dx) in enumerate(offsets):
        a, b = _views(level, dy, dx)
        at = (a > 0) & (b > 0)
        index = (np.nonzero(at)[0] * top + a[at] - 1) * top + b[at] - 1
        p = np.bincount(index, minlength=n * top * top).reshape(n, top, top)
        out[:, k] = p + p.transpose(0, 2, 1)
    return out


def _mean_over(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Mean over the directions that have entries."""
    return ratio(np.where(there, values, 0).sum(1), there.sum(1), np.nan)


def glcm(level: np.ndarray, offsets=PLANE, mcc: bool = True) -> dict[str, np.ndarray]:
    counts = cooccurrence(level, offsets)
    total = counts.sum((2, 3))
    p = ratio(counts, total[..., None, None])
    top = p.shape[-1]
    ng = level.reshape(len(level), -1).max(1)[:, None].astype(float)
    i = np.arange(1, top + 1, dtype=float)
    ii, jj = i[:, None], i[None, :]
    s = lambda x: x.sum((2, 3))
    px, py = p.sum(3), p.sum(2)
    ux, uy = (px * i).sum(2), (py * i).sum(2)
    sx = np.sqrt((px * (i - ux[..., None]) ** 2).sum(2))
    sy = np.sqrt((py * (i - uy[..., None]) ** 2).sum(2))
    cluster = ii + jj - ux[..., None, None] - uy[..., None, None]
    k = np.arange(top)
    minus = np.stack([s(p * (np.abs(ii - jj) == d)) for d in k], 2)
    plus = np.stack([s(p * (ii + jj == d)) for d in range(2, 2 * top + 1)], 2)
    da = (minus * k).sum(2)
    h = lambda x, axes: -(x * np.log2(x + EPS)).sum(axes)
    hxy, hx, hy = h(p, (2, 3)), h(px, 2), h(py, 2)
    both = px[..., :, None] * py[..., None, :]
    hxy1, hxy2 = -s(p * np.log2(both + EPS)), -s(both * np.log2(both + EPS))
    values = {
        "Autocorrelation": s(p * ii * jj), "JointAverage": ux, "ClusterTendency": s(p * cluster**2), "ClusterShade": s(p * cluster**3),
        "ClusterProminence": s(p * cluster**4), "Contrast": s(p * (ii - jj) ** 2), "Correlation": ratio(s(p * ii * jj) - ux * uy, sx * sy, 1.0), "DifferenceAverage": da,
        "DifferenceEntropy": h(minus, 2), "DifferenceVariance": (minus * (k - da[..., None]) ** 2).sum(2), "JointEnergy": s(p * p), "JointEntropy": hxy,
        "Imc1": ratio(hxy - hxy1, np.maximum(hx, hy)), "Imc2": np.sqrt(np.maximum(0, 1 - np.exp(-2 * (hxy2 - hxy)))), "Id": (minus / (1 + k)).sum(2),
        "Idn": (minus / (1 + k / ng[..., None])).sum(2), "Idm": (minus / (1 + k**2)).sum(2), "Idmn": (minus / (1 + k**2 / ng[..., None] ** 2)).sum(2),
        "InverseVariance": (minus[..., 1:] / k[1:] ** 2).sum(2), "MaximumProbability": p.max((2, 3)), "SumAverage": (plus * np.arange(2, 2 * top + 1)).sum(2),
        "SumEntropy": h(plus, 2), "SumSquares": s(p * (ii - ux[..., None, None]) ** 2),
    }
    if mcc:
        q = ratio(p, px[..., None]) @ ratio(p, py[..., None, :]).transpose(0, 1, 3, 2)
        eigen = np.sort(np.linalg.eigvals(q).real, axis=-1)
        second = eigen[..., -2] if top > 1 else np.ones_like(total)
        values["MCC"] = np.where((px > 0).sum(2) > 1, np.sqrt(np.maximum(0, second)), 1.0)
    return {f: _mean_over(v, total > 0) for f, v in values.items()}


def _matrix_features(p: np.ndarray, pixels: np.ndarray) -> list[np.ndarray]:
    """The 16 features of counts by level and length, shape (patches, directions, levels, lengths)."""
    n = p.sum((2, 3))
    i = np.arange(1, p.shape[2] + 1, dtype=float)[:, None]
    j = np.arange(1, p.shape[3] + 1, dtype=float)[None, :]
    s = lambda x: ratio(x.sum((2, 3)), n)
    q = ratio(p, n[..., None, None])
    ui, uj = (q * i).sum((2, 3))[..., None, None], (q * j).sum((2, 3))[..., None, None]
    gln, rln = ratio((p.sum(3) ** 2).sum(2), n), ratio((p.sum(2) ** 2).sum(2), n)
    values = [
        s(p / j**2), s(p * j**2), gln, ratio(gln, n), rln, ratio(rln, n), ratio(n, pixels[:, None]), (q * (i - ui) ** 2).sum((2, 3)), (q * (j - uj) ** 2).sum((2, 3)),
        -(q * np.log2(q + EPS)).sum((2, 3)), s(p / i**2), s(p * i**2), s(p / (i * j) ** 2), s(p * i**2 / j**2), s(p * j**2 / i**2), s(p * (i * j) ** 2),
    ]
    return [_mean_over(v, n > 0) for v in values]


def _counted(patch: np.ndarray, level: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    top, longest = max(1, int(level.max(initial=1))), max(1, int(length.max(initial=1)))
    index = (patch * top + level - 1) * longest + length - 1
    return np.bincount(index, minlength=n * top * longest).reshape(n, 1, top, longest).astype(float)


def run_lengths(level: np.ndarray, dy: int, dx: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal levels along a direction start, and for every pixel how far its level goes on."""
    n, h, w = level.shape
    length = (level > 0).astype(int)
    rows = range(h - 1, -1, -1) if dy else [slice(None)]
    cols = range(w - 1, -1, -1) if not dy else [slice(None)]
    for y in rows:
        for x in cols:
            if dy:
                if y + dy < h:
                    a, b = slice(max(0, -dx), w - max(0, dx)), slice(max(0, dx), w - max(0, -dx))
                    same = (level[:, y, a] == level[:, y + dy, b]) & (level[:, y, a] > 0)
                    length[:, y, a] += same * length[:, y + dy, b]
            elif x + dx < w:
                same = (level[:, :, x] == level[:, :, x + dx]) & (level[:, :, x] > 0)
                length[:, :, x] += same * length[:, :, x + dx]
    start = level > 0
    a, b = _views(level, dy, dx)
    goes = np.zeros_like(start)
    goes[:, max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)] = (a == b) & (b > 0)
    return start & ~goes, length


def glrlm(level: np.ndarray, offsets=PLANE) -> dict[str, np.ndarray]:
    n = len(level)
    parts = []
    for dy, dx in offsets:
        start, length = run_lengths(level, dy, dx)
        parts.append(_counted(np.nonzero(start)[0], level[start], length[start], n))
    top, longest = max(p.shape[2] for p in parts), max(p.shape[3] for p in parts)
    p = np.concatenate([np.pad(x, ((0, 0), (0, 0), (0, top - x.shape[2]), (0, longest - x.shape[3]))) for x in parts], 1)
    return dict(zip(GLRLM, _matrix_features(p, (level > 0).reshape(n, -1).sum(1)), strict=True))


def zones(level: np.ndarray, offsets=PLANE) -> np.ndarray:
    """Zones of equal level, connected along `offsets` (8-connected in a plane): every pixel has the smallest flat index of its zone, -1 outside.

    Runs of equal pixels along rows are joined where they touch in neighbouring rows: roots hook onto smaller ones and
    paths are shortened until no two runs that touch have different roots, for all patches at once.
    """
    n, h, w = level.shape
    if not level.size:
        return np.full(level.shape, -1)
    flat = level.reshape(-1)
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    new[::w] = True
    run = np.cumsum(new) - 1
    at, root = run.reshape(n, h, w), np.arange(run[-1] + 1)
    pairs = [(np.zeros(0, np.int64),) * 2]
    for dx in (dx for dy, dx in offsets if dy):
        above, below = (slice(None), slice(0, h - 1), slice(max(0, -dx), w - max(0, dx))), (slice(None), slice(1, h), slice(max(0, dx), w - max(0, -dx)))
        same = (level[above] == level[below]) & (level[above] > 0)
        u, v = at[above][same], at[below][same]
        first = np.ones(len(u), bool)
        first[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
        pairs.append((u[first], v[first]))
    u, v = (np.concatenate(x) for x in zip(*pairs, strict=True))
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, shorter := root[root]):
            root = shorter
    label = np.flatnonzero(new)[root[run]] % (h * w)
    return np.where(level > 0, label.reshape(n, h, w), -1)


def glszm(level: np.ndarray, offsets=PLANE) -> dict[str, np.ndarray]:
    n, h, w = level.shape
    label = zones(level, offsets)
    at = label >= 0
    size = np.bincount(np.nonzero(at)[0] * h * w + label[at], minlength=n * h * w)
    zone = np.flatnonzero(size)
    p = _counted(zone // (h * w), level.reshape(-1)[zone], size[zone], n)
    return dict(zip(GLSZM, _matrix_features(p, at.reshape(n, -1).sum(1)), strict=True))


def _neighbours(x: np.ndarray, offsets):
    for dy, dx in (*offsets, *((-a, -b) for a, b in offsets)):
        shifted = np.zeros_like(x)
        _, h, w = x.shape
        shifted[:, max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)] = x[:, max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)]
        yield shifted


def gldm(level: np.ndarray, alpha: int = 0, offsets=PLANE) -> dict[str, np.ndarray]:
    depends = 1 + sum(((b > 0) & (np.abs(b - level) <= alpha)).astype(int) for b in _neighbours(level, offsets))
    at = level > 0
    n = len(level)
    p = _counted(np.nonzero(at)[0], level[at], depends[at], n)
    sde, lde, gln, _, dn, dnn, _, glv, dv, de, *rest = _matrix_features(p, at.reshape(n, -1).sum(1))
    return dict(zip(GLDM, [sde, lde, gln, dn, dnn, glv, dv, de, *rest], strict=True))


def ngtdm(level: np.ndarray, offsets=PLANE) -> dict[str, np.ndarray]:
    total, count = np.zeros(level.shape), np.zeros(level.shape)
    for b in _neighbours(level, offsets):
        total += b
        count += b > 0
    at = (level > 0) & (count > 0)
    patch, lev = np.nonzero(at)[0], level[at]
    n, top = len(level), max(1, int(level.max()))
    index = patch * top + lev - 1
    apart = np.abs(lev - total[at] / count[at])
    s = np.bincount(index, apart, minlength=n * top).reshape(n, top)
    c = np.bincount(index, minlength=n * top).reshape(n, top).astype(float)
    nvp = c.sum(1)
    p = ratio(c, nvp[:, None])
    i = np.arange(1, top + 1, dtype=float)
    there = (p[:, :, None] > 0) & (p[:, None, :] > 0)
    pi, pj, si, sj = p[:, :, None], p[:, None, :], s[:, :, None], s[:, None, :]
    gap = i[:, None] - i[None, :]
    groups = (p > 0).sum(1)
    ps = (p * s).sum(1)
    busy = (there * np.abs(i[:, None] * pi - i[None, :] * pj)).sum((1, 2))
    values = (
        ratio(1.0, ps, 1e6), ratio((pi * pj * gap**2).sum((1, 2)) * s.sum(1), groups * (groups - 1) * nvp), ratio(ps, busy),
        ratio((there * ratio(np.abs(gap) * (pi * si + pj * sj), pi + pj)).sum((1, 2)), nvp), ratio((there * (pi + pj) * gap**2).sum((1, 2)), s.sum(1)),
    )
    return dict(zip(NGTDM, values, strict=True))


def texture(gray: np.ndarray, mask: np.ndarray, width: int = 25, offsets=PLANE, mcc: bool = True) -> dict[str, np.ndarray]:
    """All features of a stack, named class_Feature."""
    level = levels(gray, mask, width)
    made = {"firstorder": firstorder(gray, mask, width), "glcm": glcm(level, offsets, mcc), "glrlm": glrlm(level, offsets), "glszm": glszm(level, offsets), "gldm": gldm(level, offsets=offsets), "ngtdm": ngtdm(level, offsets)}
    return {f"{cls}_{f}": v for cls, values in made.items() for f, v in values.items()}


# ---------------------------------------------------------------- raster and shape


def points_of(ring) -> np.ndarray:
    """A ring as an array of (x, y), without the point that closes it."""
    out = ring if isinstance(ring, np.ndarray) else np.array([(p["x"], p["y"]) if isinstance(p, dict) else (p[0], p[1]) for p in ring], float).reshape(-1, 2)
    return out[:-1] if len(out) > 1 and (out[0] == out[-1]).all() else out


def _rounded(x: np.ndarray, down: bool) -> np.ndarray:
    """Whole numbers nearest to x: of halves, the one away from 0, or with `down` the one towards it."""
    whole = np.ceil(np.abs(x) - np.float32(0.5)) if down else np.floor(np.abs(x) + np.float32(0.5))
    return np.where(x < 0, -whole, whole).astype(np.int64)


def ring_spans(rings: list[np.ndarray], heights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scan conversion of many rings at once: ring, row, first and last column of every span, by ring.

    Vertices are cut to whole pixels towards 0. All edges of all rings are one table; an edge crosses every row from its upper
    to its lower end, both included, and its lower end counts once more unless the ring ends there, so that rows have crossings
    in pairs where outlines turn. Crossings are 32-bit floats; a pair is filled from the first, halves up, to the second,
    halves down. Horizontal edges are filled as they are. heights has the rows of the image of each ring.
    """
    xy = np.concatenate([np.zeros((0, 2)), *(r for r in rings if len(r))])
    return flat_spans(xy, np.array([len(r) for r in rings], np.int64), heights)


def flat_spans(xy: np.ndarray, sizes: np.ndarray, heights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ring_spans() of rings that lie one after the other in xy, with the points of each."""
    none = np.zeros(0, np.int64)
    if not sizes.sum():
        return none, none, none, none
    xy = np.trunc(np.clip(xy, -(1 << 24), 1 << 24)).astype(np.int64)
    ring, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    after = np.arange(1, len(xy) + 1)
    after[ends[sizes > 0] - 1] = (ends - sizes)[sizes > 0]
    (x0, y0), (x1, y1) = xy.T, xy[after].T
    low, high, last = np.minimum(y0, y1), np.maximum(y0, y1), np.zeros(len(sizes), np.int64)
    last[sizes > 0] = np.maximum.reduceat(y0, (ends - sizes)[sizes > 0])
    flat = (y0 == y1) & (y0 >= 0) & (y0 < heights[ring])
    top = np.maximum(low, 0)
    rows = np.where(y0 == y1, 0, np.maximum(0, np.minimum(high, heights[ring] - 1) - top + 1))
    e = np.repeat(np.arange(len(xy)), rows)
    row = top[e] + np.arange(len(e)) - np.repeat(np.cumsum(rows) - rows, rows)
    slope = (x1 - x0).astype(np.float32) / np.where(y0 == y1, 1, y1 - y0).astype(np.float32)
    at = (row - y0[e]).astype(np.float32) * slope[e] + x0[e].astype(np.float32)
    again = (row == high[e]) & (row < last[ring[e]])
    e, row, at = (np.concatenate([v, v[again]]) for v in (e, row, at))
    order = np.lexsort((at, row, ring[e]))
    own, row, at = ring[e][order], row[order], at[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    number = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
    pair = np.flatnonzero((number[:-1] % 2 == 0) & ~new[1:]) if len(own) else none
    made = [
        np.concatenate([ring[flat], own[pair]]), np.concatenate([y0[flat], row[pair]]), np.concatenate([np.minimum(x0, x1)[flat], _rounded(at[pair], False)]),
        np.concatenate([np.maximum(x0, x1)[flat], _rounded(at[pair + 1], True)]),
    ]
    by_ring = np.argsort(made[0], kind="stable")
    return tuple(m[by_ring] for m in made)


def painted(rings: list[np.ndarray], values: np.ndarray, image: np.ndarray, shapes: np.ndarray) -> list[np.ndarray]:
    """Masks of many images at once. rings are painted in order, each with its value into its image; shapes are (rows, columns)."""
    shapes = np.asarray(shapes, np.int64).reshape(-1, 2)
    xy = np.concatenate([np.zeros((0, 2)), *(r for r in rings if len(r))])
    out, start = flat_painted(xy, np.array([len(r) for r in rings], np.int64), np.asarray(values, np.uint8), np.asarray(image, np.int64), shapes)
    return [out[a:b].reshape(h, w) for a, b, (h, w) in zip(start[:-1], start[1:], shapes, strict=True)]


def flat_painted(xy: np.ndarray, sizes: np.ndarray, values: np.ndarray, image: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """painted() of rings that lie one after the other in xy: the pixels of all images, and where each image begins."""
    start = np.concatenate([[0], np.cumsum(shapes[:, 0] * shapes[:, 1])])
    out = np.zeros(int(start[-1]), np.uint8)
    if len(sizes):
        ring, row, left, right = flat_spans(xy, sizes, shapes[image, 0])
        own = image[ring]
        _fill(out, start[own] + row * shapes[own, 1], np.maximum(left, 0), np.minimum(right, shapes[own, 1] - 1), values[ring])
    return out, start


def _fill(out: np.ndarray, row: np.ndarray, left: np.ndarray, right: np.ndarray, values: np.ndarray) -> None:
    """Fills spans of rows that begin at `row` with their values; of a pixel painted twice, the later value stays."""
    size = np.maximum(0, right - left + 1)
    place = np.repeat(row + left - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[place] = np.repeat(values, size)


def opened(xy: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rings one after the other without the points that close them."""
    ends = np.cumsum(sizes)
    more = np.flatnonzero(sizes > 1)
    closed = more[(xy[(ends - sizes)[more]] == xy[ends[more] - 1]).all(1)]
    keep, left = np.ones(len(xy), bool), sizes.copy()
    keep[ends[closed] - 1] = False
    left[closed] -= 1
    return xy[keep], left


def drawable(xy: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rings one after the other; those without three finite points are left with none."""
    good = np.bincount(np.repeat(np.arange(len(sizes)), sizes), ~np.isfinite(xy).all(1), len(sizes)) == 0
    good &= sizes >= 3
    return xy[np.repeat(good, sizes)], np.where(good, sizes, 0)


def _laid(polygons: list, label: int) -> tuple[list[np.ndarray], list[int]]:
    """Rings of polygons in the order of painting, and their values: exteriors the label, holes 0. Rings need three finite points."""
    rings, values = [], []
    for own in polygons:
        for k, ring in enumerate(own):
            points = points_of(ring)
            if len(points) >= 3 and np.isfinite(points).all():
                rings.append(points)
                values.append(0 if k else label)
    return rings, values


def rasterised_all(images: list[list], shapes: list[tuple[int, int]], label: int = 255) -> list[np.ndarray]:
    """One mask for the polygons of each image, as one pass over the edges of all."""
    laid = [_laid(polygons, label) for polygons in images]
    owner = np.repeat(np.arange(len(images)), [len(rings) for rings, _ in laid])
    return painted([r for rings, _ in laid for r in rings], np.array([v for _, values in laid for v in values]), owner, np.array(shapes))


def rasterised(polygons: list, h: int, w: int, label: int = 255) -> np.ndarray:
    """Polygons painted one after the other: the exterior with the label, then its holes with 0. Rings need three points."""
    return rasterised_all([polygons], [(h, w)], label)[0]


def local_masks(cells: list[list], label: int = 255, margin: int = 1) -> list[tuple[np.ndarray, tuple[int, int, int, int]] | None]:
    """For each cell (its polygons) the mask in the frame of its bounding box with a margin, and that box (x, y of both corners).

    None for a cell without a polygon.
    """
    cells = [[[points_of(ring) for ring in rings] for rings in polygons] for polygons in cells]
    boxes: list = []
    for polygons in cells:
        outer = [rings[0] for rings in polygons if rings and len(rings[0])]
        points = np.concatenate(outer) if outer else np.zeros((0, 2))
        ok = len(points) > 0 and np.isfinite(points).all()
        boxes.append((np.floor(points.min(0)).astype(int) - margin, np.ceil(points.max(0)).astype(int) + margin) if ok else None)
    there = [k for k, box in enumerate(boxes) if box is not None]
    moved = [[[ring - boxes[k][0] for ring in rings] for rings in cells[k]] for k in there]
    masks = rasterised_all(moved, [tuple((boxes[k][1] - boxes[k][0] + 1)[::-1]) for k in there], label) if there else []
    out: list = [None] * len(cells)
    for k, mask in zip(there, masks, strict=True):
        (x0, y0), (x1, y1) = boxes[k]
        out[k] = mask, (int(x0), int(y0), int(x1), int(y1))
    return out


def local_mask(polygons: list, label: int = 255, margin: int = 1) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    """local_masks() of one cell; one without a polygon is an error."""
    (made,) = local_masks([polygons], label, margin)
    if made is None:
        raise ValueError("no polygon to paint")
    return made


#: Per arrangement of the four corners of a cell (bits: top left, top right, bottom right, bottom left), the edges that
#: contour segments join: 0 top, 1 right, 2 bottom, 3 left.
_SEGMENTS = {
    1: [(3, 0)], 2: [(0, 1)], 4: [(1, 2)], 8: [(2, 3)], 14: [(3, 0)], 13: [(0, 1)], 11: [(1, 2)], 7: [(2, 3)], 3: [(3, 1)], 12: [(3, 1)], 6: [(0, 2)], 9: [(0, 2)],
    5: [(3, 0), (1, 2)], 10: [(0, 1), (2, 3)],
}
_MIDDLE = np.array([(0, 0.5), (0.5, 1), (1, 0.5), (0.5, 0)])


_TABLE = np.full((16, 2, 2, 2), np.nan)
for _case, _pairs in _SEGMENTS.items():
    for _k, (_p, _q) in enumerate(_pairs):
        _TABLE[_case, _k] = _MIDDLE[_p], _MIDDLE[_q]


def _contour(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the segments of the marching-squares contour; they lie in the middles of cell edges."""
    m = np.pad(mask > 0, 1).astype(int)
    case = m[:-1, :-1] + 2 * m[:-1, 1:] + 4 * m[1:, 1:] + 8 * m[1:, :-1]
    at = np.argwhere((case > 0) & (case < 15))
    segments = (_TABLE[case[at[:, 0], at[:, 1]]] + at[:, None, None, :]).reshape(-1, 2, 2)
    segments = segments[~np.isnan(segments[:, 0, 0])]
    return segments[:, 0], segments[:, 1]


def widest_distance(points: np.ndarray, block: int = 2048) -> float:
    """Largest distance between two of the points; they can only be the first and last of their rows."""
    y, x = points[np.lexsort((points[:, 1], points[:, 0]))].T
    step = y[1:] != y[:-1]
    ends = np.concatenate([step, [True]]) | np.concatenate([[True], step])
    y, x = y[ends], x[ends]
    return max(float(((y[k : k + block, None] - y) ** 2 + (x[k : k + block, None] - x) ** 2).max()) for k in range(0, len(y), block)) ** 0.5


def shape2d(mask: np.ndarray) -> dict[str, float] | None:
    """Nine shape features of a mask; None under three pixels."""
    y, x = np.nonzero(mask)
    n = len(x)
    if n < 3:
        return None
    starts, ends = _contour(mask)
    perimeter = float(np.hypot(*(starts - ends).T).sum())
    m = np.pad((mask > 0).astype(int), 1)
    corners = m[:-1, :-1] + m[:-1, 1:] + m[1:, :-1] + m[1:, 1:]
    surface = float(np.array([0, 0.125, 0.5, 0.875, 1.0])[corners].sum()) - 0.25 * int(((corners == 2) & (m[:-1, :-1] == m[1:, 1:])).sum())
    widest = widest_distance(np.concatenate([starts, ends]))
    large, small = axes(x, y)
    values = (
        surface, float(n), float(perimeter), float(perimeter / surface), float(2 * np.sqrt(np.pi * surface) / perimeter), float(widest),
        4 * np.sqrt(large), 4 * np.sqrt(small), float(np.sqrt(small / large)) if large > 0 else 0.0,
    )
    return dict(zip(SHAPE2D, map(float, values), strict=True))


#: Pixels of shapes that are measured at once.
SHAPE_PIXELS = 1 << 21


def shapes2d(stack: np.ndarray) -> np.ndarray:
    """shape2d() of a stack of masks with a frame of background: one row of SHAPE2D a mask, NaN under three pixels."""
    m = (stack > 0).view(np.uint8)
    k, h, w = m.shape
    case = m[:, :-1, :-1] + 2 * m[:, :-1, 1:] + 4 * m[:, 1:, 1:] + 8 * m[:, 1:, :-1]
    at = np.flatnonzero(case.reshape(-1))
    n = np.bincount(at // ((h - 1) * (w - 1)) * 16 + case.reshape(-1)[at], minlength=16 * k).reshape(k, 16).astype(float)
    one, three, split, even = n[:, [1, 2, 4, 8]].sum(1), n[:, [7, 11, 13, 14]].sum(1), n[:, [5, 10]].sum(1), n[:, [3, 6, 9, 12]].sum(1)
    perimeter = even + (one + three + 2 * split) * np.hypot(0.5, 0.5)
    surface = 0.125 * one + 0.5 * (even + split) + 0.875 * three + n[:, 15] - 0.25 * split
    x, y = np.arange(w, dtype=float), np.arange(h, dtype=float)
    rows = (m.reshape(-1, w).astype(float) @ np.stack([np.ones(w), x, x * x], 1)).reshape(k, h, 3)
    (count, sx, sxx), sy, syy, sxy = rows.sum(1).T, rows[:, :, 0] @ y, rows[:, :, 0] @ (y * y), rows[:, :, 1] @ y
    some = count >= 3
    c = np.where(some, count, 1)
    a, b, d = (c * sxx - sx * sx) / (c * c), (c * sxy - sx * sy) / (c * c), (c * syy - sy * sy) / (c * c)
    root = np.sqrt(((a - d) / 2) ** 2 + b * b)
    large, small = (a + d) / 2 + root, np.maximum(0.0, (a + d) / 2 - root)
    with np.errstate(divide="ignore", invalid="ignore"):
        made = np.stack([
            surface, count, perimeter, perimeter / surface, 2 * np.sqrt(np.pi * surface) / perimeter, _widest(m), 4 * np.sqrt(large), 4 * np.sqrt(small),
            np.where(large > 0, np.sqrt(small / large), 0.0),
        ], 1)
    made[~some] = np.nan
    return made


def _widest(m: np.ndarray) -> np.ndarray:
    """Largest distance between two points of the contour of each mask: the first and last points of its rows, at half pixels."""
    k, h, w = m.shape
    left, right = np.full((k, 2 * h - 1), 1 << 28, np.int64), np.full((k, 2 * h - 1), -(1 << 28), np.int64)
    for first, marks, outside in ((0, m, 1), (1, m[:, :-1] ^ m[:, 1:], 0)):  # contours cross rows beside pixels, and between rows below or above them
        there = marks.any(2)
        left[:, first::2] = np.where(there, 2 * marks.argmax(2) - outside, 1 << 28)
        right[:, first::2] = np.where(there, 2 * (w - 1 - marks[:, :, ::-1].argmax(2)) + outside, -(1 << 28))
    widest = np.zeros(k, np.int64)
    for down in range(2 * h - 1):
        upper, lower = slice(0, 2 * h - 1 - down), slice(down, None)
        across = np.maximum(right[:, upper] - left[:, lower], right[:, lower] - left[:, upper])
        across = across.max(1)
        widest = np.maximum(widest, np.where(across >= 0, across * across + down * down, 0))
    return np.sqrt(widest) / 2


def shapes_of(xy: np.ndarray, sizes: np.ndarray, cell: np.ndarray, outer: np.ndarray, cells: int, limits: np.ndarray | None = None) -> np.ndarray:
    """shape2d() of many cells at once: one row of SHAPE2D a cell, NaN where there is none.

    Rings lie one after the other in xy, each with its points, its cell (ascending) and whether it is an exterior. Cells are
    painted in the frame of their own bounding box with a margin, those of about one size in one stack. With limits (rows and columns of the
    image of each cell) only what lies in the image counts.
    """
    made = np.full((cells, len(SHAPE2D)), np.nan)
    xy, sizes = opened(xy, sizes)
    edge = np.repeat(outer, sizes)
    own = np.repeat(cell, sizes)[edge]
    if not len(own):
        return made
    begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    low, high = (np.full((cells, 2), np.nan) for _ in range(2))
    low[own[begin]], high[own[begin]] = np.minimum.reduceat(xy[edge], begin), np.maximum.reduceat(xy[edge], begin)
    there = np.isfinite(low).all(1) & np.isfinite(high).all(1)
    low, high = np.floor(np.where(there[:, None], low, 0)).astype(np.int64) - 1, np.ceil(np.where(there[:, None], high, 0)).astype(np.int64) + 1
    xy, sizes = drawable(xy - np.repeat(low[cell], sizes, 0), sizes)
    drawn = there[cell]
    xy, sizes = xy[np.repeat(drawn, sizes)], np.where(drawn, sizes, 0)
    size = (high - low + 1)[:, ::-1]
    ring, row, left, right = flat_spans(xy, sizes, size[cell, 0])
    value, at = outer[ring].astype(np.uint8), cell[ring]
    left, right = np.maximum(left, 0), np.minimum(right, size[at, 1] - 1)
    if limits is not None:
        left, right = np.maximum(left, -low[at, 0]), np.minimum(right, limits[at, 1] - 1 - low[at, 0])
        right = np.where((row >= -low[at, 1]) & (row < limits[at, 0] - low[at, 1]), right, left - 1)
    frame = -(-size // (4, 16)) * (4, 16)
    for h, w in np.unique(frame[there], axis=0):
        alike = np.flatnonzero(there & (frame[:, 0] == h) & (frame[:, 1] == w))
        step = max(1, SHAPE_PIXELS // int(h * w))
        for some in (alike[i : i + step] for i in range(0, len(alike), step)):
            place = np.full(cells, -1)
            place[some] = np.arange(len(some))
            s = np.flatnonzero(place[at] >= 0)
            stack = np.zeros(len(some) * int(h * w), np.uint8)
            _fill(stack, place[at[s]] * (h * w) + row[s] * w, left[s], right[s], value[s])
            made[some] = shapes2d(stack.reshape(len(some), h, w))
    return made


def axes(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Eigenvalues of the population covariance of coordinates, in closed form."""
    a, c, b = x.var(), y.var(), ((x - x.mean()) * (y - y.mean())).mean()
    root = np.sqrt(((a - c) / 2) ** 2 + b * b)
    return float((a + c) / 2 + root), float(max(0.0, (a + c) / 2 - root))


STATISTICS = (
    "mean", "median", "minimum", "maximum", "range", "variance", "standarddeviation", "p10", "p25", "p75", "p90", "iqr",
    "meanabsolutedeviation", "skewness", "kurtosis", "entropy", "energy", "rootmeansquared",
)


def statistics(x: np.ndarray) -> np.ndarray | None:
    """STATISTICS of the finite ones of some values; None without any. Kurtosis is the excess; both are 0 for a constant."""
    x = x[np.isfinite(x)]
    if not len(x):
        return None
    low, high, mean, var = x.min(), x.max(), x.mean(), x.var()
    q = np.percentile(x, [10, 25, 50, 75, 90])
    flat = low == high or var == 0
    z = np.zeros(1) if flat else (x - mean) / np.sqrt(var)
    entropy = 0.0
    if low < high:
        count = np.histogram(x, min(16, max(2, len(x))))[0]
        p = count[count > 0] / len(x)
        entropy = -(p * np.log2(p)).sum()
    return np.array([
        mean, q[2], low, high, high - low, var, np.sqrt(var), q[0], q[1], q[3], q[4], q[3] - q[1], np.abs(x - mean).mean(),
        (z**3).mean(), 0.0 if flat else (z**4).mean() - 3, entropy, (x * x).sum(), np.sqrt((x * x).mean()),
    ])


def statistics_of(values: np.ndarray, row: np.ndarray, rows: int, floor: bool = False) -> np.ndarray:
    """statistics() of every column of values over the cells of each row, column by column; NaN without any. Rows with equally many
    cells are one stack; values are finite, and row has the row of each cell, ascending. With floor the bin of a value is the whole part of
    its distance from the least one in widths of a bin, as SQL says it, without a look at the edges."""
    made = np.full((rows, values.shape[1], len(STATISTICS)), np.nan)
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    for n in np.unique(count[count > 0]).tolist():
        own = np.flatnonzero(count == n)
        x = np.sort(values[first[own][:, None] + np.arange(n)].transpose(0, 2, 1), axis=2)
        low, high, mean, var = x[..., 0], x[..., -1], x.mean(2), x.var(2)
        q = np.percentile(x, [10, 25, 50, 75, 90], axis=2)
        flat = (low == high) | (var == 0)
        z = np.where(flat[..., None], 0.0, (x - mean[..., None]) / np.sqrt(np.where(flat, 1.0, var))[..., None])
        bins = min(16, max(2, n))
        step = np.where(low < high, high - low, 1.0)
        if floor:
            at = np.minimum(((x - low[..., None]) / (step / bins)[..., None]).astype(np.int64), bins - 1)
        else:
            edges = np.arange(bins + 1) * (step / bins)[..., None] + low[..., None]
            edges[..., -1] = high
            at = np.minimum(((x - low[..., None]) / step[..., None] * bins).astype(np.int64), bins - 1)
            at -= x < np.take_along_axis(edges, at, 2)
            at += (x >= np.take_along_axis(edges, at + 1, 2)) & (at != bins - 1)
        p = (at[..., None] == np.arange(bins)).sum(2) / n
        entropy = np.where(low < high, -(p * np.log2(np.where(p > 0, p, 1.0))).sum(2), 0.0)
        made[own] = np.stack([
            mean, q[2], low, high, high - low, var, np.sqrt(var), q[0], q[1], q[3], q[4], q[3] - q[1], np.abs(x - mean[..., None]).mean(2),
            (z**3).mean(2), np.where(flat, 0.0, (z**4).mean(2) - 3), entropy, (x * x).sum(2), np.sqrt((x * x).mean(2)),
        ], 2)
    return made.reshape(rows, -1)


def cell_shapes(cells: list[list], h: int, w: int) -> list[dict[str, float]]:
    """Shapes of what of each cell lies in an image; cells of which that is under three pixels, or without a polygon, have none.

    Ten decimals are kept, so that the order of sums does not make equal cells differ.
    """
    out = []
    for found in local_masks(cells):
        if found is not None:
            mask, (x0, y0, _, _) = found
            made = shape2d(mask[max(0, -y0) : max(0, h - y0), max(0, -x0) : max(0, w - x0)])
            if made is not None:
                out.append({f: round(v, 10) for f, v in made.items()})
    return out


#: The eight neighbours (row, column) of a pixel, counter-clockwise on the screen from the right one on.
_AROUND = ((0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1))


def border(part: np.ndarray, y: int, x: int) -> list[tuple[int, int]]:
    """The pixels (row, column) of the outer border of a part from its first one on, down its left side and around.

    At each pixel the neighbours are searched counter-clockwise from the one after where the walk came from; it ends when the first step
    would be made again. part has a frame of background.
    """
    back = next((d for d in range(4, -4, -1) if part[y + _AROUND[d % 8][0], x + _AROUND[d % 8][1]]), None)
    if back is None:
        return [(y, x)]
    walk, came = [(y, x)], back % 8
    last = (y + _AROUND[came][0], x + _AROUND[came][1])
    while True:
        a, b = walk[-1]
        d = next(k % 8 for k in range(came + 1, came + 9) if part[a + _AROUND[k % 8][0], b + _AROUND[k % 8][1]])
        to = (a + _AROUND[d][0], b + _AROUND[d][1])
        if to == (y, x) and (a, b) == last:
            return walk
        walk.append(to)
        came = (d + 4) % 8


def corners(walk: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pixels of a closed walk where it turns."""
    at = np.array(walk)
    turn = (at - np.roll(at, 1, 0) != np.roll(at, -1, 0) - at).any(1)
    return [p for p, t in zip(walk, turn, strict=True) if t]


def outlines(mask: np.ndarray) -> list[list[tuple[float, float]]]:
    """Outer outlines (x, y) through the centres of border pixels of the 8-connected parts of a mask, in the order of their first pixels.

    Only vertices where an outline turns are kept. Parts that are no polygon that way are left out: single pixels and lines, and
    parts with a bridge or a spike of one pixel, whose outline meets itself.
    """
    return [ring for _, ring in numbered_outlines(mask)]


def numbered_outlines(mask: np.ndarray) -> list[tuple[int, list[tuple[float, float]]]]:
    """The same with the number of each part, from 1 on in the order of first pixels; parts that are left out keep theirs."""
    label = zones((mask > 0).astype(int)[None])[0]
    out = []
    for number, part in enumerate(np.unique(label[label >= 0]), 1):
        y, x = divmod(int(part), mask.shape[1])
        at = np.argwhere(label == part)
        (top, left), (bottom, right) = at.min(0), at.max(0)
        walk = border(np.pad(label[top : bottom + 1, left : right + 1] == part, 1), y - top + 1, x - left + 1)
        if len(walk) > 2 and len(set(walk)) == len(walk):
            out.append((number, [(float(b + left - 1), float(a + top - 1)) for a, b in corners(walk)]))
    return out
