"""Kernels on hand-made images, and properties on random ones."""

import numpy as np
import pytest

from spatialfeat.functions import kernels as k


@pytest.fixture(scope="module")
def stack():
    rng = np.random.default_rng(7)
    gray = rng.integers(0, 256, (12, 9, 7))
    return gray, (gray > 30) & (gray < 220)


def test_checkerboard_by_hand():
    level = (np.indices((4, 4)).sum(0) % 2 + 1)[None]
    across = k.cooccurrence(level, ((0, 1),))[0, 0]
    assert across.tolist() == [[0, 12], [12, 0]]
    diagonal = k.cooccurrence(level, ((1, 1),))[0, 0]
    assert diagonal.tolist() == [[10, 0], [0, 8]]
    f = k.glcm(level, ((0, 1),))
    assert f["Contrast"][0] == 1 and f["JointEnergy"][0] == 0.5 and f["Correlation"][0] == pytest.approx(-1)
    assert k.glrlm(level, ((0, 1),))["ShortRunEmphasis"][0] == 1
    assert k.glszm(level)["LargeAreaEmphasis"][0] == 64  # two zones of eight pixels
    assert (k.zones(level)[0] == level[0] - 1).all()


def test_rows_make_runs():
    level = np.repeat(np.array([1, 2, 1]), 5).reshape(1, 3, 5)
    f = k.glrlm(level, ((0, 1),))
    assert f["LongRunEmphasis"][0] == 25 and f["RunPercentage"][0] == pytest.approx(3 / 15)


def test_constant_region():
    gray = np.full((1, 8, 8), 100)
    mask = np.ones_like(gray, bool)
    f = k.texture(gray, mask)
    assert f["firstorder_Skewness"][0] == 0 and f["firstorder_Kurtosis"][0] == 0 and f["glcm_Correlation"][0] == 1 and f["glcm_MCC"][0] == 1
    assert f["ngtdm_Coarseness"][0] == 1e6 and f["ngtdm_Contrast"][0] == 0 and f["glszm_LargeAreaEmphasis"][0] == 64**2
    assert len(f) == 18 + 24 + 16 + 16 + 14 + 5


def test_correlation_coefficient_by_definition(stack):
    """The root of the second largest eigenvalue of Q(i, j) = sum over k of p(i, k) p(j, k) / (px(i) py(k))."""
    level = k.levels(*stack)
    got = k.glcm(level)["MCC"]
    for n in range(len(level)):
        per = []
        for dy, dx in k.PLANE:
            pairs = [(level[n, y, x], level[n, y + dy, x + dx]) for y in range(level.shape[1]) for x in range(level.shape[2]) if 0 <= y + dy < level.shape[1] and 0 <= x + dx < level.shape[2]]
            pairs = [(a, b) for a, b in pairs if a and b]
            there = sorted({v for p in pairs for v in p})
            p = np.zeros((len(there),) * 2)
            for a, b in pairs:
                p[there.index(a), there.index(b)] += 1
                p[there.index(b), there.index(a)] += 1
            p /= p.sum()
            q = np.array([[sum(p[i, m] * p[j, m] / (p[i].sum() * p[:, m].sum()) for m in range(len(there))) for j in range(len(there))] for i in range(len(there))])
            per.append(np.sqrt(max(0.0, np.sort(np.linalg.eigvals(q).real)[-2])) if len(there) > 1 else 1.0)
        assert got[n] == pytest.approx(np.mean(per), rel=1e-6)


def test_counts_add_up(stack):
    gray, mask = stack
    level = k.levels(gray, mask)
    pixels = mask.reshape(len(mask), -1).sum(1)
    p = k.cooccurrence(level)
    assert (p == p.transpose(0, 1, 3, 2)).all()
    for dy, dx in k.PLANE:
        start, length = k.run_lengths(level, dy, dx)
        assert np.array_equal(np.where(start, length, 0).reshape(len(mask), -1).sum(1), pixels)
    label = k.zones(level)
    assert ((label >= 0) == mask).all()
    for name, values in k.texture(gray, mask).items():
        assert np.isfinite(values).all(), name
    assert (k.levels(gray, mask)[mask] >= 1).all()


def test_zones_match_a_flood_fill(stack):
    level = k.levels(*stack, width=100)
    got = k.zones(level)
    for n in range(len(level)):
        seen = np.full(level[n].shape, -1)
        for y, x in np.argwhere(level[n] > 0):
            if seen[y, x] < 0:
                todo, name = [(y, x)], y * level.shape[2] + x
                while todo:
                    a, b = todo.pop()
                    if 0 <= a < level.shape[1] and 0 <= b < level.shape[2] and seen[a, b] < 0 and level[n, a, b] == level[n, y, x]:
                        seen[a, b] = name
                        todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        assert np.array_equal(seen, got[n])


def test_zones_that_wind():
    """A spiral and a comb are one zone each, whatever the order of their rows."""
    spiral = np.array([[1, 1, 1, 1, 1], [2, 2, 2, 2, 1], [1, 1, 1, 2, 1], [1, 2, 2, 2, 1], [1, 1, 1, 1, 1]])
    got = k.zones(spiral[None])[0]
    assert set(got[spiral == 1].tolist()) == {0} and set(got[spiral == 2].tolist()) == {5}
    comb = np.ones((6, 9), int)
    comb[:5, 1::2] = 0
    assert set(k.zones(comb[None])[0][comb == 1].tolist()) == {0} and (k.zones(comb[None, ::-1])[0][comb[::-1] == 1] == 0).all()


def test_percentiles_match_numpy(stack):
    gray, mask = stack
    at = (0, 10, 25, 50, 75, 90, 99, 100)
    for image in (gray, gray * 0.37 - 5.0, gray - 300):
        want = [[np.percentile(image[i][mask[i]], p) for i in range(len(gray))] for p in at]
        assert k.percentiles(image, mask, at) == pytest.approx(np.array(want))
    one = np.zeros_like(mask)
    one[:, 2, 3] = True
    assert (k.percentiles(gray, one, (10, 90)) == gray[:, 2, 3]).all()


def test_raster_of_rectangles_and_holes():
    square = [[(1, 1), (6, 1), (6, 6), (1, 6)], [(3, 3), (4, 3), (4, 4), (3, 4)]]
    mask = k.rasterised([square], 8, 8)
    assert (mask > 0).sum() == 36 - 4
    # a later polygon's hole erases what is there
    whole = [[(0, 0), (7, 0), (7, 7), (0, 7)]]
    assert (k.rasterised([whole, square], 8, 8) > 0).sum() == 64 - 4
    assert (k.rasterised([square, whole], 8, 8) > 0).sum() == 64
    assert (k.rasterised([[[(-3, -3), (2, -3), (2, 2), (-3, 2)]]], 8, 8) > 0).sum() == 9
    assert k.rasterised([[[(0, 0), (3, 3)]]], 8, 8).sum() == 0
    local, box = k.local_mask([square])
    assert box == (0, 0, 7, 7) and (local > 0).sum() == 32
    with pytest.raises(ValueError):
        k.local_mask([])


def test_shape_of_a_rectangle():
    f = k.shape2d(np.ones((3, 5)))
    assert f["PixelSurface"] == 15 and f["MeshSurface"] == pytest.approx(15 - 0.5) and f["Perimeter"] == pytest.approx(2 * (4 + 2) + 4 * 0.5**0.5)
    assert f["MajorAxisLength"] == pytest.approx(4 * np.sqrt(24 / 12)) and 0 < f["Sphericity"] <= 1
    assert k.shape2d(np.ones((1, 2))) is None


def test_spans_of_slanted_sub_pixel_and_concave_rings():
    """Masks worked out by hand: vertices are cut to whole pixels; spans run from halves up to halves down."""

    def drawn(*polygons, h=8, w=8):
        return ["".join("#" if v else "." for v in row) for row in k.rasterised(list(polygons), h, w)]

    assert drawn([[(0, 0), (6, 3), (2, 7)]]) == ["#.......", "###.....", ".####...", ".######.", ".#####..", ".####...", "..##....", "..#....."]
    assert drawn([[(0.9, 0.2), (6.7, 3.9), (2.2, 7.9)]]) == drawn([[(0, 0), (6, 3), (2, 7)]])
    assert drawn([[(0, 0), (4, 0), (2, 2), (4, 4), (0, 4)]], h=5, w=5) == ["#####", "####.", "###..", "####.", "#####"]  # concave
    assert drawn([[(1, 1), (4, 1), (4, 1.9), (1, 1.2)]], h=4, w=6) == ["......", ".####.", "......", "......"]  # no height: its edges only
    assert drawn([[(-0.9, -0.9), (2.5, -0.5), (2.5, 1.5), (-0.5, 1.5)]], h=3, w=4) == ["###.", "###.", "...."]  # cut towards 0
    assert drawn([[(-5, -5), (20, -5), (20, 20), (-5, 20)]], h=3, w=4) == ["####"] * 3
    assert drawn([[(0, 0), (7, 0), (7, 7), (0, 7)], [(2, 2), (5, 2), (5, 5)]])[2:6] == ["##....##", "###...##", "####..##", "#####.##"]
    assert k.rasterised([[[(0, 0), (3, np.nan), (3, 3)]], [[(1, 1), (2, 1)]], []], 4, 4).sum() == 0


def test_masks_of_many_images_are_those_of_each():
    rng = np.random.default_rng(4)
    images = [[[rng.uniform(-6, 26, (rng.integers(3, 9), 2)) for _ in range(rng.integers(1, 3))] for _ in range(rng.integers(0, 5))] for _ in range(30)]
    shapes = [(int(rng.integers(1, 20)), int(rng.integers(1, 20))) for _ in images]
    for got, polygons, shape in zip(k.rasterised_all(images, shapes), images, shapes, strict=True):
        one = np.zeros(shape, np.uint8)
        for rings in polygons:  # one ring after the other, span by span
            for i, ring in enumerate(rings):
                for _, y, a, b in zip(*k.ring_spans([k.points_of(ring)], np.array([shape[0]])), strict=True):
                    one[y, max(a, 0) : max(b + 1, 0)] = 0 if i else 255
        assert np.array_equal(got, one)
    assert k.rasterised_all([], []) == [] and k.rasterised_all([[]], [(2, 3)])[0].tolist() == [[0] * 3] * 2


def test_zones_and_neighbours_along_one_axis():
    level = np.array([[[1, 1, 2, 2], [1, 2, 2, 1]]])
    assert k.zones(level, k.AXIS).tolist() == [[[0, 0, 2, 2], [4, 5, 5, 7]]]
    assert k.glszm(level, k.AXIS)["ZonePercentage"][0] == 5 / 8 and k.glszm(level)["ZonePercentage"][0] == 3 / 8
    assert k.gldm(level, offsets=k.AXIS)["LargeDependenceEmphasis"][0] == (6 * 4 + 2) / 8
    assert k.ngtdm(level, k.AXIS)["Coarseness"][0] == pytest.approx(1 / ((4 / 8) * (0 + 0.5 + 1 + 1) + (4 / 8) * (0.5 + 0 + 0.5 + 0.5)))


def test_outlines_run_through_pixel_centres():
    m = np.zeros((9, 9), int)
    m[0, 0] = 1  # a pixel
    m[0, 3:7] = 1  # a line
    m[2:5, 1:4] = 1  # a block
    m[2:5, 6] = m[4, 6:9] = m[2:5, 8] = 1  # a bay of one pixel's width
    m[6, 1] = m[7, 0:3] = m[8, 1] = 1  # a diamond
    m[6:9, 5:8] = 1
    m[7, 6] = 0  # a ring, whose hole does not count
    got = k.numbered_outlines(m)
    assert [n for n, _ in got] == [3, 5, 6]  # numbers stay where parts are left out
    assert got[0][1] == [(1.0, 2.0), (1.0, 4.0), (3.0, 4.0), (3.0, 2.0)]
    assert got[1][1] == [(1.0, 6.0), (0.0, 7.0), (1.0, 8.0), (2.0, 7.0)]
    assert got[2][1] == [(5.0, 6.0), (5.0, 8.0), (7.0, 8.0), (7.0, 6.0)]
    assert k.outlines(np.zeros((3, 3), int)) == []


def test_parts_with_a_spike_or_a_bridge_have_no_outline():
    spike, bridge, corner = np.zeros((3, 10, 10), int)
    spike[1:4, 1:4] = 1
    assert len(k.outlines(spike)) == 1
    spike[2, 4] = 1  # a bump: the outline turns around it without a second visit
    assert k.outlines(spike) == [[(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (4.0, 2.0), (3.0, 1.0)]]
    spike[2, 5] = 1
    assert k.outlines(spike) == []
    bridge[1:4, 1:4] = bridge[1:4, 6:9] = bridge[2, 4:6] = 1
    corner[1:4, 1:4] = corner[4:7, 4:7] = 1
    assert k.outlines(bridge) == k.outlines(corner) == []  # the way over is walked there and back


def test_outlines_of_random_masks_are_simple_and_enclose_their_pixels():
    rng = np.random.default_rng(9)
    for _ in range(60):
        m = (rng.random((12, 14)) < 0.6).astype(int)
        label = k.zones(m[None])[0]
        parts = np.unique(label[label >= 0])
        for number, ring in k.numbered_outlines(m):
            own = label == parts[number - 1]
            area = abs(sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
            steps = sum(int(max(abs(c - a), abs(d - b))) for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True))
            outside = k.zones((np.pad(own, 1) == 0).astype(int)[None], ((0, 1), (1, 0)))[0]
            filled = int((outside[1:-1, 1:-1] != 0).sum())  # the part with its holes
            assert area > 0 and area + steps / 2 + 1 == filled  # by the points that a simple outline has on and in it


def test_shapes_of_many_cells_are_those_of_each(limits=(20, 25)):
    """Cells of all sizes at once against one mask at a time: closed, short and broken rings, holes, several polygons, images that cut them."""
    rng = np.random.default_rng(5)
    cells = [[[rng.uniform(-15, 40, (rng.integers(0, 7), 2)).round(int(rng.integers(0, 2))) for _ in range(rng.integers(1, 3))] for _ in range(rng.integers(0, 3))] for _ in range(300)]
    cells += [[[np.array([(0, 0), (4, 0), (4, 3), (0, 3), (0, 0)], float)]], [[np.array([(0, 0), (np.nan, 0), (4, 3)])]]]
    flat = [(r, c, j == 0) for c, polygons in enumerate(cells) for rings in polygons for j, r in enumerate(rings)]
    args = np.concatenate([f[0] for f in flat]), np.array([len(f[0]) for f in flat]), np.array([f[1] for f in flat]), np.array([f[2] for f in flat]), len(cells)
    for cut in (None, limits):
        made = k.shapes_of(*args, None if cut is None else np.tile(cut, (len(cells), 1)))
        for polygons, row in zip(cells, made, strict=True):
            (found,) = k.local_masks([polygons])
            want = None
            if found is not None:
                mask, (x0, y0, _, _) = found
                want = k.shape2d(mask if cut is None else mask[max(0, -y0) : max(0, cut[0] - y0), max(0, -x0) : max(0, cut[1] - x0)])
            assert np.isnan(row).all() if want is None else np.allclose(row, list(want.values()), 0, 1e-10)


def test_statistics_of_many_rows_are_those_of_each():
    rng = np.random.default_rng(6)
    count = rng.integers(0, 30, 80)
    values = rng.integers(0, 12, (count.sum(), 2)) / 4
    values[:, 1] = np.where(np.arange(len(values)) % 2 > 0, 1.5, rng.normal(size=len(values)).round(10))
    row = np.repeat(np.arange(80), count)
    made = k.statistics_of(values, row, 80).reshape(80, 2, -1)
    for i in range(80):
        for c in range(2):
            want = k.statistics(values[row == i, c])
            assert np.isnan(made[i, c]).all() if want is None else np.allclose(made[i, c], want, 1e-12, 1e-12)
