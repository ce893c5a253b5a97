"""Image maps as array columns: row-local expressions, so no pixel is ever shuffled.

A map is ``array<double>`` in row-major order. All functions build Columns; Catalyst sees plain expressions and the rows
stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Luma weights.
LUMA = (0.2126, 0.7152, 0.0722)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clip(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi)))


def luminance(r: Column, g: Column, b: Column) -> Column:
    """Elementwise luma of three channel maps."""
    parts = F.arrays_zip(r.alias("r"), g.alias("g"), b.alias("b"))
    return F.transform(parts, lambda p: p["0"] * LUMA[0] + p["1"] * LUMA[1] + p["2"] * LUMA[2])


def abs_difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.abs(x - y))


def maximum(*maps: Column) -> Column:
    """Elementwise maximum of maps."""
    out = maps[0]
    for m in maps[1:]:
        out = F.zip_with(out, m, lambda x, y: F.greatest(x, y))
    return out


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    """Mean of a map, null for an empty one."""
    return F.when(F.size(a) > 0, total(a) / F.size(a))


def quantile(ordered: Column, q: float) -> Column:
    """Linearly interpolated quantile of an ascending array."""
    place = (F.size(ordered) - 1) * F.lit(float(q))
    low = F.floor(place).cast("int")
    a, b = F.get(ordered, low), F.coalesce(F.get(ordered, low + 1), F.get(ordered, low))
    return a + (b - a) * (place - low)


def top_area_mean(ordered: Column, fraction: float) -> Column:
    """Mean of the largest ``fraction`` of an ascending array, one value at least."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    n = F.greatest(F.lit(1), F.ceil(F.size(ordered) * F.lit(float(fraction))).cast("int"))
    return F.when(F.size(ordered) > 0, total(F.slice(ordered, F.size(ordered) - n + 1, n)) / n)


def fraction_name(fraction: float) -> str:
    return "top_" + f"{fraction * 100:.4f}".rstrip("0").rstrip(".").replace(".", "_") + "pct_mean"


def summary(a: Column, fractions=(0.0001, 0.0005, 0.001, 0.005, 0.01)) -> dict[str, Column]:
    """Named statistics of a map: mean, max, three quantiles and a top-area mean per fraction."""
    ordered = F.array_sort(a)
    found = {"mean": mean(a), "max": F.array_max(a)} | {n: quantile(ordered, q) for n, q in (("q95", 0.95), ("q99", 0.99), ("q999", 0.999))}
    found |= {fraction_name(f): top_area_mean(ordered, f) for f in fractions}
    return {k: F.coalesce(v, F.lit(0.0)) for k, v in found.items()}


def robust_score(a: Column) -> Column:
    """Local severity: the greatest of mean, 0.90 of the top tenth, 0.95 of the top hundredth and 0.85 of the peak."""
    score = lambda o: F.greatest(mean(o), 0.90 * top_area_mean(o, 0.10), 0.95 * top_area_mean(o, 0.01), 0.85 * F.element_at(o, -1))
    return F.when(F.size(a) > 0, clip(let(F.array_sort(a), score))).otherwise(0.0)


def merged_metrics(metrics: Column, local: Column, prefix: str = "local_") -> Column:
    """Two maps as one, the second's names with a prefix; of equal names the second's value stays."""
    named = F.transform_keys(local, lambda k, v: F.concat(F.lit(prefix), k))
    return F.map_concat(F.map_filter(metrics, lambda k, v: ~F.array_contains(F.map_keys(named), k)), named)


def histogram(a: Column, bins: int = 64) -> Column:
    """Counts of ``bins`` equal bins over [0, 1], 1 in the last."""
    place = F.transform(a, lambda v: F.least(F.floor(v * bins), F.lit(bins - 1)))
    count = lambda at: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.size(F.filter(at, lambda p: p == i)))
    return let(place, count)


def histogram_distance(a: Column, b: Column, bins: int = 64) -> Column:
    """Total variation distance of two maps' histograms."""
    gaps = F.zip_with(histogram(a, bins), histogram(b, bins), lambda x, y: F.abs(x / F.greatest(F.size(a), F.lit(1)) - y / F.greatest(F.size(b), F.lit(1))))
    return 0.5 * total(gaps)


def repeat_distance(a: Column, b: Column) -> Column:
    """How far two maps are from being the same frame: mean difference, or a share of its upper quantiles."""
    worst = lambda o: F.greatest(mean(o), 0.10 * quantile(o, 0.95), 0.05 * quantile(o, 0.99))
    return F.coalesce(let(F.array_sort(abs_difference(a, b)), worst), F.lit(0.0))


def sobel(a: Column, height: int, width: int) -> Column:
    """Sobel magnitude / 4, clipped; the border repeats its pixels."""

    def at(y, x):
        return F.get(a, clamp(y, height) * width + clamp(x, width))

    def clamp(i, n):
        return F.least(F.greatest(i, F.lit(0)), F.lit(n - 1)).cast("int")

    def pixel(i):
        y, x = F.floor(i / width).cast("int"), (i % width).cast("int")
        right = at(y - 1, x + 1) + 2.0 * at(y, x + 1) + at(y + 1, x + 1)
        left = at(y - 1, x - 1) + 2.0 * at(y, x - 1) + at(y + 1, x - 1)
        low = at(y + 1, x - 1) + 2.0 * at(y + 1, x) + at(y + 1, x + 1)
        high = at(y - 1, x - 1) + 2.0 * at(y - 1, x) + at(y - 1, x + 1)
        gx, gy = right - left, low - high
        return clip(F.sqrt(gx * gx + gy * gy) / 4.0)

    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), pixel)


def error_maps(prediction: Column, truth: Column, height: int, width: int) -> Column:
    """struct of aligned evidence of two luma maps: luminance, both Sobel maps, one-sided edges, edge, and structure, their
    fusion by maximum. Select the struct once and take its fields from there."""

    def build(e: Column) -> Column:
        edges_t, edges_p = e["t"], e["p"]
        gt_only = F.zip_with(edges_t, edges_p, lambda t, p: F.greatest(t - p, F.lit(0.0)))
        pred_only = F.zip_with(edges_t, edges_p, lambda t, p: F.greatest(p - t, F.lit(0.0)))
        edge = F.zip_with(edges_t, edges_p, lambda t, p: F.abs(t - p))
        luma = abs_difference(prediction, truth)
        structure = F.zip_with(luma, edge, lambda v, x: F.greatest(v, clip(x * 1.25)))
        maps = {"luminance": luma, "sobel_gt": edges_t, "sobel_prediction": edges_p, "gt_only_edge": gt_only, "pred_only_edge": pred_only, "edge": edge, "structure": structure}
        return F.struct(*[v.alias(k) for k, v in maps.items()])

    return let(F.struct(sobel(truth, height, width).alias("t"), sobel(prediction, height, width).alias("p")), build)


def window_starts(n: int, size: int) -> list[int]:
    """Starts of windows of ``size`` at half-size steps over n, the last one flush with the end."""
    size = min(max(1, size), n)
    step = max(1, size // 2)
    starts = list(range(0, max(1, n - size + 1), step))
    return starts if starts[-1] == n - size else [*starts, n - size]


def window_means(a: Column, height: int, width: int, window: int) -> Column:
    """array<struct<y, x, mean>> over the window grid, from an integral image: four lookups per window.

    Prefix sums are arrays that grow by one, which costs the square of a side: meant for small maps and for comparison. The
    mining plan takes ``kernels.window_grid``.
    """
    sy, sx = min(window, height), min(window, width)
    # running sums along rows, then down columns
    rows = F.transform(F.sequence(F.lit(0), F.lit(height - 1)), lambda y: F.slice(a, y * width + 1, width))
    along = F.transform(rows, lambda r: F.aggregate(r, F.array(F.lit(0.0)), lambda s, v: F.concat(s, F.array(F.element_at(s, -1) + v))))
    zero = F.array_repeat(F.lit(0.0), width + 1)
    summed = F.aggregate(along, F.array(zero), lambda s, r: F.concat(s, F.array(F.zip_with(F.element_at(s, -1), r, lambda p, q: p + q))))

    def cells(total: Column) -> Column:
        at = lambda y, x: F.get(F.get(total, F.lit(y)), F.lit(x))
        grid = [(y, x) for y in window_starts(height, sy) for x in window_starts(width, sx)]
        return F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x"), ((at(y + sy, x + sx) - at(y, x + sx) - at(y + sy, x) + at(y, x)) / float(sy * sx)).alias("mean")) for y, x in grid])

    return let(summed, cells)


def edge_endpoints(a: Column, height: int, width: int, threshold: float) -> Column:
    """Number of pixels at or above a threshold with at most one such pixel among their eight neighbours.

    Each pixel looks at its eight neighbours: linear in the pixels.
    """

    def counted(on: Column) -> Column:
        def near(i: Column) -> Column:
            x = i % width
            steps = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) != (0, 0)]
            inside = {-1: x > 0, 0: F.lit(True), 1: x < width - 1}
            # above and below the image there is nothing to get
            return sum((F.coalesce(F.get(on, F.greatest(i + dy * width + dx, F.lit(-1))) & (i + dy * width + dx >= 0) & inside[dx], F.lit(False)).cast("int") for dy, dx in steps), F.lit(0))

        return F.size(F.filter(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda i: F.get(on, i) & (near(i) <= 1)))

    return let(F.transform(a, lambda v: v >= threshold), counted)


def border_overlap(x0: Column, y0: Column, x1: Column, y1: Column, height: int, width: int, fraction: float) -> Column:
    """Share of a half-open box in the outer bands of an image."""
    bx, by = -int(-width * fraction // 1), -int(-height * fraction // 1)
    side = lambda a, b, band, n: F.greatest(F.least(b, F.lit(max(band, n - band))) - F.greatest(a, F.lit(band)), F.lit(0))
    inner = side(x0, x1, bx, width) * side(y0, y1, by, height)
    return clip(1.0 - inner / F.greatest((x1 - x0) * (y1 - y0), F.lit(1)))
