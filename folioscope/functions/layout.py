"""Rules for rendering sheets and pages, as expressions: paper, resolution, strategy, tiles, cost."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (most columns, most rows, width and height in mm, landscape, pages wide, pages high); None is no limit, 0 pages as many as needed.
PAPERS = (
    (8, 15, 297, 210, True, 1, 1), (15, 30, 420, 297, True, 1, 1), (20, 50, 1190, 841, True, 1, 1), (20, None, 594, 841, False, 1, 0),
    (50, None, 841, 594, True, 1, 0), (100, None, 1189, 841, True, 1, 0), (None, None, 3000, 2000, True, 1, 0),
)


def paper(columns: Column, rows: Column) -> Column:
    """struct(width_mm, height_mm, landscape, pages_wide, pages_high) of the first paper that holds a sheet."""
    out = None
    for c, r, *values in PAPERS:
        fits = (columns <= c if c else F.lit(True)) & (rows <= r if r else F.lit(True))
        value = F.struct(*[F.lit(v).alias(n) for n, v in zip(("width_mm", "height_mm", "landscape", "pages_wide", "pages_high"), values)])
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def strategy(columns: Column, rows: Column, pages: Column) -> Column:
    small = ((columns <= 8) & (rows <= 15)) | ((columns <= 15) & (rows <= 30))
    return F.when(small, "small_sheet").when(pages > 1, "multi_page").otherwise("single_page")


def resolution(width_mm: Column, *, wide: float, extreme: float, default: int, wide_dpi: int, extreme_dpi: int) -> Column:
    return F.when(width_mm >= extreme, extreme_dpi).when(width_mm >= wide, wide_dpi).otherwise(default)


def tiles(width: Column, height: Column, tile: int = 3000, overlap: int = 300) -> Column:
    """Array of struct(name, left, top, right, bottom), row by row; neighbours share ``overlap`` pixels."""
    step = tile - overlap
    starts = lambda size: F.sequence(F.lit(0), F.greatest(F.lit(0), size - 1), F.lit(step))

    def one(top: Column, r: Column) -> Column:
        return F.transform(starts(width), lambda left, c: F.struct(
            F.format_string("tile_r%02d_c%02d", r, c).alias("name"), left.alias("left"), top.alias("top"),
            F.least(left + tile, width).alias("right"), F.least(top + tile, height).alias("bottom"),
        ))

    return F.flatten(F.transform(starts(height), one))


def model_cost(pages: Column, tokens: int, price_per_thousand: float) -> Column:
    return F.round(pages * tokens / 1000.0 * price_per_thousand, 6)
