"""Rasters as tiles: one row an array of pixels, instead of one row a pixel.

Pixels and tiles are cells of the curve (``geotaxa.operators.curve``): a tile of
``bits`` holds the 4^bits pixels that lie ``bits`` levels below it, in curve
order, so a pixel's place in its tile is the last 2 * bits bits of its id.  A
lookup joins the tile (one key for thousands of pixels) and takes the value out
by position; no pixel is ever a row of a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.functions.joins import own_shuffle
from geotaxa.operators.curve import point_cell

# Pixels along a tile's side: 2^6.
BITS = 6


def tile_of(pixel: str | Column, bits: int = BITS) -> Column:
    return F.shiftright(F.col(pixel) if isinstance(pixel, str) else pixel, 2 * bits)


def offset_in_tile(pixel: str | Column, bits: int = BITS) -> Column:
    c = F.col(pixel) if isinstance(pixel, str) else pixel
    return c.bitwiseAND(F.lit((1 << 2 * bits) - 1)).cast("int")


def build_tiles(pixels: DataFrame, bits: int = BITS, pixel: str = "pixel", value: str = "value",
                by: Sequence[str] = ()) -> DataFrame:
    """(*by, tile, pixels): one row per tile (and per ``by``, e.g. a date) with an
    array of 4^bits values in curve order, null where the raster has none.

    A pixel that is given several times has its largest value; rows without a
    pixel are left out.  The array's length is fixed, whatever the data."""
    one = pixels.where(F.col(pixel).isNotNull()).groupBy(*by, pixel).agg(F.max(value).alias("_v"))
    placed = one.where("_v is not null").select(*by, tile_of(pixel, bits).alias("tile"), offset_in_tile(pixel, bits).alias("_at"), "_v")
    listed = placed.groupBy(*by, "tile").agg(F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("_e"))
    null = F.lit(None).cast(pixels.schema[value].dataType)
    before = lambda i: F.coalesce(F.get("_e", i - 1)["_at"], F.lit(-1))
    dense = F.flatten(F.transform("_e", lambda x, i: F.concat(F.array_repeat(null, x["_at"] - before(i) - 1), F.array(x["_v"]))))
    rest = F.array_repeat(null, F.lit(1 << 2 * bits) - F.element_at("_e", -1)["_at"] - 1)
    return listed.select(*by, "tile", F.concat(dense, rest).alias("pixels"))


def tile_values(points: DataFrame, tiles: DataFrame, level: int, bits: int = BITS, lat: str = "latitude",
                lon: str = "longitude", by: Sequence[str] = (), out: str = "value") -> DataFrame:
    """Every point row once, with the value of the pixel (a cell of ``level``) it
    lies in; null where the raster has none or the point has no place.  The
    tiles are shuffled by themselves, so AQE splits the points of a hot one."""
    pixel = point_cell(lat, lon, level)
    kept = points.drop(out)
    asked = kept.withColumn("tile", tile_of(pixel, bits)).withColumn("_at", offset_in_tile(pixel, bits))
    joined = asked.join(own_shuffle(tiles), on=[*by, "tile"], how="left")
    return joined.select(*kept.columns, F.get("pixels", F.col("_at")).alias(out))
