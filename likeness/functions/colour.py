"""The colour descriptor over a relational ``pixels(image_id, b, g, r)`` table.

Pixels are only ever reduced: every histogram is a count per (image, bin) with
partial sums before the shuffle, so an image with a large share of all pixels is
no hot spot. The mask of an image is chosen afterwards from three counts kept per
bin; pixels are never joined with anything.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.functions.pixels import HS_BINS, LEAST_SHARE, LOW_S, LOW_V, V_BINS
from likeness.schemas import FLOATS

HS_TOTAL = HS_BINS[0] * HS_BINS[1]


def hsv_pixels(pixels: DataFrame) -> DataFrame:
    """Adds ``h, s, v`` (hue 0..179) in 12-bit fixed point."""
    b, g, r = (F.col(c).cast("long") for c in "bgr")
    v = F.greatest(b, g, r)
    span = v - F.least(b, g, r)
    # Neither quotient is ever half-way between integers; round() would go through
    # decimals.
    s_unit = F.floor(F.lit(float(255 << 12)) / F.nullif(v, F.lit(0)) + 0.5)
    h_unit = F.floor(F.lit(float(180 << 12)) / F.nullif(span * 6.0, F.lit(0.0)) + 0.5)
    side = F.when(v == r, g - b).when(v == g, b - r + span * 2).otherwise(r - g + span * 4)
    h = F.when(span > 0, F.shiftright(side * h_unit + 2048, 12)).otherwise(0)
    s = F.when(v > 0, F.shiftright(span * s_unit + 2048, 12)).otherwise(0)
    return pixels.withColumns({"h": F.when(h < 0, h + 180).otherwise(h), "s": s, "v": v})


def hs_bin(bins=HS_BINS):
    return (F.floor(F.col("h") * bins[0] / 180) * bins[1]
            + F.floor(F.col("s") * bins[1] / 256)).cast("long")


def v_bin():
    return F.floor(F.col("v") * V_BINS / 256).cast("long")


def mask_levels(pixels: DataFrame) -> DataFrame:
    """``image_id, pixels, colourful, bright, level, kept`` per image; level 0 keeps
    colourful pixels, 1 bright ones, 2 all."""
    bright = F.col("v") >= LOW_V
    counts = hsv_pixels(pixels).groupBy("image_id").agg(
        F.count(F.lit(1)).alias("pixels"),
        F.count_if(bright & (F.col("s") >= LOW_S)).alias("colourful"),
        F.count_if(bright).alias("bright"))
    level = _level(F.col("colourful"), F.col("bright"), F.col("pixels"))
    return counts.withColumn("level", level).withColumn(
        "kept", F.element_at(F.array("colourful", "bright", "pixels"), F.col("level") + 1))


def _level(colourful, bright, total):
    return (F.when((colourful >= total * LEAST_SHARE) & (colourful > 0), 0)
            .when((colourful < total * LEAST_SHARE) & (bright > 0), 1).otherwise(2))


def histograms(pixels: DataFrame) -> DataFrame:
    """``image_id, bin, value``: filled bins of the descriptor, hue/saturation bins
    first, brightness bins after them; each part at unit length."""
    bright = F.col("v") >= LOW_V
    colourful = bright & (F.col("s") >= LOW_S)
    counts = (hsv_pixels(pixels)
              .select("image_id", F.explode(F.array(hs_bin(), v_bin() + HS_TOTAL)).alias("bin"),
                      colourful.alias("c"), bright.alias("l"))
              .groupBy("image_id", "bin")
              .agg(F.count_if("c").alias("n0"), F.count_if("l").alias("n1"),
                   F.count(F.lit(1)).alias("n2")))
    # At most 176 entries per image from here on.
    entry = F.struct("bin", F.array("n0", "n1", "n2").alias("n"))
    colour = F.col("bin") < HS_TOTAL
    images = counts.groupBy("image_id").agg(
        F.collect_list(entry).alias("entries"),
        *[F.sum(F.when(colour, F.col(f"n{i}"))).alias(f"t{i}") for i in range(3)],
        *[F.sum(F.when(colour == part, F.col(f"n{i}") * F.col(f"n{i}"))).alias(f"q{part:d}{i}")
          for i in range(3) for part in (True, False)])
    level = _level(F.col("t0"), F.col("t1"), F.col("t2")) + 1
    lengths = {part: F.sqrt(F.element_at(F.array(*[f"q{part:d}{i}" for i in range(3)]), level))
               for part in (True, False)}
    filled = images.select("image_id", level.alias("level"), lengths[True].alias("hs_length"),
                           lengths[False].alias("v_length"), F.explode("entries").alias("e"))
    count = F.element_at("e.n", F.col("level"))
    length = F.when(F.col("e.bin") < HS_TOTAL, F.col("hs_length")).otherwise(F.col("v_length"))
    return (filled.where(count > 0)
            .select("image_id", F.col("e.bin").alias("bin"), (count / length).alias("value")))


def dense(bins: DataFrame, total: int) -> DataFrame:
    """``image_id, vector`` from ``image_id, bin, value``; empty bins become 0."""
    held = bins.groupBy("image_id").agg(
        F.collect_list(F.struct("bin", "value")).alias("entries"))

    @F.arrow_udf(FLOATS)
    def scatter(entries: pa.Array) -> pa.Array:
        rows = np.repeat(np.arange(len(entries)), entries.value_lengths().to_numpy())
        flat = entries.flatten()
        out = np.zeros((len(entries), total), np.float32)
        out[rows, flat.field("bin").to_numpy()] = flat.field("value").to_numpy()
        ends = np.arange(len(entries) + 1, dtype=np.int32) * total
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return held.select("image_id", scatter("entries").alias("vector"))


def descriptors(pixels: DataFrame) -> DataFrame:
    """``image_id, vector`` (176 values)."""
    return dense(histograms(pixels), HS_TOTAL + V_BINS)


def legacy_signatures(pixels: DataFrame, bins=(8, 8)) -> DataFrame:
    """``image_id, vector``: the older unmasked hue/saturation histogram."""
    counts = (hsv_pixels(pixels).groupBy("image_id", hs_bin(bins).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    images = counts.groupBy("image_id").agg(
        F.collect_list(F.struct("bin", "n")).alias("entries"),
        F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("length"))
    filled = (images.select("image_id", "length", F.explode("entries").alias("e"))
              .select("image_id", "e.bin", (F.col("e.n") / F.col("length")).alias("value")))
    return dense(filled, bins[0] * bins[1])
