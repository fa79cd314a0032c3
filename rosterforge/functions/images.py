"""Size rules for images and documents, on metadata only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge import fixed


def stored_size(width: Column, height: Column) -> Column:
    """Size after limiting the width, as struct<width,height>."""
    limit = fixed.STORED_IMAGE_WIDTH
    scaled = F.floor(height * (F.lit(float(limit)) / width)).cast("int")
    wide = width > limit
    return F.struct(
        F.when(wide, F.lit(limit)).otherwise(width).alias("width"),
        F.when(wide, scaled).otherwise(height).alias("height"),
    )


def model_size(width: Column, height: Column) -> Column:
    """Size after limiting the longer side, as struct<width,height>."""
    limit = float(fixed.MODEL_IMAGE_SIDE)
    ratio = F.least(F.lit(limit) / width, F.lit(limit) / height)
    large = (width > limit) | (height > limit)
    return F.struct(
        F.when(large, F.floor(width * ratio).cast("int")).otherwise(width).alias("width"),
        F.when(large, F.floor(height * ratio).cast("int")).otherwise(height).alias("height"),
    )


def screen_reason(kind: Column, size: Column, width: Column, height: Column) -> Column:
    """Why an asset is refused; null means it is kept."""
    ratio = F.when(height != 0, width / height).otherwise(0.0)
    image = kind == "image"
    return (
        F.when((kind == "pdf") & (size < fixed.PDF_MIN_BYTES), "small_pdf")
        .when((kind == "pdf") & size.isNotNull(), F.lit(None).cast("string"))
        .when(image & (size < fixed.IMAGE_MIN_BYTES), "small_image")
        .when(image & (size.isNull() | width.isNull() | height.isNull()), "unreadable")
        .when(image & ((width < fixed.IMAGE_MIN_SIDE) | (height < fixed.IMAGE_MIN_SIDE)), "small_sides")
        .when(image & ((ratio > fixed.IMAGE_MAX_RATIO) | (ratio < fixed.IMAGE_MIN_RATIO)), "extreme_ratio")
        .when(image, F.lit(None).cast("string"))
        .otherwise("unreadable")
    )
