"""Image pixels to the vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.numeric import l2_normalise
from citylake.operators.incremental import missing_vectors
from citylake.operators.vectors import insert_vectors

PIXEL_MAX = 255.0


def image_vectors(pixels: DataFrame, key: str = "id", values: str = "pixels") -> DataFrame:
    """Unit-length vectors of grayscale pixel arrays."""
    return pixels.select(F.col(key).alias("id"), l2_normalise(values, PIXEL_MAX).alias("embedding"))


def add_image_vectors(store: DataFrame, pixels: DataFrame) -> DataFrame:
    """Store plus vectors of images it lacks; only those are computed."""
    return insert_vectors(store, image_vectors(missing_vectors(pixels, store)))
