"""Reproducible split: every image belongs to one of 100 hash buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import BUCKETS


def split_bucket(image: Column, seed: str = "") -> Column:
    """Bucket 0-99 of an image name.

    The bucket hangs on the name alone, so a retried task, another source or a
    later run puts an image on the same side. Another ``seed`` is another split.
    """
    named = F.concat(F.lit(seed), image) if seed else image
    return (F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("bigint") % BUCKETS).cast("int")
