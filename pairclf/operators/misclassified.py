"""Images a model got wrong, by carried name and by vector equality."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.fixed_values import LISTED_COLUMN, LISTED_IMAGES
from ..session import write_table
from .scoring import MODEL, predict
from .splits import with_bucket

LISTED_BY = ["kind", "class1", "class2", "train_fraction", "numIter", "stepSize", "regParam"]


def misclassified(features: DataFrame, models: DataFrame) -> DataFrame:
    """Every misclassified test row of every model, with its image name."""
    return predict(features, models, errors_only=True)


def first_images(errors: DataFrame, extra: tuple[str, ...] = (), rows: int = LISTED_IMAGES) -> DataFrame:
    """The first images by name of every model. Spark cuts each partition to
    ``rows`` per model before the shuffle, so no model's errors meet in one task."""
    by_name = Window.partitionBy(*LISTED_BY).orderBy("images")
    return (
        errors.withColumn("_row", F.row_number().over(by_name))
        .filter(F.col("_row") <= rows)
        .select(*LISTED_BY, F.col("images").alias(LISTED_COLUMN), *extra)
    )


def with_vector_key(features: DataFrame, hash_of: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """Add ``_hash`` and ``_other``, which together are equal for equal vectors only.

    Only hashes are grouped. Vectors themselves meet just where a hash repeats, to
    number those that differ all the same, so distinct vectors are never shuffled.
    Both small tables are written first: their size then decides how they join.
    """
    hashed = features.withColumn("_hash", hash_of("features").cast("bigint"))
    counts = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = write_table(counts.filter(F.col("_n") > 1).select("_hash"), "repeated-hashes")
    if repeated.isEmpty():
        return hashed.withColumn("_other", F.lit(0))
    different = hashed.join(repeated, "_hash", "left_semi").select("_hash", "features").distinct()
    # A window holds the different vectors of one hash, one as a rule.
    of_hash = Window.partitionBy("_hash").orderBy("features")
    numbered = different.withColumn("_other", F.row_number().over(of_hash) - 1).filter(F.col("_other") > 0)
    others = write_table(numbered, "other-vectors")
    return hashed.join(others, ["_hash", "features"], "left").fillna(0, ["_other"])


def misclassified_by_vector(
    features: DataFrame, models: DataFrame, hash_of: Callable[[str], Column] = F.xxhash64, listed: int | None = None
) -> DataFrame:
    """Test images whose vector equals that of a misclassified row of the model, or the
    first ``listed`` of them by name.

    ``times_listed`` says how often the plain chain of joins (errors to test rows
    on the vector, then to test rows on the image) would repeat the image: rows of
    the image, times its rows with the vector, times misclassified rows with the
    vector. It comes from counts, so copies of a vector are never paired, and only for
    the images that are listed.
    """
    vector = ["_hash", "_other"]
    rows = with_vector_key(features, hash_of)
    wrong = write_table(
        predict(rows, models, carry=vector, errors_only=True).groupBy(*MODEL, *vector).agg(F.count(F.lit(1)).alias("_wrong")),
        "wrong-vectors",
    )
    copies = with_bucket(rows.select("label", "images", *vector)).groupBy("label", "bucket", "images", *vector).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    names = _images_with_vector(wrong, copies, vector, listed)
    if listed is not None:
        names = write_table(first_images(names, ("model_number",), listed).withColumnRenamed(LISTED_COLUMN, "images"), "listed")
    in_task = (F.col("kind") == "1vsAll") | F.col("label").isin(F.col("class1"), F.col("class2"))
    # All rows of the listed names, each once; a name has one bucket, so all are test rows.
    own = copies.join(names.select("images").distinct(), "images", "left_semi").drop("bucket")
    counted = names.join(own, "images").filter(in_task).join(wrong, [*MODEL, *vector], "left")
    return (
        counted.groupBy(*MODEL, "images")
        .agg(F.sum("_copies").alias("_rows"), F.sum(F.col("_copies") * F.col("_wrong")).alias("_pairs"))
        .select(*MODEL, "images", (F.col("_rows") * F.col("_pairs")).alias("times_listed"))
    )


def _images_with_vector(wrong: DataFrame, copies: DataFrame, vector: list[str], listed: int | None) -> DataFrame:
    """(model, images): test images that have a vector which the model got wrong; with
    ``listed``, at least the first so many of each model.

    The first names are cut per vector, share and label before models see them, so that a
    vector with any number of images meets each of its models with ``listed`` of them.
    Tasks against the rest look at the images of all labels, a null label here.
    """
    cut = F.round(F.col("train_fraction") * 100).cast("int").alias("_cut")
    is_rest = F.col("kind") == "1vsAll"
    labels = F.when(is_rest, F.array(F.lit(None).cast("string"))).otherwise(F.array("class1", "class2"))
    asked = wrong.select(*MODEL, *vector, cut, F.explode(labels).alias("_label"))
    with_any = copies.select(*vector, "bucket", "images", F.explode(F.array("label", F.lit(None).cast("string"))).alias("_label"))
    key = [*vector, "_cut"]
    needed = asked.select(*key, "_label").distinct()
    found = needed.alias("n").join(
        with_any.alias("c"),
        (F.col("n._hash") == F.col("c._hash")) & (F.col("n._other") == F.col("c._other"))
        & F.col("n._label").eqNullSafe(F.col("c._label")) & (F.col("c.bucket") >= F.col("n._cut")),
    ).select(*[F.col(f"n.{k}").alias(k) for k in [*key, "_label"]], "images")
    if listed is not None:
        # A name may have several labels: names are ranked, not rows.
        by_name = Window.partitionBy(*key, "_label").orderBy("images")
        found = found.withColumn("_rank", F.dense_rank().over(by_name)).filter(F.col("_rank") <= listed).drop("_rank")
    found = found.distinct()
    return asked.alias("a").join(
        found.alias("f"),
        (F.col("a._hash") == F.col("f._hash")) & (F.col("a._other") == F.col("f._other")) & (F.col("a._cut") == F.col("f._cut"))
        & F.col("a._label").eqNullSafe(F.col("f._label")),
    ).select(*[F.col(f"a.{m}").alias(m) for m in MODEL], F.col("f.images").alias("images")).distinct()
