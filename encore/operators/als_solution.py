"""Whether ALS factors solve what ALS is to solve: residuals of the normal equations.

The last half step of an implicit fit solves, for every row x of one side and the fixed
factors Y of the other,

    (Y'Y + Y'(C - I)Y + reg * n * I) x = Y'C p

over the row's ratings r: confidence C = 1 + alpha * |r|, preference p = 1 for r > 0 else 0,
n its positive ratings.  Spark's solver ends with the users' half step.

Y'Y is a sum of outer products, one aggregate over the fixed factors whose state has
rank x rank numbers.  The rest of the left side is a sum over the row's ratings of
alpha * |r| * (y . x) * y, so no matrix per row is ever built: ratings meet both factors in
equi-joins, and their terms are summed place by place, in the row's own partition.  Only columns,
no Python.

Edge cases: rows without ratings and ratings without factors give no row; null and unknown
ids are dropped as by the fit; a zero right side is solved by zero factors.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative residual up to which a row counts as solved: factors are 32-bit floats.
TOLERANCE = 1e-4


def gram(factors: DataFrame, features: str = "features") -> DataFrame:
    """One row with ``gram``, the sum of the factors' outer products, row by row in one array."""
    outer = F.flatten(F.transform(features, lambda a: F.transform(features, lambda b: a.cast("double") * b.cast("double"))))
    return factors.select(array_to_vector(outer).alias("__o")).agg(vector_to_array(Summarizer.sum(F.col("__o"))).alias("gram"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normal_residuals(ratings: DataFrame, solved: DataFrame, fixed: DataFrame, reg: float, alpha: float,
                     row_col: str = "user_id", other_col: str = "item_id", rating_col: str = "total_count") -> DataFrame:
    """``row_col``, ``n_ratings`` and ``residual`` (of the row's normal equation, relative to its terms) of every
    rated row of ``solved``, given the other side's factors ``fixed`` (both: ``id``, ``features``)."""
    # one row of rank * rank numbers; empty factors give an empty sum
    g = gram(fixed).select(F.first("gram")).scalar()
    size = F.size("__x")
    gx = F.transform(F.sequence(F.lit(0), size - 1), lambda j: _dot(F.slice("__g", j * size + 1, size), F.col("__x")))
    # the Gram matrix meets a row once, below the join, and not once per rating
    x = (solved.select(F.col("id").alias("__x_id"), F.col("features").alias("__x")).withColumn("__g", g)
               .select("__x_id", "__x", gx.alias("__gx")))
    y = fixed.select(F.col("id").alias("__y_id"), F.col("features").alias("__y"))
    rated = (ratings.select(F.col(row_col).cast("int").alias("__row"), F.col(other_col).cast("int").alias("__other"),
                            F.col(rating_col).cast("float").cast("double").alias("__r"))
                    .join(y, F.col("__other") == F.col("__y_id")).join(x, F.col("__row") == F.col("__x_id")))
    more = F.lit(float(alpha)) * F.abs("__r")
    liked = F.when(F.col("__r") > 0, 1 + more).otherwise(F.lit(0.0))
    # one number per rating and place, so that the sums are plain ones; a weight is found once per rating
    weighed = rated.select("__row", "__r", (more * _dot(F.col("__y"), F.col("__x"))).alias("__w"), liked.alias("__liked"),
                           F.arrays_zip("__y", "__x", "__gx").alias("__places"))
    places = weighed.select("__row", "__r", "__w", "__liked", F.posexplode("__places").alias("__j", "__p"))
    v = F.col("__p")["__y"].cast("double")
    summed = places.groupBy("__row", "__j").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.count(F.when(F.col("__r") > 0, 1)).alias("__n"),
        F.sum(F.col("__w") * v).alias("__left"), F.sum(F.col("__liked") * v).alias("__right"),
        F.first(F.col("__p")["__x"].cast("double")).alias("__x"), F.first(F.col("__p")["__gx"]).alias("__gx"))
    whole = F.col("__gx") + F.col("__left") + F.lit(float(reg)) * F.col("__n") * F.col("__x")
    norm = lambda c: F.sqrt(F.sum(c * c))
    # the sizes of the terms that cancel
    terms = norm(F.col("__gx")) + norm(F.col("__left")) + norm(F.col("__right"))
    out = summed.groupBy("__row").agg(F.max("n_ratings").alias("n_ratings"), norm(whole - F.col("__right")).alias("__gap"), terms.alias("__terms"))
    return out.select(F.col("__row").alias(row_col), "n_ratings",
                      F.when(F.col("__terms") > 0, F.col("__gap") / F.col("__terms")).otherwise(F.col("__gap")).alias("residual"))


def check_last_half_step(model, ratings: DataFrame, reg: float, alpha: float, tolerance: float = TOLERANCE,
                         user_col: str = "user_id", item_col: str = "item_id", rating_col: str = "total_count") -> DataFrame:
    """``user``, ``n_ratings`` and ``solved`` for every user of an implicit ALS model that rated a known item."""
    found = normal_residuals(ratings, model.userFactors, model.itemFactors, reg, alpha, user_col, item_col, rating_col)
    return found.select(user_col, "n_ratings", (F.col("residual") <= tolerance).alias("solved"))
