"""Ratings: mean rankings, centring, cosine neighbours and recommendations.

Ratings have the columns ``user_id, item_id, rating``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.skew import SALT_ROWS, attach, typed
from loomwork.shared import cut_lineage

AXES = {"user": ("user_id", "item_id"), "item": ("item_id", "user_id")}


def _ranked(df: DataFrame, score: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(score).desc_nulls_last(), *ties)


def top_rated(ratings: DataFrame) -> DataFrame:
    """Items by mean rating, best first."""
    means = ratings.groupBy("item_id").agg(F.avg("rating").alias("score"))
    return _ranked(means, "score", "item_id")


def top_rated_by(ratings: DataFrame, users: DataFrame, attribute: str) -> DataFrame:
    """Items by mean rating among the users of each value of ``attribute``."""
    means = (
        ratings.select("user_id", "item_id", "rating")
        .join(users.select("user_id", attribute), "user_id")
        .groupBy("item_id", attribute)
        .agg(F.avg("rating").alias("score"))
    )
    return _ranked(means, "score", "item_id", attribute)


def user_means(ratings: DataFrame) -> DataFrame:
    """Users by the mean of their ratings."""
    means = ratings.groupBy("user_id").agg(F.avg("rating").alias("score"))
    return _ranked(means, "score", "user_id")


def user_genre_means(ratings: DataFrame, items: DataFrame, explode: bool = False) -> DataFrame:
    """Mean rating per user and genre.

    An item's whole genre text is one genre, as ``a|b``; with ``explode`` the
    item counts for ``a`` and for ``b``.
    """
    genre = F.explode(F.split("genres", r"\|")) if explode else F.col("genres")
    means = (
        ratings.select("user_id", "item_id", "rating")
        .join(items.select("item_id", genre.alias("genre")), "item_id")
        .groupBy("user_id", "genre")
        .agg(F.avg("rating").alias("score"))
    )
    return _ranked(means, "score", "user_id", "genre")


def _known(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id", "item_id", "rating").dropna(subset=["user_id", "item_id"])


def _less_mean(rows: DataFrame, known: DataFrame, by: str, salt_rows: int) -> DataFrame:
    """``rows`` with ``centered``: the rating less the mean of its user's or item's ``known`` ones."""
    axis, other = AXES[by]
    means = known.groupBy(axis).agg(
        F.avg("rating").alias("_mean"), F.count(F.lit(1)).alias("_rows")
    )
    joined = attach(rows, means, [axis], [other], rows="_rows", salt_rows=salt_rows)
    return joined.withColumn("centered", F.coalesce(F.col("rating") - F.col("_mean"), F.lit(0.0)))


def center(ratings: DataFrame, by: str, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Ratings less the mean of their user (``by="user"``) or item; a null rating is 0."""
    known = _known(ratings)
    return _less_mean(known, known, by, salt_rows).select("user_id", "item_id", "centered")


def _similarity(ratings: DataFrame, by: str, target) -> DataFrame:
    axis, other = AXES[by]
    wanted = typed(ratings, axis, target)
    own = ratings.where(F.col(axis) == wanted).dropna(subset=[other])
    mean = own.agg(F.avg("rating")).scalar()
    mine = own.select(other, F.coalesce(F.col("rating") - mean, F.lit(0.0)).alias("_mine"))
    # a target that rated something twice meets each of its rows twice
    target_norm = (
        mine.groupBy(other)
        .agg((F.count(F.lit(1)) * F.sum(F.col("_mine") * F.col("_mine"))).alias("_square"))
        .agg(F.sqrt(F.sum("_square")).alias("_norm"))
        .scalar()
    )
    # the co-rated rows are summed before they are centred, which the sums allow: a user
    # or item then is one row in either side of the join with the means
    others = ratings.where(F.col(axis) != wanted).select(axis, other, "rating")
    rating, mean_of = F.col("rating"), F.col("_mean")
    sums = (
        others.where(rating.isNotNull())
        .join(mine, other)
        .groupBy(axis)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("rating").alias("_sum"),
            F.sum(rating * rating).alias("_square"),
            F.sum("_mine").alias("_theirs"),
            F.sum(rating * F.col("_mine")).alias("_product"),
        )
    )
    rated = others.join(mine.select(other).distinct(), other, "left_semi").select(axis).distinct()
    means = others.where(F.col(other).isNotNull()).groupBy(axis).agg(F.avg("rating").alias("_mean"))
    square = F.col("_square") - 2 * mean_of * F.col("_sum") + F.col("_n") * mean_of * mean_of
    dot = F.col("_product") - mean_of * F.col("_theirs")
    norm = F.sqrt(F.greatest(square, F.lit(0.0)))
    value = F.when(norm > 0, dot / norm / F.when(F.lit(target_norm) != 0, F.lit(target_norm)))
    # who rated only nulls in common is listed, without a similarity
    return (
        rated.join(sums, axis, "left").join(means, axis, "left").select(axis, value.alias("similarity"))
    )


def similar(ratings: DataFrame, by: str, target) -> DataFrame:
    """Users (or items) by the cosine of their centred ratings with the target's.

    The target's norm covers all its ratings, the other side's norm only those
    which both have. A zero norm gives a null similarity; an unknown target gives
    no rows.
    """
    return _ranked(_similarity(ratings, by, target), "similarity", AXES[by][0])


def recommend_user_based(
    ratings: DataFrame, user, k: int = 10, salt_rows: int = SALT_ROWS
) -> DataFrame:
    """The ``k`` unseen items with the best deviation, weighted by user similarity.

    Similarities come from user-centred ratings and weigh item-centred ones. Only the
    ratings of users with something in common are centred; the means are of all.
    """
    # read for the similarities, the means, the counts and the scores
    ratings = cut_lineage(ratings.select("user_id", "item_id", "rating"))
    known, sims = _known(ratings), _similarity(ratings, "user", user)
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("_rows"))
    weighed = attach(known, sims, ["user_id"], ["item_id"], counts=per_user, salt_rows=salt_rows)
    scores = (
        _less_mean(weighed, known, "item", salt_rows)
        .groupBy("item_id")
        .agg(
            F.try_divide(
                F.sum(F.col("centered") * F.col("similarity")), F.sum(F.abs("similarity"))
            ).alias("score")
        )
    )
    seen = ratings.where(F.col("user_id") == typed(ratings, "user_id", user)).select("item_id")
    # after the aggregation an item is one row, so this join cannot be skewed
    return _ranked(scores.join(seen, "item_id", "left_anti"), "score", "item_id").limit(k)


def recommend_item_based(ratings: DataFrame, user, k: int = 10) -> DataFrame:
    """The ``k`` unseen items with the best mean of the user's centred ratings,
    weighted by full-norm cosine similarity of the items.

    Seen items are left out before the items are paired, so the user's own rows
    meet nothing. The unseen item's norm divides both sums of its score and
    cancels; only the seen items' norms are computed.
    """
    is_user = F.col("user_id") == typed(ratings, "user_id", user)
    # not made distinct: the semi and anti joins need not, and AQE can split a hot
    # item only where both sides come straight from a shuffle
    seen = ratings.where(is_user).select("item_id")
    seen_ratings = center(ratings.join(seen, "item_id", "left_semi"), "item")
    unseen_ratings = center(ratings.join(seen, "item_id", "left_anti"), "item")

    norms = seen_ratings.groupBy("item_id").agg(
        F.sqrt(F.sum(F.col("centered") * F.col("centered"))).alias("_norm")
    )
    mine = (
        seen_ratings.where(is_user)
        .select("item_id", F.col("centered").alias("_mine"))
        .join(norms, "item_id")
    )
    raters = seen_ratings.where(~is_user).select(
        "user_id", F.col("item_id").alias("_seen"), F.col("centered").alias("_x")
    )
    dots = (
        raters.join(unseen_ratings, "user_id")
        .groupBy("_seen", "item_id")
        .agg(F.sum(F.col("_x") * F.col("centered")).alias("_dot"))
    )
    weight = F.try_divide("_dot", "_norm")
    scores = (
        dots.join(mine.withColumnRenamed("item_id", "_seen"), "_seen")
        .groupBy("item_id")
        .agg(
            F.try_divide(F.sum(weight * F.col("_mine")), F.sum(F.abs(weight))).alias("score")
        )
    )
    return _ranked(scores, "score", "item_id").limit(k)
