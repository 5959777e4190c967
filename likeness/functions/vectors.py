"""Column expressions over feature vectors.

Everything here stays on the JVM. Sums run in double precision. Each norm is
bound once per row through the finishing step of ``aggregate``; writing the norm
inside ``transform`` would evaluate it again for every element.
"""

from pyspark.sql import Column, functions as F

INF = float("inf")

HS_DIM = 144   # fixed value: 12 x 12 hue/saturation bins
HSV_DIM = 176  # fixed value: hue/saturation bins plus 32 brightness bins
HOG_DIM = 1764  # fixed value: 7 x 7 blocks, 4 cells, 9 orientations


def doubles(vector: Column, one: bool = False) -> Column:
    """A vector in double precision, or, inside a lambda, ``one`` of its values: a long vector cast
    as a whole is first held as that many objects."""
    return vector.cast("double" if one else "array<double>")


def squared_norm(vector: Column) -> Column:
    return F.aggregate(doubles(vector), F.lit(0.0), lambda acc, x: acc + x * x)


def norm(vector: Column) -> Column:
    return F.sqrt(squared_norm(vector))


def is_usable(vector: Column) -> Column:
    """Neither NULL, empty, zero nor holding NaN or infinity.

    Spark orders NaN above infinity, so one upper bound rejects both.
    """
    n = norm(vector)
    return F.coalesce((n > 0) & (n < F.lit(INF)), F.lit(False))


def unit_or_null(vector: Column) -> Column:
    """Unit length, or NULL where no direction exists."""
    v = doubles(vector)
    return F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x * x,
        lambda acc: F.when((acc > 0) & (acc < F.lit(INF)),
                           F.transform(v, lambda x: x / F.sqrt(acc))),
    )


def unit_or_same(vector: Column) -> Column:
    """Unit length where the norm is positive; zero vectors are kept."""
    v = doubles(vector)
    return F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x * x,
        lambda acc: F.when(acc > 0, F.transform(v, lambda x: x / F.sqrt(acc))).otherwise(v),
    )


def unit_query(vector: Column, least: float = 1e-12) -> Column:
    """Unit length for a query; NULL below ``least`` or when not finite."""
    v = doubles(vector)
    return F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x * x,
        lambda acc: F.when((F.sqrt(acc) >= least) & (acc < F.lit(INF)),
                           F.transform(v, lambda x: x / F.sqrt(acc))),
    )


def dot(left: Column, right: Column) -> Column:
    """Inner product; NULL when a side is missing or the lengths differ."""
    products = F.zip_with(doubles(left), doubles(right), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def safe_cosine(left: Column, right: Column) -> Column:
    """Dot product of two unit vectors, 0 when either is missing."""
    return F.coalesce(dot(left, right), F.lit(0.0))


def pad_legacy(vector: Column, old: int = HS_DIM, full: int = HSV_DIM) -> Column:
    """Bring an old hue/saturation vector to full length; other lengths give NULL."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), full - old)
    return (F.when(F.size(vector) == full, vector)
            .when(F.size(vector) == old, F.concat(vector, zeros)))


def score_from_distance(distance: Column) -> Column:
    return F.lit(1.0) - distance


def storage_cast(vector: Column) -> Column:
    return vector.cast("array<float>")


def min_max(value: Column, lowest: Column, highest: Column, any_nan: Column) -> Column:
    """Rescale to [0, 1]; constant or non-finite ranges give 0."""
    span = highest - lowest
    bad = any_nan | F.isnan(span) | (F.abs(span) == F.lit(INF)) | (span < 1e-12)
    return F.when(F.coalesce(bad, F.lit(True)), F.lit(0.0)).otherwise((value - lowest) / span)


def weighted_mean(scores: dict, weights: dict) -> Column:
    """Weighted mix of named score columns; names without a weight count 0 and
    weights for unknown names are ignored."""
    used = {name: float(weights.get(name, 0.0)) for name in scores}
    total = max(1e-8, sum(used.values()))
    mixed = F.lit(0.0)
    for name, column in scores.items():
        mixed = mixed + F.lit(used[name]) * column
    return mixed / F.lit(total)
