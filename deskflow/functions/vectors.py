"""Vector arithmetic on array<float> columns, summed in double precision."""

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    """Unit vector in double precision; the zero vector stays as it is."""
    length = norm(a)
    return F.transform(a, lambda x: F.coalesce(F.try_divide(x.cast("double"), length), x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of the angle, 0 when a vector is zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
