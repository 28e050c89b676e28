"""Control over where columns are computed."""

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) costly columns that later filters and columns read.

    Spark copies the expression of a plain column into every filter on it, and below joins and groupings; a
    regular expression chain is then evaluated many times per row.  It does not do that with the output of a
    generator, so the columns come from one that gives exactly one row.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
