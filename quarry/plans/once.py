"""Evaluate a costly expression once when it is both filtered on and kept."""

from pyspark.sql import functions as F


def compute_once(df, **columns):
    """Like `withColumns`, but a later filter on the new columns is not pushed below.

    Catalyst replaces a filter on a computed column by a filter on its expression,
    so the expression runs in the filter and again in the projection. It does not
    do that through a generator.
    """
    entry = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.drop(*columns).select("*", F.inline(F.array(entry)))
