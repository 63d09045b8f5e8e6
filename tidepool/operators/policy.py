"""Row filters and column masks (M1, M2) as plain DataFrame transforms.

The viewer (user name and groups) is an argument, never read from the
session, so the same job can be run for any principal and tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.scalar import mask_email
from tidepool.operators.joins import join_dim


def apply_row_filter(df: DataFrame, entitlements: DataFrame, user: str, groups=(),
                     on: str = "region", user_col: str = "user", bypass_group: str = "admins") -> DataFrame:
    """Keep rows whose ``on`` value is entitled to ``user``.

    A LEFT SEMI join against the user's entitlement rows (any number of
    them: a user entitled to two regions sees both -- a scalar subquery
    would fail).  Members of ``bypass_group`` see everything.  The user's
    entitlements are size-checked before being broadcast."""
    if bypass_group in set(groups):
        return df
    mine = entitlements.filter(F.col(user_col) == F.lit(user)).select(on).distinct()
    return join_dim(df, mine, on, how="left_semi")


def apply_mask(df: DataFrame, col: str, allowed: bool) -> DataFrame:
    """Replace ``col`` by its masked form unless the viewer is allowed."""
    return df.withColumn(col, mask_email(F.col(col), allowed))


def viewer_allowed(groups, allowed_groups) -> bool:
    return bool(set(groups) & set(allowed_groups))
