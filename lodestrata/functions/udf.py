"""Arrow UDFs that are built when first used (a DDL type needs a session)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(kind: str) -> Callable[[Callable], Callable[..., Column]]:
    """Like ``pandas_udf(kind)``, but usable at import time."""

    def wrap(fn: Callable) -> Callable[..., Column]:
        built = []

        @functools.wraps(fn)
        def call(*columns: Column | str) -> Column:
            if not built:
                built.append(F.pandas_udf(kind)(fn))
            return built[0](*columns)

        return call

    return wrap
