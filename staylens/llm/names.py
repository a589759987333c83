"""Column names that Spark reads as paths, such as ``a.b``, around operators that keep all columns."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame


def any_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """operator on a table whose names of other than word characters are replaced meanwhile; a table without such is passed as it is."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **settings) -> DataFrame:
        taken, meanwhile = {c.lower() for c in docs.columns}, {}
        for c in docs.columns:
            if not re.fullmatch(r"\w+", c):
                name = f"other_column_{len(meanwhile)}"
                while name in taken:
                    name += "_"
                taken.add(name)
                meanwhile[c] = name
        if not meanwhile:
            return operator(docs, *args, **settings)
        out = operator(docs.toDF(*[meanwhile.get(c, c) for c in docs.columns]), *args, **settings)
        back = {name: c for c, name in meanwhile.items()}
        return out.toDF(*[back.get(c, c) for c in out.columns])

    return run
