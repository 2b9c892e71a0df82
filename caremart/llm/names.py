"""Names for columns that an operator adds for a while."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` with as many underscores in front as it takes to be no column of ``df``, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
