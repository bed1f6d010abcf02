"""Filling ``{name}`` templates with Columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def fill(template: str, **values: Column) -> Column:
    """The template with each ``{name}`` replaced by a Column; names that are
    not given stay as text."""
    pieces = re.split(r"\{(" + "|".join(map(re.escape, values)) + r")\}", template) if values else [template]
    cols = [values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p]
    return F.concat(*cols)
