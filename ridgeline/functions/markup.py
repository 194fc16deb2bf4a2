"""Inline markup of titles."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TAG = re.compile(r"</?[A-Za-z][\w:.-]*(?:\s[^<>]*)?/?>")
#: Elements that stand inside a word; all others part words.
_TIGHT = frozenset("sub sup i b em strong italic bold sc small".split())


def strip(text: str | None) -> str | None:
    """Without tags; a tag between two words parts them unless it is one that stands inside words."""
    if text is None:
        return None
    out, at = [], 0
    for m in _TAG.finditer(text):
        out.append(text[at : m.start()])
        at = m.end()
        name = re.sub(r"^</?(?:[\w.-]+:)?", "", m[0]).rstrip("/> ").split()[0].lower() if m[0] else ""
        if name not in _TIGHT:
            out.append(" ")
    return re.sub(r"\s+", " ", "".join([*out, text[at:]])).strip()


def without_markup(text: Column) -> Column:
    """Sequential scan, so an Arrow-batched function."""

    def clean(s: pd.Series) -> pd.Series:
        return s.map(strip, na_action="ignore")

    return F.pandas_udf(clean, "string")(text)
