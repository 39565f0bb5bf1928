"""Field extraction from HTML text, as built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def element_pattern(tag: str, element_id: str | None = None, css_class: str | None = None) -> str:
    """Pattern whose first group is the inner text of an element."""
    attributes = "[^>]*"
    if element_id is not None:
        attributes = f'[^>]*\\bid="{re.escape(element_id)}"[^>]*'
    elif css_class is not None:
        attributes = f'[^>]*\\bclass="{re.escape(css_class)}"[^>]*'
    return f"(?s)<{tag}{attributes}>(.*?)</{tag}>"


def element_text(html: Column, tag: str, element_id: str | None = None) -> Column:
    """Trimmed text of the first such element; NULL when there is none."""
    found = F.regexp_extract(html, element_pattern(tag, element_id), 1)
    return F.nullif(F.trim(found), F.lit(""))


def number_of(text: Column, default: float) -> Column:
    """First number of a text, without currency signs; ``default`` if absent."""
    digits = F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?)", 1)
    return F.coalesce(digits.try_cast("double"), F.lit(default))


def visible_text(html: Column) -> Column:
    """Page text without scripts, styles, comments and tags."""
    no_code = F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    return F.regexp_replace(no_code, r"<[^>]*>", " ")


def repeated_items(df: DataFrame, html: str, pattern: str, names: list[str], keys: list[str]) -> DataFrame:
    """One row per match of ``pattern``, one column per group; a page without any keeps one row, its item NULL."""
    groups = [F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(i + 1)).alias(n)
              for i, n in enumerate(names)]
    zipped = df.select(*keys, *groups).select(*keys, F.posexplode_outer(F.arrays_zip(*names)).alias("item_no", "_item"))
    return zipped.select(*keys, "item_no", *[F.col(f"_item.{n}").alias(n) for n in names])
