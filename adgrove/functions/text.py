"""Word filters, token lines and label choice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: words of at least two characters, all in the common CJK range.
CJK_WORD = "^[\\u4e00-\\u9fa5]{2,}$"


def token_words(line: Column) -> Column:
    """Words of space-separated ``word,weight`` tokens; tokens without exactly one comma are dropped."""
    pieces = F.transform(F.split(line, " "), lambda t: F.split(t, ","))
    return F.transform(F.filter(pieces, lambda p: F.size(p) == 2), lambda p: F.get(p, F.lit(0)))


def unusable_label(label: Column) -> Column:
    """Labels that say nothing: empty, "0" or ending in "00"."""
    return (label == "") | (label == "0") | label.endswith("00")


def choose_label(labels: Column, level: int) -> Column:
    """Label of ``level`` (0-based), else its parent's, else NULL."""
    own, parent = F.get(labels, F.lit(level)), F.get(labels, F.lit(level - 1))
    return F.when(~unusable_label(own), own).when(~unusable_label(parent), parent)


def training_line(text: Column, label: Column) -> Column:
    return F.concat(text, F.lit(" __label__"), label)


def category_level_one(category: Column, whole: bool = True) -> Column:
    """First-level industry id of a CRM category id; ``whole=False`` keeps the fraction of the plain division."""
    base = category - F.lit(CATEGORY_OFFSET)
    up = F.floor(base / 100) if whole else base / 100
    return F.when(base < 100, base).otherwise(up)


def category_level_two(category: Column) -> Column:
    return category - F.lit(CATEGORY_OFFSET)


# Fixed value: base of the CRM category numbering.
CATEGORY_OFFSET = 21474836480
