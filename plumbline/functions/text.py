"""Text column expressions with Unicode-aware trimming and splitting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and word characters, written so that the same
# class means the same set in every regular-expression dialect used here.
SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s\p{Z}\x0b\x1c-\x1f\x85]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words(stripped: Column) -> Column:
    """Words of already stripped text."""
    return F.split(stripped, f"{SPACE}+")


def title_case(text: Column) -> Column:
    """Upper-case each letter that does not follow a letter (``O'Brien``)."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(parts, _capitalize), "")


def _capitalize(part: Column) -> Column:
    return F.concat(F.upper(F.substring(part, 1, 1)), F.substring(part, F.lit(2), F.length(part)))


def snake_case(name: str) -> str:
    """Header text to a snake_case column name."""
    return re.sub(r"[^a-z0-9]+", "_", str(name).strip().lower()).strip("_")
