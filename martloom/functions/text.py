"""Text conforming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a raw file uses for "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Borough spellings that mean the same borough.
BOROUGH_SYNONYMS = {
    "RICHMOND / STATEN ISLAND": "STATEN ISLAND",
    "RICHMOND": "STATEN ISLAND",
    "STATEN ISLAND": "STATEN ISLAND",
}

# Indicator spellings and their codes.
FLAG_CODES = {"TRUE": "1", "FALSE": "0", "Y": "1", "N": "0"}

# Everything Unicode counts as whitespace, not only the blank that a plain trim removes.
WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def null_tokens_to_null(col: Column) -> Column:
    """Exact matches of a null token become NULL; nothing is trimmed first."""
    return F.when(~col.isin(*NULL_TOKENS), col)


def null_tokens_in(column: str) -> Column:
    """The same for a column by name. One SQL text is far fewer driver calls than a literal each,
    which counts on wide raw tables."""
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return F.expr(f"CASE WHEN `{column}` NOT IN ({tokens}) THEN `{column}` END")


def conform_text(col: Column) -> Column:
    return F.upper(F.trim(col.cast("string"), F.lit(WHITESPACE)))


def conform_values(col: Column, synonyms: dict[str, str]) -> Column:
    """Conformed text with each synonym replaced by its canonical value."""
    text = conform_text(col)
    by_target: dict[str, list[str]] = {}
    for spelling, target in synonyms.items():
        if spelling != target:
            by_target.setdefault(target, []).append(spelling)
    if not by_target:
        return text
    out = None
    for target, spellings in by_target.items():
        hit = text.isin(*spellings)
        out = F.when(hit, F.lit(target)) if out is None else out.when(hit, F.lit(target))
    return out.otherwise(text)


def conform_borough(col: Column) -> Column:
    return conform_values(col, BOROUGH_SYNONYMS)


def recode_flag(col: Column) -> Column:
    """Yes/no spellings to "1"/"0"; any other text passes through conformed."""
    return conform_values(col, FLAG_CODES)
