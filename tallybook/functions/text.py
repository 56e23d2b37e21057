"""Text columns: trimming, codes, title case, null tokens, Latin-1 output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts that are read as null.
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

# Typographic, box-drawing and symbol characters and their plain replacements.
PLAIN_TEXT = {
    "—": "-",
    "–": "-",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "•": "-",
    "…": "...",
    "╔": "+",
    "╗": "+",
    "╚": "+",
    "╝": "+",
    "═": "=",
    "║": "|",
    "╣": "+",
    "╠": "+",
    "╦": "+",
    "╩": "+",
    "╬": "+",
    "│": "|",
    "─": "-",
    "┌": "+",
    "┐": "+",
    "└": "+",
    "┘": "+",
    "├": "+",
    "┤": "+",
    "┬": "+",
    "┴": "+",
    "┼": "+",
    "★": "*",
    "☆": "*",
    "●": "-",
    "○": "-",
    "▶": ">",
    "◀": "<",
}

# Longest narrative kept, and the note that follows a cut one.
NARRATIVE_LIMIT = 5000
TRUNCATION_NOTE = "\n\n[...Report truncated. See full text file for complete insights.]"

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_MARK = "\x01"


def strip(col: Column) -> Column:
    """Drop white space at both ends, tabs, line ends and Unicode spaces included."""
    return F.btrim(col, F.lit(WHITESPACE))


def upper_code(col: Column) -> Column:
    """Upper-case, stripped code such as a SKU."""
    return strip(F.upper(col))


def blank_to_null(col: Column) -> Column:
    """Null for a cell whose whole text is a null token."""
    return F.when(~col.isin(*NULL_TOKENS), col)


def title_case(col: Column) -> Column:
    """Capitalise each run of letters, so ``punjab/mohali 2ND`` gives ``Punjab/Mohali 2Nd``.

    ``initcap`` restarts after spaces only. A mark and a space put after every non-letter make it
    restart there too; both go away again. A mark in the text itself is followed by one of ours,
    never directly by a space, so it survives.
    """
    spread = F.regexp_replace(col, f"([^{_CASED}])", f"$1{_MARK} ")
    everywhere = F.replace(F.initcap(spread), F.lit(f"{_MARK} "), F.lit(""))
    return F.when(col.rlike(f"[^{_CASED} ]"), everywhere).otherwise(F.initcap(col))


def sanitize(col: Column) -> Column:
    """Text safe for Latin-1 output: known symbols get plain twins, other characters ``?``."""
    single = {old: new for old, new in PLAIN_TEXT.items() if len(new) == 1}
    for old, new in PLAIN_TEXT.items():
        if len(new) > 1:
            col = F.replace(col, F.lit(old), F.lit(new))
    col = F.translate(col, "".join(single), "".join(single.values()))
    return F.regexp_replace(col, r"[^\x00-\xFF]", "?")


def truncate(col: Column, limit: int = NARRATIVE_LIMIT, note: str = TRUNCATION_NOTE) -> Column:
    """Cut text longer than ``limit`` characters and add ``note``."""
    return F.when(
        F.length(col) > limit, F.concat(F.left(col, F.lit(limit)), F.lit(note))
    ).otherwise(col)
