"""String building blocks with Python's notion of whitespace and slicing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() treat as
# whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set: Unicode's White_Space property and four separators beside it.
# The property test is several times faster than a list of characters.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Literal LaTeX replacements, applied in this order.
LATEX_REPLACEMENTS = (
    ("\\emph{", ""),
    ("\\textbf{", ""),
    ("\\textit{", ""),
    ("\\cite{", "["),
    ("\\ref{", "["),
    ("}", ""),
    ("\\$", ""),
    ("$$", ""),
)
LATEX_COMMAND = r"\\[a-zA-Z]+"

PREVIEW_CHARS = 100


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    An expression repeated inside a lambda is computed on every call; a lambda
    variable is not.
    """
    return F.transform(F.array(value), body)[0]


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def squeeze(col: Column) -> Column:
    """Every whitespace run becomes one space; none at either end."""
    return F.btrim(F.regexp_replace(col, WHITESPACE_RUN, " "), F.lit(" "))


def words(col: Column) -> Column:
    """Whitespace-separated words; an all-blank text has none."""
    return F.array_remove(F.split(squeeze(col), " "), "")


def cap(col: Column, limit: int) -> Column:
    """Cut to ``limit`` code points, marking the cut with an ellipsis."""
    return bind(
        col,
        lambda x: F.when(
            F.length(x) > limit, F.concat(F.left(x, F.lit(limit)), F.lit("..."))
        ).otherwise(x),
    )


def non_empty(col: Column) -> Column:
    """NULL instead of an empty string, so that coalesce() falls through."""
    return F.nullif(col, F.lit(""))


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*(non_empty(c) for c in cols))


def join_present(items: Column, separator: str = ", ") -> Column:
    """Join the non-null, non-empty items; NULL if nothing is left."""
    kept = F.filter(items, lambda x: x.isNotNull() & (x != ""))
    return non_empty(F.array_join(kept, separator))


def clean_latex(col: Column) -> Column:
    cleaned = F.coalesce(col, F.lit(""))
    for old, new in LATEX_REPLACEMENTS:
        cleaned = F.replace(cleaned, F.lit(old), F.lit(new))
    return squeeze(F.regexp_replace(cleaned, LATEX_COMMAND, " "))


def preview(col: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.translate(F.left(col, F.lit(chars)), "\n", " ")


def padded(number: Column, width: int) -> Column:
    return F.format_string(f"%0{width}d", number.cast("long"))
