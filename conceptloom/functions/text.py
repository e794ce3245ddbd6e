"""Column functions on strings, with blanks as the data defines them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Space, tab and no-break space are blanks.
BLANKS = " \t" + chr(0xA0)


def strip_blanks(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c, F.lit(BLANKS))


def id_form(c: Column | str) -> Column:
    """An id as it compares: without surrounding blanks, in lower case."""
    return F.lower(strip_blanks(c))


def name_form(c: Column | str) -> Column:
    """A name as it compares: lower case, stripped, each run of blanks as one space."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(F.regexp_replace(c, f"[{BLANKS}]+", " ")))


def present(c: Column) -> Column:
    """Neither null nor blank (of an already stripped column)."""
    return F.coalesce(c != "", F.lit(False))


# Unicode white space as a regular expression class, the marks that end a line, and the word separator.
WHITE = r"(?U)\s+"
LINE_END = r"\r\n|[\n\r\x0B\f\x1c-\x1e\x85\x{2028}\x{2029}]"


def strip_white(c: Column | str) -> Column:
    """Strip every kind of white space, not only spaces."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def words(c: Column | str) -> Column:
    """White-space separated words, without the empty ones at the ends."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(c, WHITE), lambda w: w != "")


def lines(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.split(c, LINE_END)


def pipe_parts(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.transform(F.split(c, r"\|"), strip_white)


def normal_name(c: Column | str, ascii_only: bool = True) -> Column:
    """Lower case, stripped, then only letters, digits and spaces; without ascii_only, letters of all scripts stay."""
    keep = "[^a-z0-9 ]" if ascii_only else r"[^\p{L}\p{M}\p{N} ]"
    return F.regexp_replace(F.lower(strip_white(c)), keep, "")


def think_stripped(c: Column | str) -> Column:
    """Text without the <think> blocks of a model's reply."""
    c = F.col(c) if isinstance(c, str) else c
    return strip_white(F.regexp_replace(c, r"(?s)<think>.*?</think>", ""))


def relation_form(c: Column | str) -> Column:
    return F.replace(F.lower(strip_white(c)), F.lit(" "), F.lit("_"))


def confidence_of(c: Column | str, default: float = 0.8) -> Column:
    """A number clamped to 0..1; what is no number gives the default (NaN counts as 1)."""
    c = strip_white(c)
    number = F.when(F.lower(c).isin("nan", "+nan", "-nan"), F.lit(float("nan"))).when(
        c.rlike(r"^[+-]?(\d[\d_]*\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.replace(c, F.lit("_"), F.lit("")).try_cast("double")
    )
    return F.when(number.isNull(), F.lit(default)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def digits_clamped(c: Column | str, default: int = 2, low: int = 1, high: int = 5) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(F.regexp_replace(c, "[^0-9]", "").try_cast("int"), F.lit(default))))


def path_name(c: Column | str) -> Column:
    return F.regexp_extract(c, r"([^/]*)$", 1)


def path_suffix(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(path_name(c), r".(\.[^.]+)$", 1))


def path_stem(c: Column | str) -> Column:
    return F.regexp_replace(path_name(c), r"(?<=.)\.[^.]+$", "")
