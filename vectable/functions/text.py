"""String column functions (F1-F9, P4). All are built-in expressions, so they
stay inside whole-stage codegen and can be pushed down by Catalyst."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: image suffixes, tested on the
# lower-cased name without a dot.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def path_part(path: str | Column, from_end: int) -> Column:
    """Element ``from_end`` (negative, 1-based from the end) of ``path`` split on '/';
    NULL when the path is too short (``try_element_at`` never raises)."""
    return F.try_element_at(F.split(_c(path), "/"), F.lit(from_end))


def parent_dir(path: str | Column) -> Column:
    """name of the file's parent directory."""
    return path_part(path, -2)


def label_from_path(path: str | Column) -> Column:
    """F1 + F2: class label = parent directory with '.' replaced by '_'."""
    return F.replace(parent_dir(path), F.lit("."), F.lit("_"))


def split_from_path(path: str | Column) -> Column:
    """Dataset split = the grand-parent directory of the file."""
    return path_part(path, -3)


def capitalize(x: str | Column) -> Column:
    """first character upper-case, the rest lower-case (not ``initcap``)."""
    c = _c(x)
    return F.concat(F.upper(F.substr(c, F.lit(1), F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def display_label(x: str | Column) -> Column:
    """'_' -> ' ', then capitalize."""
    return capitalize(F.replace(_c(x), F.lit("_"), F.lit(" ")))


def label_slug(x: str | Column) -> Column:
    """lower-case, ' ' -> '_' (the folder name of a display class)."""
    return F.replace(F.lower(_c(x)), F.lit(" "), F.lit("_"))


def has_suffix(path: str | Column, suffixes: Iterable[str] = IMAGE_SUFFIXES) -> Column:
    """Case-insensitive suffix test; ``suffixes`` carry no leading dot."""
    low = F.lower(_c(path))
    cond = None
    for s in suffixes:
        term = low.endswith(s.lower())
        cond = term if cond is None else (cond | term)
    return cond if cond is not None else F.lit(False)


def fixed(x: str | Column, digits: int) -> Column:
    """``f"{x:.{digits}f}"`` exactly as Python writes it: rounded half-even on
    the exact binary value. ``format_number`` (Java's DecimalFormat) rounds
    that way; ``format_string('%.2f')`` does not (it rounds the shortest
    decimal form half-up, so 0.145 would give "0.15" instead of "0.14").
    The grouping commas ``format_number`` adds are removed."""
    return F.replace(F.format_number(_c(x).cast("double"), digits), F.lit(","), F.lit(""))


def percent_text(x: str | Column) -> Column:
    """``f"{x*100:.2f}%"``; the argument is cast to double first."""
    return F.concat(fixed(_c(x).cast("double") * F.lit(100.0), 2), F.lit("%"))


def fixed4(x: str | Column) -> Column:
    """``f"{x:.4f}"``."""
    return fixed(x, 4)


def data_uri_encode(content: str | Column, mime: str = "image/png") -> Column:
    """bytes -> ``data:<mime>;base64,<payload>`` without line breaks."""
    payload = F.regexp_replace(F.base64(_c(content)), r"[\r\n]", "")
    return F.concat(F.lit(f"data:{mime};base64,"), payload)


def data_uri_payload(uri: str | Column) -> Column:
    """F8: the bytes carried after the first ',' of a data URI."""
    return F.unbase64(F.split_part(_c(uri), F.lit(","), F.lit(2)))
