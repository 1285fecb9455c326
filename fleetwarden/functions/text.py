"""Text expressions: interchange escapes, definition clean-up, markup, exclusion filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The escape that stands for NULL in a bulk-load file and the word that a
# command-line client prints for it.
FILE_NULL = "\\N"
CLIENT_NULL = "NULL"
# Stands for whatever in a pattern is not plain text.
_GAP = "\x01"


def sql_string(text: str) -> str:
    """``text`` as a Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def decode_field(raw: Column, escapes: bool = True) -> Column:
    """One bulk-load field: ``\\N`` is NULL and ``\\t``, ``\\n``, ``\\r``, ``\\0``, ``\\\\`` are decoded.

    The field is cut at each doubled backslash first, so that ``\\\\n`` stays a backslash and an n.
    ``escapes=False`` leaves the text as it is, the file's NULL mark included.
    """
    if not escapes:
        return raw
    pieces = F.transform(
        F.split(raw, r"\\\\"),
        lambda p: reduce(
            lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])),
            [("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\0", "\0")],
            p,
        ),
    )
    return F.when(raw != FILE_NULL, F.array_join(pieces, "\\"))


def client_null(c: Column) -> Column:
    """The four spellings of NULL in client output (NULL, the word, ``\\N``, empty) become one."""
    return F.when(~c.isin(CLIENT_NULL, FILE_NULL, ""), c)


def strip_counter(definition: Column) -> Column:
    """Drop the first `` AUTO_INCREMENT=n``, so that a moving counter is not a change."""
    return F.regexp_replace(definition, r"(?s)^(.*?) AUTO_INCREMENT=[0-9]*\b", "$1")


def comment_markup(column_name: Column, comments: Column) -> Column:
    """A dictionary line as a paragraph: ``column - comment``, ``N/A`` where there is none."""
    body = F.concat(
        F.coalesce(F.concat(column_name, F.lit(" - ")), F.lit("")), F.coalesce(comments, F.lit("N/A"))
    )
    body = F.replace(body, F.lit("\n"), F.lit("<br>"))
    body = F.translate(body, "\r|", "")
    body = F.replace(body, F.lit("'"), F.lit("&#39;"))
    return F.concat(F.lit("<p>"), body, F.lit("</p>"))


def contains_any(line: Column, patterns: Sequence[str]) -> Column:
    """True where ``line`` holds any of the fixed strings, case-sensitively.

    The strings are tried one by one. A list that is long, or that lies in a table, is better
    matched by :func:`fleetwarden.operators.health.log_exclude_table`, with the same result.
    """
    unique = sorted(set(patterns))
    if "" in unique:
        raise ValueError("an empty pattern would match every line")
    if not unique:
        return F.lit(False)
    return F.exists(F.lit(unique), lambda p: F.contains(line, p))


def required_literals(pattern: Column) -> Column:
    """Lower-case ASCII strings of which every match of a JVM pattern, in any case, holds at least one.

    One string for each top-level alternative, its longest run of plain characters. NULL where an alternative has
    none, or where the pattern has what this does not read (inline flags, quoting, coded characters,
    classes in classes): such a pattern has to be tried on every text.
    """
    unread = r"\(\?|\\[QExuUcNk0]"
    # Everything that is not plain becomes a gap. Escapes go first, so that no bracket or bar that is
    # left is one that stands for itself.
    left = F.regexp_replace(pattern, r"\\[pP]\{[^}]*\}|\\[0-9]+|(?s)\\.", _GAP)
    left = F.regexp_replace(left, r"\[[^\[\]]*\]", _GAP)
    for _ in range(4):  # groups, from the inside
        left = F.regexp_replace(left, r"\([^()]*\)", _GAP)
    # A character that may be absent goes with its quantifier; one that may be repeated stays.
    left = F.regexp_replace(left, r"(?s).(?:[*?]|\{[^}]*\})[+?]?", _GAP)
    left = F.regexp_replace(left, r"\+[+?]?|[^ -~]|[.^$]", _GAP)
    runs = F.transform(
        F.split(left, r"\|"),
        lambda a: F.array_max(F.transform(F.split(a, _GAP), lambda r: F.struct(F.length(r).alias("n"), F.lower(r).alias("run")))),
    )
    runs = F.array_distinct(F.transform(runs, lambda r: r["run"]))
    read = ~pattern.rlike(unread) & ~left.rlike(r"[\[\](){}\\]") & ~F.array_contains(runs, "")
    return F.when(read, runs)


def record_value(record: Column, key: str) -> Column:
    """Value of a ``Key: value`` line in a multi-line record; NULL where it is absent or NULL."""
    line = rf"(?m)^[ \t]*{key}:[ \t]*([^\n]*?)[ \t]*$"
    return client_null(F.regexp_extract(record, line, 1))


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def js_row(*cells: Column) -> Column:
    """A script array row: text cells quoted, numbers bare, NULL as ``null``, e.g. ``["a",3],``."""
    shown = [F.coalesce(c.cast("string"), F.lit("null")) for c in cells]
    return F.concat(F.lit("["), F.concat_ws(",", *shown), F.lit("],"))


def js_text(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def html_row(*cells: Column) -> Column:
    """One table row; NULL cells are printed as the word NULL, and markup characters escaped."""
    def cell(c: Column) -> Column:
        text = F.coalesce(c.cast("string"), F.lit(CLIENT_NULL))
        for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(raw), F.lit(safe))
        return F.concat(F.lit("<TD>"), text, F.lit("</TD>"))

    return F.concat(F.lit("<TR>"), *[cell(c) for c in cells], F.lit("</TR>"))
