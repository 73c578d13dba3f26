"""Fields of a line as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_each(line: Column, marks: str = " \\t") -> Column:
    """Fields between single marks; an empty field is one."""
    return F.split(line, f"[{marks}]")


def split_runs(line: Column, marks: str = " \\t") -> Column:
    """Fields between runs of marks; there are no empty ones."""
    return F.filter(F.split(line, f"[{marks}]+"), lambda f: f != "")


def split_csv(line: Column) -> Column:
    """Fields between commas; one in double quotes may hold commas, and two quotes for one; blanks before a field are none."""
    fields = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'[ \t]*("(?:[^"]|"")*"[^,]*|[^,]*),'), 1)
    bare = lambda f: F.replace(F.regexp_extract(f, r'^"((?:[^"]|"")*)"', 1), F.lit('""'), F.lit('"'))
    return F.transform(fields, lambda f: F.when(F.startswith(f, F.lit('"')), bare(f)).otherwise(f))
