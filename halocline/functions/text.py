"""Free-text attributes: history dates, forcing flags and references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from halocline.functions.flow import ColumnOrName, as_col


def history_date(history: ColumnOrName) -> Column:
    """First date of a history text as ISO text: Y/M/D, D/M/Y or D/M/YY, with its time of day if there is one."""
    h = as_col(history)
    part = lambda pattern, i: F.regexp_extract(h, pattern, i)
    ymd, dmy = r"\b(\d{4})[/-](\d{1,2})[/-](\d{1,2})\b", r"\b(\d{1,2})[/-](\d{1,2})[/-](\d{4}|\d{2})\b"
    clock = F.regexp_extract(h, r"\b(\d{1,2}:\d{2}(?::\d{2})?)\b", 1)
    two = lambda c: F.lpad(c, 2, "0")
    year = F.when(F.length(part(dmy, 3)) == 2, F.concat(F.lit("20"), part(dmy, 3))).otherwise(part(dmy, 3))
    day = F.when(h.rlike(ymd), F.concat_ws("-", part(ymd, 1), two(part(ymd, 2)), two(part(ymd, 3)))).when(h.rlike(dmy), F.concat_ws("-", year, two(part(dmy, 2)), two(part(dmy, 1))))
    full = F.when(F.length(clock) > 0, F.concat(F.lpad(F.substring_index(clock, ":", 1), 2, "0"), F.substring(clock, F.instr(clock, ":"), F.lit(6)))).otherwise(F.lit("00:00"))
    return F.when(day.isNotNull(), F.concat(day, F.lit("T"), F.when(F.length(full) == 5, F.concat(full, F.lit(":00"))).otherwise(full)))


def forcing_sentence(flags: ColumnOrName) -> Column:
    """``name = T`` / ``name = F`` lines as a sentence of what is included and excluded."""
    lines = F.filter(F.split(as_col(flags), r"\r?\n"), lambda x: x.rlike(r"=\s*[TF]\b"))
    name = lambda x: F.trim(F.substring_index(x, "=", 1))
    on = F.transform(F.filter(lines, lambda x: x.rlike(r"=\s*T\b")), name)
    off = F.transform(F.filter(lines, lambda x: x.rlike(r"=\s*F\b")), name)
    say = lambda label, x: F.when(F.size(x) > 0, F.concat(F.lit(label), F.array_join(x, ", ")))
    return F.nullif(F.concat_ws("; ", say("included: ", on), say("excluded: ", off)), F.lit(""))


def reference(authors: ColumnOrName, year: ColumnOrName, title: ColumnOrName, container: ColumnOrName, doi: ColumnOrName) -> Column:
    """A bibliography entry; what is missing is left out."""
    dot = lambda c: F.when(as_col(c).isNotNull(), F.concat(as_col(c), F.lit(".")))
    return F.concat_ws(" ", as_col(authors), F.when(as_col(year).isNotNull(), F.concat(F.lit("("), as_col(year), F.lit(")."))), dot(title), dot(container), F.when(as_col(doi).isNotNull(), F.concat(F.lit("https://doi.org/"), as_col(doi))))


def citation(authors: ColumnOrName, year: ColumnOrName) -> Column:
    """(First author et al., year) or (Author, year)."""
    names = F.split(as_col(authors), r";\s*")
    first = F.substring_index(F.get(names, F.lit(0)), ",", 1)
    return F.concat(F.lit("("), first, F.when(F.size(names) > 1, F.lit(" et al.")).otherwise(F.lit("")), F.lit(", "), as_col(year), F.lit(")"))


def time_units(units: ColumnOrName) -> Column:
    """struct(unit, origin) of CF units like ``seconds since 1970-01-01 00:00:00``."""
    pattern = r"^\s*(\w+)\s+since\s+(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}:\d{2}))?"
    u = as_col(units)
    part = lambda i: F.regexp_extract(u, pattern, i)
    origin = F.concat(part(2), F.lit(" "), F.when(part(3) == "", "00:00:00").otherwise(part(3)))
    return F.when(u.rlike(pattern), F.struct(F.lower(part(1)).alias("unit"), origin.cast("timestamp").alias("origin")))


def decode_time(value: ColumnOrName, units: ColumnOrName) -> Column:
    """A number in CF units as a timestamp; null for units other than days, hours, minutes and seconds."""
    u = time_units(units)
    factor = F.when(u["unit"].startswith("day"), 86400).when(u["unit"].startswith("hour"), 3600).when(u["unit"].startswith("min"), 60).when(u["unit"].startswith("sec"), 1)
    return F.timestamp_micros(F.unix_micros(u["origin"]) + F.round(as_col(value) * factor * 1_000_000).cast("long"))
