"""Column-level functions built only from Spark's native expressions.

Each helper returns a ``Column`` (``once`` a frame); nothing here leaves the JVM: no use needs
Python workers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """x/y with x/0, 0/0 and NULL operands all mapped to 0.0 (never raises under ANSI)."""
    return F.coalesce(F.try_divide(col(num).cast("double"), col(den).cast("double")), F.lit(0.0))


def round_half_even(c: str | Column, digits: int) -> Column:
    """Round the way numpy/pandas do: rint(x * 10^d) / 10^d on the double value."""
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


# Blanks, tabs, line feeds, vertical tabs, form feeds, carriage returns and no-break spaces.
WHITESPACE = " \t\n\x0b\f\r\u00a0"


def strip_ws(c: str | Column) -> Column:
    """Trim every kind of leading/trailing whitespace (tabs, newlines, NBSP), not just spaces."""
    return F.btrim(col(c).cast("string"), F.lit(WHITESPACE))


def collapse_ws(c: str | Column) -> Column:
    """Split on whitespace and re-join with single spaces."""
    return strip_ws(F.regexp_replace(col(c), r"[\s\u00a0]+", " "))


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value of ``c``, which is evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(c), body), 0)


def once(df: DataFrame, c: Column, name: str) -> DataFrame:
    """``df`` with column ``c``, evaluated once per row: filters and projections that use it later
    can't be merged with its expression, as they could with a plain ``withColumn``."""
    return df.select("*", F.explode(F.array(c)).alias(name))


def blank_to_null(c: str | Column) -> Column:
    s = strip_ws(col(c))
    return F.when(s == "", F.lit(None)).otherwise(col(c))


def sanitize_header(c: str | Column, hyphen_to_underscore: bool = True) -> Column:
    """Feed header -> column name.

    Newline and space become ``_``; hyphens become ``_`` in the box-score and
    absence variant and are stripped in the DFS variant; every other character
    outside ``[a-zA-Z0-9_]`` is removed; the result is upper-cased.
    """
    s = F.regexp_replace(col(c), "\n", "_")
    if hyphen_to_underscore:
        s = F.regexp_replace(s, "-", "_")
    s = F.regexp_replace(s, " ", "_")
    s = F.regexp_replace(s, "[^a-zA-Z0-9_]", "")
    return F.upper(s)


def map_lookup(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Literal dictionary lookup; NULL when the key is absent."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), col(c))


def replace_from_map(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Exact-match replacement: mapped value when the key is in the map, else the input."""
    return F.coalesce(map_lookup(c, mapping), col(c))


def season_type(segment: str | Column) -> Column:
    """'Regular' / 'Playoffs' / NULL from the free-text season segment (first rule wins)."""
    s = col(segment)
    return (F.when(s.rlike(K.REGULAR_PATTERN), F.lit("Regular"))
            .when(s.rlike(K.PLAYOFFS_PATTERN), F.lit("Playoffs")))


def season_year(segment: str | Column) -> Column:
    """First four consecutive digits of the segment, NULL when there are none."""
    return F.nullif(F.regexp_extract(col(segment), r"(\d{4})", 1), F.lit(""))


def season_key(segment: str | Column, stype: str | Column, year: Column | None = None) -> Column:
    """'YYYY-YY' for regular seasons (1999 -> '1999-00'), 'YYYY' for playoffs, else NULL."""
    year = season_year(segment) if year is None else year
    nxt = F.lpad(((year.cast("int") + 1) % 100).cast("string"), 2, "0")
    t = col(stype)
    return (F.when((t == "Regular") & year.isNotNull(), F.concat(year, F.lit("-"), nxt))
            .when(t == "Playoffs", year))


def absence_type(reason: str | Column) -> Column:
    """DNP-CD when the trimmed, upper-cased reason is exactly COACH'S DECISION."""
    r = F.upper(strip_ws(col(reason)))
    return F.when(r == F.lit(K.COACH_DECISION), F.lit(K.ABSENCE_CD)).otherwise(F.lit(K.ABSENCE_OTHER))


def team_spelling_key(c: str | Column) -> Column:
    """Lower-case with whitespace collapsed: the key of the team spelling dictionary."""
    return F.lower(collapse_ws(col(c)))


# Date layouts accepted by ``parse_date``: (shape of the text, layout).  The shape picks the
# one layout to try, so each value costs one regex test and at most one parse.
DATE_FORMATS: Sequence[tuple[str, str]] = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}(\.\d+)?$", "yyyy-M-d H:mm:ss[.SSSSSS]"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}(\.\d+)?$", "yyyy-M-d'T'H:mm:ss[.SSSSSS]"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})?$", "M/d/yyyy H:mm[:ss]"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}$", "yyyy-M-d H:mm"),
    (r"^\d{8}$", "yyyyMMdd"),
)

# A month by name: day and year on either side, any of . , - / or blanks between, a time ignored.
NAMED_MONTH_FIRST = r"^([A-Za-z]{3})[A-Za-z]*[. ,/-]+(\d{1,2})(?:st|nd|rd|th)?[. ,/-]+(\d{4})(?: +\d{1,2}:\d{2}(?::\d{2})?)?$"
NAMED_DAY_FIRST = r"^(\d{1,2})(?:st|nd|rd|th)?[. ,/-]+([A-Za-z]{3})[A-Za-z]*[. ,/-]+(\d{4})(?: +\d{1,2}:\d{2}(?::\d{2})?)?$"


def parse_date(c: str | Column, formats: Sequence[tuple[str, str]] = DATE_FORMATS) -> Column:
    """Any accepted text layout, or an Excel serial day number (1 to 99999), -> DateType.
    NULL when nothing fits.  Timestamps/dates pass through as their date."""
    return let(strip_ws(c), lambda s: _parse_stripped(s, formats))


def _parse_stripped(s: Column, formats: Sequence[tuple[str, str]]) -> Column:
    out = None
    for shape, fmt in formats:
        attempt = F.to_date(F.try_to_timestamp(s, F.lit(fmt)))
        out = F.when(s.rlike(shape), attempt) if out is None else out.when(s.rlike(shape), attempt)
    for shape, day, mon in ((NAMED_MONTH_FIRST, 2, 1), (NAMED_DAY_FIRST, 1, 2)):
        part = lambda i: F.regexp_extract(s, shape, i)  # noqa: B023, E731
        text = F.concat(part(3), F.lit("-"), F.initcap(part(mon)), F.lit("-"), part(day))
        out = out.when(s.rlike(shape), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MMM-d"))))
    serial = s.try_cast("double")
    excel = F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int"))
    out = out.when(s.rlike(r"^\d{1,5}(\.\d+)?$") & (serial >= 1), excel)
    return out
