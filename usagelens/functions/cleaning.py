"""Parsing and cleaning expressions.

Two modes:

* ``strict``  — parity with the original jobs: a value they could not
  parse fails the Spark job (``raise_error``), independent of the
  session's ANSI setting.
* ``lenient`` — blank values count as zero and unparsable rows are kept
  out of the result; the matching ``*_is_bad`` predicate selects them
  for a rejects frame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens.schemas import AGE_BANDS, ID_WIDTH

STRICT = "strict"
LENIENT = "lenient"


def check_mode(mode: str) -> str:
    if mode not in (STRICT, LENIENT):
        raise ValueError(f"mode must be {STRICT!r} or {LENIENT!r}, got {mode!r}")
    return mode


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fail(message: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.coalesce(value.cast("string"), F.lit("NULL"))))


# ---------------------------------------------------------------- ids
def truncate_id(c, width: int = ID_WIDTH) -> Column:
    """``CAST(x AS VARCHAR(15))`` with the truncation the relational source
    applies.  Spark's own varchar cast does not truncate, so use substring."""
    return F.substring(_col(c).cast("string"), 1, width)


def integer_id(c, mode: str = STRICT, to: str = "int") -> Column:
    """An id as a number; null stays null.  strict: any other value fails
    the job, whatever the session's ANSI setting.  lenient: it becomes null
    (select it with ``id_is_bad``)."""
    check_mode(mode)
    v = _col(c)
    parsed = v.try_cast(to)
    if mode == LENIENT:
        return parsed
    return F.when(v.isNotNull(), F.coalesce(parsed, _fail("id is not an integer: ", v)))


def id_is_bad(c, to: str = "int") -> Column:
    return _col(c).isNotNull() & _col(c).try_cast(to).isNull()


# ---------------------------------------------------------------- volumes
def clean_volume(c, mode: str = STRICT) -> Column:
    """Text volume -> long.  Exactly one space means zero.

    strict:  anything else must parse as an integer (surrounding spaces
             allowed), else the job fails — null and empty text included.
    lenient: empty, blank or null text also means zero; an unparsable
             value becomes null (select it with ``volume_is_bad``).
    """
    check_mode(mode)
    v = _col(c)
    parsed = v.try_cast("long")
    if mode == STRICT:
        return F.when(v == " ", F.lit(0).cast("long")) \
            .otherwise(F.coalesce(parsed, _fail("volume is not an integer: ", v)))
    return F.when(v.isNull() | (F.trim(v) == ""), F.lit(0).cast("long")).otherwise(parsed)


def volume_is_bad(c) -> Column:
    """True for a non-blank volume that does not parse (lenient rejects)."""
    v = _col(c)
    return v.isNotNull() & (F.trim(v) != "") & v.try_cast("long").isNull()


# ---------------------------------------------------------------- subscriber CSV
def _fields(line: Column, quoted: bool = False) -> Column:
    if not quoted:  # literal split, like the original parser: quotes are not special
        return F.split(line, ",", -1)
    # commas before an even number of quotes are outside of any; doubled quotes are one
    parts = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    return F.transform(parts, lambda x: F.when(x.rlike(r'^\s*".*"\s*$'), F.replace(
        F.regexp_replace(x, r'^\s*"|"\s*$', ""), F.lit('""'), F.lit('"'))).otherwise(x))


def subscriber_fields(c="value", mode: str = STRICT, quoted: bool = False) -> tuple[Column, Column]:
    """(subscription_id, age) from a comma-separated line: field 0 and the
    integer in field 5.  Extra fields are ignored; no header is skipped.
    With ``quoted`` a field in double quotes may hold commas."""
    check_mode(mode)
    parts = _fields(_col(c), quoted)
    sub = F.get(parts, 0)
    age = F.get(parts, 5).try_cast("int")
    if mode == STRICT:
        age = F.when(F.size(parts) < 6, _fail("subscriber line has fewer than 6 fields: ", _col(c))) \
            .otherwise(F.coalesce(age, _fail("subscriber age is not an integer: ", F.get(parts, 5))))
    return sub, age


def subscriber_line_is_bad(c="value", quoted: bool = False) -> Column:
    parts = _fields(_col(c), quoted)
    return (F.size(parts) < 6) | F.get(parts, 5).try_cast("int").isNull() | _col(c).isNull()


# ---------------------------------------------------------------- age bands
def age_band(c="age", mode: str = STRICT) -> Column:
    """>=50, 30-49, 18-29, otherwise the youngest band.  Age 0 (and a
    missing age) fall in the youngest band, as in the original partition
    function; a negative age has no band (strict: the job fails)."""
    check_mode(mode)
    age = _col(c)
    b50, b30, b18, young = AGE_BANDS
    band = (F.when(age >= 50, F.lit(b50))
             .when(age >= 30, F.lit(b30))
             .when(age >= 18, F.lit(b18))
             .when(age.isNull() | (age >= 0), F.lit(young)))
    if mode == STRICT:
        return F.coalesce(band, _fail("negative age: ", age))
    return band


def age_is_bad(c="age") -> Column:
    return _col(c) < 0
