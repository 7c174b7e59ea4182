"""Fallback labels for lookups that find no catalogue entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens.schemas import COUNTRY_SUFFIX, GENERAL_PLAN


def plan_label(name) -> Column:
    """A plan id without a catalogue name (or with a null one) is reported
    as ``General Plan``."""
    return F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit(GENERAL_PLAN))


def country_label(country, code) -> Column:
    """A location code without a country is reported as ``<code> country``.
    A null code stays null (``concat`` propagates null) -> rejects."""
    country = F.col(country) if isinstance(country, str) else country
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(country, F.concat(code, F.lit(COUNTRY_SUFFIX)))
