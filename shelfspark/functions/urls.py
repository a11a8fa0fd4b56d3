"""Organisation-code parsing of register-page URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import SiteUrls


def position_find(url: Column) -> Column:
    """1-based position of the code parameter name in the URL (0 when absent)."""
    return F.instr(url, SiteUrls.POSITION_TOKEN)


def org_code(url: Column) -> Column:
    """SUBSTRING(url, pos('orgt1=') + 6, LEN(url) - pos('orgt1')): the length overshoots,
    so this is everything after the first ``orgt1=``, later query parameters included."""
    start = F.instr(url, SiteUrls.CODE_PARAM) + len(SiteUrls.CODE_PARAM)
    return url.substr(start, F.length(url) - position_find(url))


def code_as_org_id(code: Column) -> Column:
    """A code of at most 3 characters whose first 4 characters read as 0..9999 is itself
    an organisation id. Unreadable codes give NULL instead of a cast error."""
    leading = F.left(code, F.lit(4)).try_cast("int")
    return F.when((F.length(code) <= 3) & leading.between(0, 9999), code.try_cast("int"))


def is_register_page(url: Column) -> Column:
    return url.contains(SiteUrls.REGISTER_MARKER)
