"""Identifier recognition, masking, keys and row rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes an identifier may have, each matched against the whole text.  None
# repeats a group: the regex engine recurses over repeated groups, and a long enough text would
# overflow its stack.  Look-aheads state what such groups would have ruled out.
MOBILE = r"^(17[0-9]|14[0-9]|13[0-9]|15[0-35-9]|18[0,5-9])[0-9]{8}\z"
# Local part: letters and digits with single separators between them.  Domain: labels with at
# most one inner hyphen, then two or more letters.
EMAIL = (
    r"^(?![^@]*[-|.]{2})[a-zA-Z0-9][a-zA-Z0-9|.-]*[a-zA-Z0-9]@"
    r"(?![a-zA-Z0-9.-]*(\.-|-\.|\.\.|-[a-zA-Z0-9]*-))[a-zA-Z0-9][a-zA-Z0-9.-]*\.[a-zA-Z]{2,}\z"
)
QQ = r"^[0-9]{5,12}\z"
ID_CARD = r"^([0-9]{15}|[0-9]{17}[0-9Xx])\z"
USER_NAME = r"^[a-zA-Z][a-zA-Z0-9_]{5,20}\z"
PASSWORD = r"^[a-zA-Z0-9]{6,20}\z"
# A host of two or more labels, then an optional path.
URL = (
    r"^https?://(?![a-zA-Z0-9_.-]*\.\.)[a-zA-Z0-9_-]+\.[a-zA-Z0-9_.-]*[a-zA-Z0-9_-]"
    r"(/[a-zA-Z0-9_ ./?%&=-]*)?\z"
)
IPV4 = (
    r"^(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    r"(\.(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}\z"
)
CHINESE = r"^[一-龥]+\z"

_IN_ORDER = (("phone", MOBILE), ("email", EMAIL), ("qq", QQ), ("id_card", ID_CARD))


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def identifier_type(value) -> Column:
    """``phone``, ``email``, ``qq`` or ``id_card``, tested in that order; else NULL."""
    value = _col(value)
    out = None
    for name, pattern in _IN_ORDER:
        out = (out.when if out is not None else F.when)(value.rlike(pattern), name)
    return out


def looks_like(value, pattern: str) -> Column:
    return _col(value).rlike(pattern)


def mask_value(value) -> Column:
    """Three characters, stars, three characters; NULL is empty, under six stays as it is."""
    value = _col(value)
    stars = F.repeat(F.lit("*"), F.greatest(F.length(value) - 6, F.lit(0)))
    masked = F.concat(F.substring(value, 1, 3), stars, F.substring(value, -3, 3))
    return F.when(value.isNull(), "").when(F.length(value) < 6, value).otherwise(masked)


def mask_name(value) -> Column:
    return F.concat(F.substring(_col(value), 1, 1), F.lit("**"))


def md5_key(value) -> Column:
    return F.md5(_col(value).cast("string").cast("binary"))


def portable_hash(*key, salt: int = 0) -> Column:
    """A number of 60 bits from a key and a salt, the same in every engine that has MD5."""
    digest = F.md5(F.concat_ws(":", *[_col(k).cast("string") for k in key], F.lit(str(salt))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def int_to_ip(value) -> Column:
    """32-bit number as a dotted quad, highest byte first."""
    value = _col(value).cast("bigint")
    octets = [F.shiftright(value, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def ip_to_int(text) -> Column:
    """The number behind a dotted quad."""
    parts = F.split(_col(text), r"\.")
    total = F.lit(0).cast("bigint")
    for i in range(4):
        total = total * 256 + F.get(parts, F.lit(i)).cast("bigint")
    return total


def prefixed_key(value, prefix: str = "u_") -> Column:
    return F.concat(F.lit(prefix), _col(value).cast("string"))


def row_to_line(columns: list[str], delimiter: str = "\t", missing: str = "null") -> Column:
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns]
    return F.concat_ws(delimiter, *texts)


def row_to_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns))
