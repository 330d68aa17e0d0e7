"""Links found in text (F11) and the outlink hand-off status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the link pattern.  Any ``scheme://``, and the schemes that need
# no ``//``; balanced parentheses inside a link are kept; trailing punctuation
# is not part of it.  The pattern means the same in Java regex and RE2.
LINK_PATTERN = (
    r"(?i)\b(?:[a-z][a-z0-9.+-]*://|(?:bitcoin|cid|file|geo|magnet|mailto|mid|news|sms|tel|urn|xmpp):)"
    r"(?:[^\s<>\"'()]|\([^\s<>\"'()]*\))*"
    r"(?:[^\s<>\"'().,;:!?\[\]{}]|\([^\s<>\"'()]*\))"
)
ZWSP = "\u200b"
WS = " \t\r\n\f\u000b"


def weblinks(text: Column) -> Column:
    """Sorted (byte order), de-duplicated links of a text."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LINK_PATTERN), 0)
    cleaned = F.transform(found, lambda u: F.replace(F.btrim(u, F.lit(WS)), F.lit(ZWSP), F.lit("")))
    return F.array_distinct(F.sort_array(cleaned))


def outlink_status(link: Column, has_credentials: bool = True) -> Column:
    """FTP links are refused; without credentials every save errors."""
    if not has_credentials:
        return F.lit("missing-auth")
    return F.when(F.startswith(link, F.lit("ftp://")), F.lit("spn2-no-ftp")).otherwise(F.lit("queued"))
