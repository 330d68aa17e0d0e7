"""Text of an HTML page with built-in expressions (D1 for web pages).

Scripts, styles and comments are removed, tags become spaces, a few
entities are decoded and whitespace is collapsed.  The patterns mean the
same in Java regex and RE2, so the SQL oracle runs the same chain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The removal patterns, in order, and the entity table.
STRIP_PATTERNS = [
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?s)<!--.*?-->",
    r"<[^>]*>",
]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def html_text(html: Column) -> Column:
    t = F.coalesce(html, F.lit(""))
    for i, rx in enumerate(STRIP_PATTERNS):
        t = F.regexp_replace(t, rx, "" if i < 3 else " ")
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    t = F.regexp_replace(t, r"[ \t\r\n\f]+", " ")
    return F.btrim(t, F.lit(" "))
