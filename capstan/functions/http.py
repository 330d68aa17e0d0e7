"""Split an HTTP response message held in a binary column.

The header block is found in the whole payload, whatever its size: the binary
value is viewed as a string (no copy) and cut at the first blank line, so the
search ends where the header ends and the body is never decoded.  The block
itself is decoded as ISO-8859-1 (one byte, one character).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = " \t\r\n\f\u000b"
MAX_INT = 2**31 - 1


def strip_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WS))


def _blank_line(payload: Column) -> tuple[Column, Column]:
    """(bytes before the first blank line or -1, 1-based start of what follows).
    A blank line ends with CRLF or LF alone, whichever comes first."""
    text = payload.cast("string")
    crlf = F.substring_index(text, "\n\r\n", 1)
    lf = F.substring_index(crlf, "\n\n", 1)
    n_crlf, n_lf, n = F.octet_length(crlf), F.octet_length(lf), F.octet_length(payload)
    size = F.when(n_lf < n_crlf, n_lf).when(n_crlf < n, n_crlf).otherwise(F.lit(-1))
    start = F.when(n_lf < n_crlf, n_lf + 3).when(n_crlf < n, n_crlf + 4).otherwise(F.lit(0))
    return size, start


def split_http(payload: Column) -> Column:
    """struct<status_line, status_code, headers array<struct<name,value>>,
    header_end, body_start> for a response message.

    ``header_end`` is 0 when no blank line ends the header block (not a
    parsable response).  Header names are lower-cased; values trimmed.
    """
    size, body_start = _blank_line(payload)
    block = F.when(size >= 0, F.decode(F.substring(payload, F.lit(1), size), "ISO-8859-1"))
    lines = F.transform(F.split(block, "\n", -1), lambda x: F.rtrim(x, F.lit("\r")))
    status_line = F.element_at(lines, 1)
    field_lines = F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda x: F.instr(x, ":") > 0)
    headers = F.transform(
        field_lines,
        lambda x: F.struct(
            F.lower(strip_ws(F.substring_index(x, ":", 1))).alias("name"),
            strip_ws(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value"),
        ),
    )
    code = F.regexp_extract(status_line, r"^HTTP/\d+(?:\.\d+)? +(\d{3})", 1)
    return F.struct(
        status_line.alias("status_line"),
        (F.nullif(code, F.lit(""))).try_cast("int").alias("status_code"),
        headers.alias("headers"),
        F.greatest(size + 1, F.lit(0)).alias("header_end"),
        body_start.alias("body_start"),
    )


def header(headers: Column, name: str) -> Column:
    """First value of a header (case-insensitive name), null when absent."""
    hit = F.filter(headers, lambda h: h["name"] == F.lit(name.lower()))
    return F.try_element_at(hit, F.lit(1))["value"]


def headers_map(headers: Column) -> Column:
    """map<string,string> keeping the first value of repeated names."""
    names = F.transform(headers, lambda h: h["name"])
    first = F.filter(headers, lambda h, i: F.array_position(names, h["name"]) == i + 1)
    return F.map_from_entries(first)


def is_response(parsed: Column) -> Column:
    """A status line ``HTTP/x.y NNN``, a terminated header block and, if
    there is a Content-Length, a number in it."""
    raw = header(parsed["headers"], "content-length")
    sound = F.coalesce(raw.rlike(r"^[0-9]+$"), F.lit(True))
    return parsed["status_code"].isNotNull() & (parsed["header_end"] > 0) & sound


def declared_length(headers: Column) -> Column:
    """Content-Length as bigint; -1 when missing or not a number."""
    raw = header(headers, "content-length")
    ok = raw.rlike(r"^[0-9]+$")
    return F.coalesce(F.when(ok, raw.try_cast("bigint")), F.lit(-1).cast("bigint"))


def after_header(payload: Column, parsed: Column) -> Column:
    """Everything after the header block; null if there is none."""
    return F.when(parsed["body_start"] > 0, F.substring(payload, parsed["body_start"], F.octet_length(payload)))


def body(payload: Column, parsed: Column) -> Column:
    """Body bytes: after the header block, cut to a declared length if any."""
    rest = after_header(payload, parsed)
    n = declared_length(parsed["headers"])
    return F.when((n >= 0) & (n < F.octet_length(rest)), F.substring(rest, F.lit(1), n.cast("int"))).otherwise(rest)
