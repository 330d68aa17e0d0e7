"""Content type from leading bytes (F12) and by file extension.

Signatures form a tree: a type is named by bytes at an offset, and the types
inside a container format (zip, OLE, RIFF, ISO media, EBML, Ogg) by a closer
look at its head, taken only where the container's own signature matches.  The
common types are a few comparisons; only binary contents are looked up in the
tree.  Markup is looked for after any leading white
space.  Text detection checks UTF-8 validity of the whole value; other bytes are
text in a one-byte character set if at least half are ASCII and none is a
control character.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Sign(NamedTuple):
    """A type and what names it: bytes (hex) at offsets, all of which must be
    there, or one of ``holds`` (hex) somewhere in the head; ``inside``: types
    within it, looked for first."""
    type: str
    at: tuple = ()
    holds: tuple = ()
    inside: tuple = ()


def _utf16(name: str) -> str:
    return name.encode("utf-16-le").hex().upper()


def _ascii(text: str) -> str:
    return text.encode("ascii").hex().upper()


OFFICE, OASIS = "application/vnd.openxmlformats-officedocument.", "application/vnd.oasis.opendocument."

# Signatures, checked in this order.
COMMON = [
    Sign("application/pdf", ((0, "255044462D"),)),  # %PDF-
    Sign("application/pdf", ((0, "0A255044462D"),)),  # after a newline
    Sign("application/pdf", ((0, "EFBBBF255044462D"),)),  # after a byte order mark
    Sign("image/jpeg", ((0, "FFD8FF"),)),
    Sign("image/png", ((0, "89504E470D0A1A0A"),)),
    Sign("image/gif", ((0, "474946383761"),)),  # GIF87a
    Sign("image/gif", ((0, "474946383961"),)),  # GIF89a
    Sign("application/gzip", ((0, "1F8B"),)),
    Sign("application/postscript", ((0, "252150532D"),)),
    Sign("text/rtf", ((0, "7B5C727466"),)),
]
TREE = [
    Sign("application/zip", ((0, "504B0304"),), inside=(
        Sign("application/epub+zip", ((30, _ascii("mimetypeapplication/epub+zip")),)),
        Sign(OASIS + "text", ((30, _ascii("mimetype" + OASIS + "text")),)),
        Sign(OASIS + "spreadsheet", ((30, _ascii("mimetype" + OASIS + "spreadsheet")),)),
        Sign(OASIS + "presentation", ((30, _ascii("mimetype" + OASIS + "presentation")),)),
        Sign(OFFICE + "wordprocessingml.document", holds=(_ascii("word/"),)),
        Sign(OFFICE + "spreadsheetml.sheet", holds=(_ascii("xl/"),)),
        Sign(OFFICE + "presentationml.presentation", holds=(_ascii("ppt/"),)),
        Sign("application/vnd.android.package-archive", holds=(_ascii("AndroidManifest.xml"),)),
        Sign("application/java-archive", holds=(_ascii("META-INF/MANIFEST.MF"),)))),
    Sign("application/x-ole-storage", ((0, "D0CF11E0A1B11AE1"),), inside=(
        Sign("application/msword", holds=(_utf16("WordDocument"),)),
        Sign("application/vnd.ms-excel", holds=(_utf16("Workbook"), _utf16("Book"))),
        Sign("application/vnd.ms-powerpoint", holds=(_utf16("PowerPoint Document"),)))),
    Sign("application/octet-stream", ((0, "52494646"), (8, "57")), inside=(  # RIFF: a form type in W
        Sign("image/webp", ((8, "57454250"),)), Sign("audio/wav", ((8, "57415645"),)))),
    Sign("video/x-msvideo", ((0, "52494646"), (8, "41564920"))),
    Sign("video/mp4", ((4, "66747970"),), inside=(  # ISO media: brand after "ftyp"
        Sign("image/heic", ((8, "68656963"),)), Sign("image/avif", ((8, "61766966"),)), Sign("video/quicktime", ((8, "71742020"),)),
        Sign("audio/x-m4a", ((8, "4D344120"),)), Sign("video/3gpp", ((8, "33677034"),)),
        Sign("video/3gpp", ((8, "33677035"),)), Sign("video/3gpp", ((8, "33677036"),)))),
    Sign("video/x-matroska", ((0, "1A45DFA3"),), inside=(Sign("video/webm", holds=(_ascii("webm"),)),)),
    Sign("application/ogg", ((0, "4F67675300"),), inside=(
        Sign("video/ogg", holds=(_ascii("theora"),)), Sign("audio/ogg", holds=(_ascii("vorbis"), _ascii("OpusHead"))))),
    Sign("image/vnd.djvu", ((0, "41542654464F524D"), (12, "444A56"))),
    Sign("image/jp2", ((0, "0000000C6A5020200D0A870A"),)),
    Sign("image/tiff", ((0, "49492A00"),)),
    Sign("image/tiff", ((0, "4D4D002A"),)),
    Sign("image/bmp", ((0, "424D"), (6, "00000000"))),
    Sign("image/x-icon", ((0, "00000100"),)),
    Sign("image/vnd.adobe.photoshop", ((0, "38425053"),)),
    Sign("application/x-7z-compressed", ((0, "377ABCAF271C"),)),
    Sign("application/x-rar-compressed", ((0, "526172211A07"),)),
    Sign("application/x-bzip2", ((0, "425A68"), (4, "314159265359"))),
    Sign("application/x-xz", ((0, "FD377A585A00"),)),
    Sign("application/zstd", ((0, "28B52FFD"),)),
    Sign("application/x-tar", ((257, "7573746172"),)),
    Sign("audio/mpeg", ((0, "494433"), (6, "00"))),
    Sign("audio/flac", ((0, "664C614300"),)),
    Sign("audio/midi", ((0, "4D54686400"),)),
    Sign("application/x-elf", ((0, "7F454C46"),)),
    Sign("application/wasm", ((0, "0061736D"),)),
    Sign("application/vnd.sqlite3", ((0, "53514C69746520666F726D6174203300"),)),
    Sign("application/dicom", ((128, "4449434D"),)),
    Sign("font/ttf", ((0, "0001000000"),)),
    Sign("font/otf", ((0, "4F54544F00"),)),
    Sign("font/woff", ((0, "774F464600"),)),
    Sign("font/woff2", ((0, "774F463200"),)),
]
HEAD_BYTES = 64 << 10  # of a container that are looked into
BINARY_BYTES = 300  # one of which is a control character in the files of TREE
TEXT_PLAIN = "text/plain"
TEXT_UTF8 = "text/plain; charset=utf-8"
TEXT_8859 = "text/plain; charset=iso-8859-1"
TEXT_1252 = "text/plain; charset=windows-1252"
CONTROL = r"[\x00-\x08\x0b\x0e-\x1a\x1c-\x1f]"  # bytes that no text has
XML_UTF8 = "text/xml; charset=utf-8"
HTML_UTF8 = "text/html; charset=utf-8"
OCTET = "application/octet-stream"

# Fallback by extension when detection gives nothing.
EXT_TYPES = [
    (".xml", "application/xml"),
    (".png", "image/png"),
    (".jpg", "image/jpeg"),
    (".jpeg", "image/jpeg"),
    (".txt", "text/plain"),
]


def detect_mimetype(content: Column) -> Column:
    head_hex = F.hex(F.substring(content, 1, 16))
    # leading white space, of whatever length, comes before the markup
    text = F.when(F.substring(head_hex, 1, 2).isin("09", "0A", "0C", "0D", "20"), F.ltrim(content.cast("string"), F.lit(" \t\n\f\r")))
    lead = F.substring(F.coalesce(text.cast("binary"), content), 1, 16)
    head_txt = F.lower(F.decode(lead, "ISO-8859-1"))
    latin = F.decode(content, "ISO-8859-1")
    expr = F.when(F.octet_length(content) == 0, F.lit(TEXT_PLAIN))
    for sign in COMMON:
        expr = expr.when(F.startswith(head_hex, F.lit(sign.at[0][1])), F.lit(sign.type))
    text = (
        F.when(F.startswith(head_txt, F.lit("<?xml")), F.lit(XML_UTF8))
        .when(
            F.startswith(head_txt, F.lit("<!doctype html")) | F.startswith(head_txt, F.lit("<html")),
            F.lit(HTML_UTF8),
        )
        .when(F.is_valid_utf8(content), F.lit(TEXT_UTF8))
        .when(latin.rlike(CONTROL) | (2 * F.length(F.regexp_replace(latin, "[^\\x09-\\x7e]", "")) < F.octet_length(content)), F.lit(OCTET))
        .otherwise(F.when(latin.rlike("[\\x80-\\x9f]"), F.lit(TEXT_1252)).otherwise(F.lit(TEXT_8859)))
    )
    binary = F.decode(F.substring(content, 1, BINARY_BYTES), "ISO-8859-1").rlike(CONTROL)
    return expr.otherwise(F.coalesce(F.when(binary, _in_tree(content, head_hex)), text))


def _in_tree(content: Column, head_hex: Column) -> Column:
    """Type of ``content`` by TREE, null for none.  Signatures that are the
    first bytes alone are looked up in one literal map per length, the others
    tested one by one; so the generated code stays small."""
    plain = [s for s in TREE if len(s.at) == 1 and not s.at[0][0] and not s.inside]
    found = []
    for n in sorted({len(s.at[0][1]) for s in plain}, reverse=True):
        pairs = ", ".join(f"'{s.at[0][1]}', '{s.type}'" for s in plain if len(s.at[0][1]) == n)
        found.append(F.try_element_at(F.expr(f"map({pairs})"), F.substring(head_hex, 1, n)))
    tests = None
    for sign in TREE:
        if sign not in plain:
            name = _named(sign, content, head_hex)
            cond = _matches(sign, content, head_hex)
            tests = F.when(cond, name) if tests is None else tests.when(cond, name)
    return F.coalesce(tests, *found)


def _matches(sign: Sign, content: Column, head_hex: Column) -> Column:
    out = None
    for offset, raw in sign.at:
        n = len(raw) // 2
        near = F.substring(head_hex, 2 * offset + 1, 2 * n) == raw
        test = near if offset + n <= 16 else F.substring(content, offset + 1, n) == F.unhex(F.lit(raw))
        out = test if out is None else out & test
    if sign.holds:  # one look for all of them
        some = "|".join("".join(rf"\x{h[i:i + 2]}" for i in range(0, len(h), 2)) for h in sign.holds)
        out = F.decode(F.substring(content, 1, HEAD_BYTES), "ISO-8859-1").rlike(some)
    return out


def _named(sign: Sign, content: Column, head_hex: Column) -> Column:
    """The type, or that of what it holds: brands at one place by a map."""
    spots = {c.at[0][0] for c in sign.inside if len(c.at) == 1}
    if len(spots) == 1 and all(len(c.at) == 1 and len(c.at[0][1]) == 8 for c in sign.inside):
        pairs = ", ".join(f"'{c.at[0][1]}', '{c.type}'" for c in sign.inside)
        return F.coalesce(F.try_element_at(F.expr(f"map({pairs})"), F.substring(head_hex, 2 * spots.pop() + 1, 8)), F.lit(sign.type))
    expr = None
    for child in sign.inside:
        cond = _matches(child, content, head_hex)
        expr = F.when(cond, F.lit(child.type)) if expr is None else expr.when(cond, F.lit(child.type))
    return F.lit(sign.type) if expr is None else expr.otherwise(F.lit(sign.type))


def type_by_extension(ext: Column) -> Column:
    expr = None
    for suffix, name in EXT_TYPES:
        cond = F.endswith(ext, F.lit(suffix))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OCTET))


def content_type_for(content: Column, ext: Column) -> Column:
    """Detected type, falling back to the extension when detection is empty."""
    detected = detect_mimetype(content)
    return F.coalesce(F.nullif(detected, F.lit("")), type_by_extension(ext))
