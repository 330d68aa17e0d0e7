"""Object keys, spool paths and small string rules (F2-F5, F14, F16, F17,
F19, F21-F25)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
DEFAULT_BUCKET = "sandcrawler"
EXPECTED_SHA1_LENGTH = 40
DOWNLOAD_BASE = "https://archive.org/download/"
MASK = "****"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def blob_path(folder, sha1hex, ext, prefix) -> Column:
    """``{prefix}{folder}/{h[0:2]}/{h[2:4]}/{h}{.ext}`` (F2).

    A dot is added to a non-empty extension that lacks one.  Callers must
    ensure the key is 40 characters (P17); shorter keys give null.
    """
    folder, sha1hex, ext, prefix = map(_c, (folder, sha1hex, ext, prefix))
    dotted = (
        F.when(F.length(ext) == 0, F.lit(""))
        .when(F.startswith(ext, F.lit(".")), ext)
        .otherwise(F.concat(F.lit("."), ext))
    )
    return F.when(
        F.length(sha1hex) >= 4,
        F.concat(
            prefix, folder, F.lit("/"),
            F.substring(sha1hex, 1, 2), F.lit("/"),
            F.substring(sha1hex, 3, 2), F.lit("/"),
            sha1hex, dotted,
        ),
    )


def sharded_path(spool_dir, name) -> Column:
    """``{dir}/{n[0:2]}/{n[2:4]}/{n[4:]}``; null for names shorter than 8."""
    spool_dir, name = _c(spool_dir), _c(name)
    return F.when(
        F.length(name) >= 8,
        F.concat_ws(
            "/",
            F.regexp_replace(spool_dir, "/+$", ""),
            F.substring(name, 1, 2),
            F.substring(name, 3, 2),
            F.substring(name, 5, 1 << 30),
        ),
    )


def sharded_path_to_id(path) -> Column:
    """Last three path segments joined; fewer than three gives '' (F4)."""
    parts = F.split(_c(path), "/")
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, -3, 3), "")).otherwise(F.lit(""))


def shard_prefix2(h) -> Column:
    """First two characters, or '' (F5)."""
    h = _c(h)
    return F.when(F.length(h) >= 2, F.substring(h, 1, 2)).otherwise(F.lit(""))


def download_url(item, name) -> Column:
    """Download URL of a file in an archive item."""
    return F.concat(F.lit(DOWNLOAD_BASE), _c(item), F.lit("/"), _c(name))


def spool_url(listen_addr, ident) -> Column:
    """``http://{addr}/spool/{id}`` (F16)."""
    return F.concat(F.lit("http://"), _c(listen_addr), F.lit("/spool/"), _c(ident))


def rfc3339(ts) -> Column:
    """Timestamp in RFC 3339 with zone offset, ``Z`` for UTC."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ssXXX")


def export_filename(url, number) -> Column:
    """Last URL segment when it ends in .pdf (any case), else pdf_%04d.pdf."""
    last = F.element_at(F.split(F.coalesce(_c(url), F.lit("")), "/"), -1)
    numbered = F.format_string("pdf_%04d.pdf", _c(number))
    return F.when(F.endswith(F.lower(last), F.lit(".pdf")), last).otherwise(numbered)


def first_nonempty(*cols) -> Column:
    """First non-empty value, null when all are empty."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def default_sha1(sha1hex, content) -> Column:
    """Given key, or SHA-1 of the content when the key is empty."""
    return F.coalesce(F.nullif(_c(sha1hex), F.lit("")), F.sha1(_c(content)))


def default_bucket(bucket, default: str = DEFAULT_BUCKET) -> Column:
    """Given bucket, or the default when empty."""
    return F.coalesce(F.nullif(_c(bucket), F.lit("")), F.lit(default))


def mask_sensitive(value) -> Column:
    """``****`` for up to 4 characters, else first two + ``****`` + last two.

    Lengths and cuts count bytes; a cut character is replaced by U+FFFD.
    """
    v = _c(value).cast("binary")
    cut = F.concat(F.substring(v, 1, 2), F.lit(MASK).cast("binary"), F.substring(v, -2, 2))
    return F.when(F.octet_length(v) <= 4, F.lit(MASK)).otherwise(F.make_valid_utf8(cut.cast("string")))


def thumb_format(name) -> Column:
    """Thumbnail (format flag, extension) from a type name (F25); default jpeg."""
    n = F.lower(_c(name))
    flag = (
        F.when(n.isin("jpg", "jpeg"), F.lit("-jpeg"))
        .when(n == "png", F.lit("-png"))
        .when(n == "tiff", F.lit("-tiff"))
        .otherwise(F.lit("-jpeg"))
    )
    ext = (
        F.when(n.isin("jpg", "jpeg"), F.lit(".jpg"))
        .when(n == "png", F.lit(".png"))
        .when(n == "tiff", F.lit(".tiff"))
        .otherwise(F.lit(".jpg"))
    )
    return F.struct(flag.alias("flag"), ext.alias("ext"))
