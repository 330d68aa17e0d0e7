"""Literal heads of forty file types and more."""

from pyspark.sql import functions as F

from capstan.functions.mime import detect_mimetype

OFFICE, OASIS = "application/vnd.openxmlformats-officedocument.", "application/vnd.oasis.opendocument."
ZIP, OLE = b"PK\x03\x04" + b"\x14\0\0\0\x08\0" + bytes(20), bytes.fromhex("D0CF11E0A1B11AE1") + bytes(1000)

# First bytes as the formats define them.
CASES = [
    (b"%PDF-1.7\n", "application/pdf"), (b"\n%PDF-1.4", "application/pdf"), (b"\xef\xbb\xbf%PDF-1.4", "application/pdf"),
    (b"\xff\xd8\xff\xe0\0\x10JFIF", "image/jpeg"), (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR", "image/png"), (b"GIF87a\1\0", "image/gif"), (b"GIF89a\1\0", "image/gif"),
    (b"\x1f\x8b\x08\0", "application/gzip"), (ZIP + b"a.txt", "application/zip"),
    (ZIP + b"mimetypeapplication/epub+zipPK", "application/epub+zip"),
    (ZIP + b"mimetype" + OASIS.encode() + b"text", OASIS + "text"), (ZIP + b"mimetype" + OASIS.encode() + b"spreadsheet", OASIS + "spreadsheet"),
    (ZIP + b"mimetype" + OASIS.encode() + b"presentation", OASIS + "presentation"),
    (ZIP + b"[Content_Types].xml" + bytes(900) + b"PK\x03\x04word/document.xml", OFFICE + "wordprocessingml.document"),
    (ZIP + b"[Content_Types].xml" + bytes(900) + b"xl/workbook.xml", OFFICE + "spreadsheetml.sheet"),
    (ZIP + b"[Content_Types].xml" + bytes(900) + b"ppt/slides/slide1.xml", OFFICE + "presentationml.presentation"),
    (ZIP + b"META-INF/MANIFEST.MF", "application/java-archive"), (ZIP + b"AndroidManifest.xml", "application/vnd.android.package-archive"),
    (OLE, "application/x-ole-storage"), (OLE + "WordDocument".encode("utf-16-le"), "application/msword"),
    (OLE + "Workbook".encode("utf-16-le"), "application/vnd.ms-excel"), (OLE + "PowerPoint Document".encode("utf-16-le"), "application/vnd.ms-powerpoint"),
    (b"RIFF\x24\0\0\0WAVEfmt ", "audio/wav"), (b"RIFF\x24\0\0\0WEBPVP8 ", "image/webp"), (b"RIFF\x24\0\0\0AVI LIST", "video/x-msvideo"),
    (b"\0\0\0\x18ftypmp42\0", "video/mp4"), (b"\0\0\0\x18ftypheic\0", "image/heic"), (b"\0\0\0\x18ftypavif\0", "image/avif"),
    (b"\0\0\0\x14ftypqt  \0", "video/quicktime"), (b"\0\0\0\x14ftypM4A \0", "audio/x-m4a"), (b"\0\0\0\x14ftyp3gp5\0", "video/3gpp"),
    (b"\x1aE\xdf\xa3\x01\0B\x82\x84webm", "video/webm"), (b"\x1aE\xdf\xa3\x01\0B\x82\x88matroska", "video/x-matroska"),
    (b"OggS\0\2" + bytes(22) + b"\x01vorbis", "audio/ogg"), (b"OggS\0\2" + bytes(22) + b"\x80theora", "video/ogg"), (b"OggS\0\2" + bytes(40), "application/ogg"),
    (b"AT&TFORM\0\0\0\x10DJVUINFO", "image/vnd.djvu"), (bytes.fromhex("0000000C6A5020200D0A870A"), "image/jp2"),
    (b"II*\0\x08\0", "image/tiff"), (b"MM\0*\0\0", "image/tiff"), (b"BM\x36\x10\0\0\0\0\0\0\x36", "image/bmp"), (b"\0\0\1\0\1\0", "image/x-icon"),
    (b"8BPS\0\1", "image/vnd.adobe.photoshop"), (b"%!PS-Adobe-3.0", "application/postscript"), (b"{\\rtf1\\ansi", "text/rtf"),
    (b"7z\xbc\xaf\x27\x1c\0\4", "application/x-7z-compressed"), (b"Rar!\x1a\x07\1\0", "application/x-rar-compressed"),
    (b"BZh91AY&SY\0", "application/x-bzip2"), (b"\xfd7zXZ\0\0", "application/x-xz"), (b"\x28\xb5\x2f\xfd\x04", "application/zstd"),
    (b"file.txt" + bytes(249) + b"ustar\x0000", "application/x-tar"), (b"ID3\4\0\0\0\0", "audio/mpeg"), (b"fLaC\0\0", "audio/flac"), (b"MThd\0\0\0\6", "audio/midi"),
    (b"\x7fELF\2\1", "application/x-elf"), (b"\0asm\1\0", "application/wasm"), (b"SQLite format 3\0", "application/vnd.sqlite3"),
    (bytes(128) + b"DICM", "application/dicom"), (b"\0\1\0\0\0\x0c", "font/ttf"), (b"OTTO\0\x0b", "font/otf"), (b"wOFF\0\1", "font/woff"), (b"wOF2\0\1", "font/woff2"),
    # what only begins alike is text
    (b"BM is no image", "text/plain; charset=utf-8"), (b"BZh is no archive", "text/plain; charset=utf-8"), (b"ID3 of them", "text/plain; charset=utf-8"),
    (b"RIFF raff and more", "text/plain; charset=utf-8"), (b"OTTO said", "text/plain; charset=utf-8"), (b"PKs", "text/plain; charset=utf-8"), (b"", "text/plain"),
    (b" <!DOCTYPE html><p>", "text/html; charset=utf-8"), (b"<?xml version='1.0'?>", "text/xml; charset=utf-8"), (b"\0\1\2\xff", "application/octet-stream"),
]


def test_literal_heads(spark):
    df = spark.createDataFrame([(i, bytearray(b)) for i, (b, _) in enumerate(CASES)], "i int, content binary")
    got = {r.i: r.t for r in df.select("i", detect_mimetype(F.col("content")).alias("t")).collect()}
    assert [got[i] for i in range(len(CASES))] == [t for _, t in CASES]
    assert len({t for _, t in CASES}) > 40
