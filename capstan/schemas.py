"""Target table schemas (DDL strings usable with ``spark.read.schema``)."""

BLOBS = "content binary, size bigint, url string, source string, arrived timestamp"
FILE_INFO = "size bigint, md5hex string, sha1hex string, sha256hex string, mimetype string"
WARC_RECORDS = (
    "warc_file string, file_name string, record_idx bigint, record_offset bigint, record_length bigint, "
    "warc_type string, target_uri string, record_date string, content_type string, "
    "content_length_raw string, content_length bigint, headers map<string,string>, payload binary, error string"
)
RESPONSES = (
    "warc_file string, file_name string, record_idx bigint, uri string, status_line string, status_code int, "
    "http_headers map<string,string>, http_content_type string, http_content_length bigint, "
    "body binary, size bigint"
)
CDX = (
    "url string, mime_type string, response_code bigint, compressed_record_size bigint, "
    "compressed_offset bigint, filename string, _corrupt_record string"
)
SPOOL = "name string, size bigint, t string, url string"
URL_MAP = "url string NOT NULL, sha1 string NOT NULL, timestamp timestamp"
ARTIFACTS = (
    "sha1hex string, kind string, bucket string, object_path string, content_type string, "
    "size bigint, content binary"
)
RUN_STATS = "processed bigint, ok bigint, success_ratio double"
