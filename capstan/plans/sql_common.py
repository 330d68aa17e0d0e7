"""SQL fragments shared by oracle statements: the same rules as
``capstan.plans.inputs``, restated in plain SQL over the driver tables."""

# blobs, their type, hash and the rule-made extraction status.
EXTRACT_CTE = """
b AS (
  SELECT doc_id, text, n_chars, source,
         CASE WHEN doc_id % 3 <> 2 THEN '%PDF-1.4' || chr(10) || text ELSE text END AS ctext
  FROM documents
),
f AS (
  SELECT *, sha1(ctext) AS sha1hex, md5(ctext) AS md5hex, sha256(ctext) AS sha256hex,
         CAST(strlen(ctext) AS BIGINT) AS size,
         CASE WHEN doc_id % 3 <> 2 THEN 'application/pdf'
              WHEN strlen(ctext) = 0 THEN 'text/plain'
              ELSE 'text/plain; charset=utf-8' END AS mimetype
  FROM b
),
bl AS (SELECT DISTINCT sha1hex FROM f WHERE doc_id % 29 = 0),
s AS (
  SELECT f.*,
    CASE WHEN mimetype <> 'application/pdf' THEN 'not-pdf'
         WHEN sha1hex IN (SELECT sha1hex FROM bl) THEN 'bad-pdf'
         WHEN doc_id % 17 = 5 THEN 'parse-error'
         WHEN doc_id % 19 = 7 THEN 'empty-pdf'
         ELSE 'success' END AS status
  FROM f
)
"""
