"""Import every operator so the registry is complete."""

from capstan.llm import decontamination, exact_dedup, filter_audit, fill_middle, html_text, language_id, line_dedup, packing, pii, quality, simhash, substring_dedup, warc  # noqa: F401
from capstan.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
