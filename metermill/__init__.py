"""Meter-reading translation on Spark: nested XML exports in, flat canonical readings out."""

from metermill.job import translate_export
from metermill.plans.feed import fused_feed, unified_feed
from metermill.plans.kinds import KINDS, kind_named
from metermill.plans.translate import translate
from metermill.schemas import document_schema
from metermill.sources.documents import read_documents

__all__ = ["KINDS", "document_schema", "fused_feed", "kind_named", "read_documents", "translate",
           "translate_export", "unified_feed"]
