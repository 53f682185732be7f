"""folioflow: document-batch processing as Spark DataFrame and Structured Streaming jobs.

Public entry points (all DataFrame -> DataFrame unless noted):

* split planning: :func:`split_plan`, :func:`assign_pages`, :func:`barcode_map`, :func:`page_counts`
* ordering inside documents: :func:`ordinal_within`, :func:`neighbours_within`
* completeness and resume: :mod:`folioflow.plans.complete`
* merges and request payloads: :mod:`folioflow.plans.merge`
* image plans and report parsers: :mod:`folioflow.plans.images`
* routing, filters and predicates: :mod:`folioflow.operators.filters`
* column functions: :mod:`folioflow.functions` (text, paths, dates, codes, SQL functions)
* user table: :mod:`folioflow.plans.users`
* page functions: :func:`map_pages`, :func:`map_documents`
* streams: :mod:`folioflow.streaming.requests`
* sources and sinks: :mod:`folioflow.sources`, :mod:`folioflow.sinks.writers`
"""

from .operators.ordering import neighbours_within, ordinal_within
from .plans.page_functions import map_documents, map_pages
from .plans.split import assign_pages, barcode_map, page_counts, split_plan

__all__ = ["split_plan", "assign_pages", "barcode_map", "page_counts", "ordinal_within", "neighbours_within",
           "map_pages", "map_documents"]
