"""levain — a PySpark toolkit for a layered (bronze / silver / gold) sales lakehouse.

Everything is DataFrame / SQL / Structured Streaming code: file and cursor ingest,
data-quality expectations, change data capture into SCD type 1 / type 2 tables,
dimensional models, sales aggregates, great-circle distances and event-log reports.
"""

from levain.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
