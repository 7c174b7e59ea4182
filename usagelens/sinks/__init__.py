"""Sinks: warehouse tables (truncate-and-write) and document collections."""

from usagelens.sinks.documents import append_run, read_documents, to_documents, write_documents
from usagelens.sinks.warehouse import conform, read_table, write_table

__all__ = ["conform", "read_table", "write_table", "to_documents", "write_documents", "read_documents",
           "append_run"]
