"""Block-ledger pipelines on Spark: normalise, ingest, finalise, serve and validate."""

from ledgerloom.operators.normalize import LedgerFrames, document_messages, normalize
from ledgerloom.plans.finality import apply_finality, start_finality
from ledgerloom.plans.flat import FlatTable, build_block, build_flat, build_incremental, build_range
from ledgerloom.session import build_session
from ledgerloom.sources.catalog import create_tables
from ledgerloom.sources.documents import read_documents, stream_documents
from ledgerloom.sources.history import backfill
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming.ingest import (
    catchup,
    publish,
    publish_documents,
    start_publish,
    start_raw_ingest,
)

__all__ = [
    "FlatTable", "Lake", "LedgerFrames", "apply_finality", "backfill", "build_block",
    "build_flat", "build_incremental", "build_range", "build_session", "catchup",
    "create_tables", "document_messages", "normalize", "publish", "publish_documents", "read_documents",
    "start_finality", "start_publish", "start_raw_ingest", "stream_documents",
]
