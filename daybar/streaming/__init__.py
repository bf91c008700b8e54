"""The report job driven by Structured Streaming (file source + foreachBatch)."""

from daybar.streaming.incremental import published_reports, report_batch, start_report_stream

__all__ = ["published_reports", "report_batch", "start_report_stream"]
