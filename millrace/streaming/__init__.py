from millrace.streaming.ingest import ingest_files
from millrace.streaming.jobs import TargetPaths, reset, stop
from millrace.streaming.target import MergeTarget, stream_merge

__all__ = ["MergeTarget", "TargetPaths", "ingest_files", "reset", "stop", "stream_merge"]
