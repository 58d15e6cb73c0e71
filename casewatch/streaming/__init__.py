"""Structured Streaming entry points.

The reference is batch-only; its one notion of change over time is "a newer
version of a case replaces the older one" (D1). ``versions`` applies that same
aggregate to a stream of raw case files; ``corrections`` merges a stream into
stored cases and corrects counts by the old and new row of each changed case.
"""

from casewatch.streaming.corrections import CorrectedCounts, start_corrected_counts
from casewatch.streaming.versions import newest_versions_stream, start_newest_versions

__all__ = ["CorrectedCounts", "newest_versions_stream", "start_corrected_counts", "start_newest_versions"]
