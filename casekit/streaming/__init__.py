"""Structured Streaming jobs: sources, decode/enrich/land, live KPIs, joins."""

from casekit.streaming.join import (dedup_stream, forward_files, join_case_survey, publish_batch,
                                    publish_json, published_rows, tag_messages)
from casekit.streaming.live import (FollowingLookup, LiveSinks, decode_cases, decode_surveys, enrich_stream,
                                    land_stream, live_batch_writer, priority_join, start_live)
from casekit.streaming.sources import stream_files, stream_messages
from casekit.streaming.stateful import (count_first_seen, counted_kinds, cumulative_counts,
                                        join_streams, land_newest, merged_sketches,
                                        newest_landed, newest_versions_stream, priority_kinds,
                                        rocksdb_state, sketch_counts)

__all__ = ["dedup_stream", "forward_files", "join_case_survey", "publish_batch", "publish_json",
           "published_rows", "tag_messages", "LiveSinks", "decode_cases", "decode_surveys", "enrich_stream",
           "land_stream", "live_batch_writer", "priority_join", "start_live", "stream_files",
           "stream_messages", "FollowingLookup", "count_first_seen", "counted_kinds",
           "cumulative_counts", "join_streams", "land_newest", "merged_sketches", "newest_landed",
           "newest_versions_stream", "priority_kinds", "rocksdb_state", "sketch_counts"]
