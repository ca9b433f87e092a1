"""Structured Streaming execution of the top-tags and classification analytics over arriving feed files."""

from .feed_stream import read_feed_stream, start_classification, start_top_tags, streaming_tag_counts

__all__ = ["read_feed_stream", "start_classification", "start_top_tags", "streaming_tag_counts"]
