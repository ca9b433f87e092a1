"""Sources: CSV feeds, JSON-lines dictionary, text lines, and the driver-table testbed."""

from .csv import read_feed, read_feed_checked, read_named_feed, read_positional
from .json import read_dictionary
from .text import read_key_value

__all__ = ["read_dictionary", "read_feed", "read_feed_checked", "read_key_value", "read_named_feed", "read_positional"]
