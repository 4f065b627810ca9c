"""Structured Streaming forms of batch operators.

The reference has no stream processing (its "streaming" is Hadoop
Streaming over finite files).  The same parse -> reduce plan runs here
incrementally over a growing folder of text files.
"""
from quarry.streaming.pairs import stream_reduce_pairs  # noqa: F401
