"""Structured Streaming entry to the same data model.

The reference has no streaming operator. Rating triples arriving as text files are parsed with the very expressions of the
batch reader (a pure projection and filter, valid on a stream) and appended
to a Parquet ratings table that the batch jobs read. The batch side's top-k
aggregate runs on a stream as it is and keeps its lists up to date.
"""

from corate.streaming.ingest import ingest_triples, read_triples_stream  # noqa: F401
from corate.streaming.topk import read_top_k, stream_top_k  # noqa: F401
