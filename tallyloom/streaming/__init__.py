from tallyloom.streaming.cusum import stream_cusum
from tallyloom.streaming.quality import stream_quality
from tallyloom.streaming.runs import drain, drain_updates, read_stream

__all__ = ["drain", "drain_updates", "read_stream", "stream_cusum", "stream_quality"]
