from lakestrata.streaming.drift import append_batch, stream_drifting_files
from lakestrata.streaming.files import IncompatibleDelivery, stream_new_files

__all__ = ["IncompatibleDelivery", "append_batch", "stream_drifting_files", "stream_new_files"]
