from statline.streaming.landing import stream_to_landing, stream_to_tables

__all__ = ["stream_to_landing", "stream_to_tables"]
