from cadence.streaming.upsert_stream import change_stream, start_upsert_stream

__all__ = ["change_stream", "start_upsert_stream"]
