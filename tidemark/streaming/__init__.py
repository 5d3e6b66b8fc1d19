from tidemark.streaming.upsert_stream import stream_upsert, upsert_batch

__all__ = ["stream_upsert", "upsert_batch"]
