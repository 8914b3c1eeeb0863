from pitchlake.streaming.silver_stream import bronze_event_stream, process_batch, start

__all__ = ["bronze_event_stream", "process_batch", "start"]
