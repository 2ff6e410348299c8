from skewsafe.streaming.append_stream import append_stream, orders_stream, run_append_stream

__all__ = ["append_stream", "orders_stream", "run_append_stream"]
