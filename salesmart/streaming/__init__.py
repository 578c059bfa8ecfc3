from .intake_stream import arrival, read_result, stream_intake  # noqa: F401
