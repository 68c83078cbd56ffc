from regmine.streaming.clean_stream import clean_stream, start_clean_stream  # noqa: F401
