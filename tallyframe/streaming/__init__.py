from tallyframe.streaming.runner import file_stream, run_stream  # noqa: F401
