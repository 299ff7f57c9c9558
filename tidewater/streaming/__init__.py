from tidewater.streaming.ingest import (append_stream, dedup_stream, read_target, scd2_stream,  # noqa: F401
                                        upsert_stream, write_landing)
