from contrail.streaming.files import (  # noqa: F401
    print_batches,
    table_stream,
    text_stream,
    upsert_batches,
    write_files,
)
