from sluice.streaming.logs import (  # noqa: F401
    parse_log_lines,
    read_log_stream,
    read_parsed_logs,
    run_log_stream,
)
from sluice.streaming.documents import (  # noqa: F401
    read_stored_sheets,
    run_spec_sheet_stream,
    store_new_sheets,
)
