from stocktake.sinks.tables import (  # noqa: F401
    new_run_id,
    run_path,
    write_all_accounts,
    write_analysis,
    write_listing,
)
