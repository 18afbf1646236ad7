from subtide.sources.scratch import drop_written, kept_once, scratch_root, written, written_once  # noqa: F401
from subtide.sources.stored import (  # noqa: F401
    open_bucketed,
    open_for_figures,
    save_bucketed,
    save_checked,
    written_checked,
)
from subtide.sources.tables import (  # noqa: F401
    append_table,
    read_csv_and_violations,
    read_positioned_csv,
    read_table,
    save_table,
)
