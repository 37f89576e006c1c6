"""Writers: routed topics, the raw archive, the DAU table, previews."""

from actimetry.sinks.files import (
    write_by_batch, init_table, preview,
)

__all__ = ["write_by_batch", "init_table",
           "preview"]
