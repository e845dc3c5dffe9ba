from casework.sources.tables import (  # noqa: F401
    CASE_SCHEMAS, DRIVER_SCHEMAS, Tables, load_table, table_path,
)
from casework.sources.sinks import append, append_table, materialize  # noqa: F401
from casework.sources.layout import bucket_driver_tables, on_dates, write_bucketed, write_by_date  # noqa: F401
from casework.sources.drift import SchemaDrift, check_schema, drift  # noqa: F401
from casework.sources.ledger import append_once, read_committed  # noqa: F401
from casework.sources.stages import StageStore, drop_stages  # noqa: F401
