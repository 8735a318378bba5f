"""Sources (base tables, configuration) and sinks (extract files)."""

from stayflow.sources.catalog import JdbcSource, SourceCatalog, normalize
from stayflow.sources.config import (
    MeasureId, StudyConfig, UnitWindow, ids_frame, units_frame)
from stayflow.sources.sinks import (
    materialize, publish, read_extract, read_published, write_extract)

__all__ = ["JdbcSource", "MeasureId", "SourceCatalog", "StudyConfig", "UnitWindow",
           "ids_frame", "materialize", "normalize", "publish", "read_extract",
           "read_published", "units_frame", "write_extract"]
