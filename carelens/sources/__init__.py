"""Reading the clinical tables and the stage files, writing the outputs."""

from carelens.sources.clustered import forget_clustered, load_clustered, write_clustered
from carelens.sources.stages import (
    publish,
    read_baseline,
    read_line_list,
    read_published,
    retired_runs,
    write_line_list,
    write_report,
)
from carelens.sources.tables import SCHEMAS, load_clinical

__all__ = ["SCHEMAS", "forget_clustered", "load_clinical", "load_clustered", "publish", "read_baseline",
           "read_line_list", "read_published", "retired_runs", "write_clustered", "write_line_list",
           "write_report"]
