from subvent.sources.staging import drop_staged, shared_folder, stage
from subvent.sources.tables import read_table, write_table

__all__ = ["drop_staged", "read_table", "shared_folder", "stage", "write_table"]
