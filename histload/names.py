"""Column names and codes shared by the package."""

# The audit columns every history table carries.
HASH_KEY = "hashKey"
HASH_DATA = "hashData"
START = "startDate"
END = "endDate"
MERGE_KEY = "mergeKey"
DEFAULT_PARTITION = "date_loaded"

# Folder levels of a history table above the load date; no data column may have these names.
LOAD_FOLDER = "history_load"
STATE_FOLDER = "history_state"

# The name of the load step; a log written by other loaders may have its own (LoadOptions.load_step).
STEP_LOAD = "History Load"
# Name of the registration step, step states and file format of the control tables.
STEP_REGISTRATION = "File Registration"
IN_PROGRESS = "IN-PROGRESS"
DONE = "DONE"
ERROR = "ERROR"
RUNNING_DETAIL = "running"
DONE_DETAIL = "Completed Successfully"
DELIMITED = "DELIMITED"
SUCCESS = "Success"
FAILED = "Failed"
NEVER = "1970-01-01 00:00:00"


def quoted(name: str) -> str:
    """The column name as an expression, safe for dots, blanks and backticks."""
    return "`" + name.replace("`", "``") + "`"
