"""Names of the columns and tables that the engine adds."""

ROW_ID, LOAD_ID, ROOT_ID, PARENT_ID, POSITION = "_sys_id", "_sys_load_id", "_sys_root_id", "_sys_parent_id", "_sys_pos"
ARRIVAL, VALID_FROM, VALID_TO, DELETED = "_arrival", "_valid_from", "_valid_to", "_deleted"
PARENT_PREFIX = "_parent_"
