"""Table schemas and the columns that identify groups and wafers."""

GROUP = ["equipment_id", "recipe", "head"]
KEY = [*GROUP, "epoch"]
WAFER = [*KEY, "wafer_seq"]

RAW = (
    "eqp_id string, product string, module_id string, wafer_id string, x int, y int, temp_raw string, event_tmstp timestamp"
)
CHIPS = (
    "equipment_id string, recipe string, head string, wafer_id string, wafer_seq bigint, first_ts timestamp, x int, y int, "
    "bond_order int, temp_series array<double>, resist_series array<double>, pm_event boolean"
)
EVENT_COLUMNS = [*GROUP, "wafer_id", "wafer_seq", "anomaly_type", "channel", "severity", "chip_x", "chip_y", "bond_order", "details"]
