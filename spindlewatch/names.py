"""Names, limits and texts that other programs on the same topics and tables rely on."""

# Tables.
PROFILES = "machine_profiles"
STATUS = "machine_status"
ACTIVITIES = "system_activities"

# The loader's entry in the activities table.
LOADER_KEY = "LOADER_STATUS"
LOADER_FINISHED = "FINISHED"

# Temperature labels, as published to the control topic.
GREEN = "green"
ORANGE = "orange"
RED = "red"

# Label given to a machine without limits when that is asked for; never published by default.
UNKNOWN = "unknown"

# Event time.
WINDOW_WIDTH = "10 seconds"
ALLOWED_LAG = "2 seconds"

# Triggers: the control topic is polled and a subscription is harvested at these intervals.
CONTROL_INTERVAL = "4 seconds"
HARVEST_INTERVAL = "2.5 seconds"

# Machine profiles.
MIN_MACHINES = 1
CRITICAL_MARGIN = 60
DEFAULT_FAULTY_ODDS = 0.1

# Log texts.
RECEIVED_TEXT = "Received event for %s"
RED_TEXT = "%s went RED, reducing speed"
GREEN_TEXT = "%s went GREEN, resuming normal speed"
