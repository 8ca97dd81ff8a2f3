"""Fixed values that must equal the reference's for matching results.

FIXED VALUES (reference example configuration; operators take them as
parameters, these are only the defaults):
"""

# --- FIXED VALUES: station-name resolution ---------------------------------
# Raw snapshot station name -> canonical dimension name.
NAME_OVERRIDES = {
    "Berlin Hbf": "Berlin Hauptbahnhof",
    "Berlin Yorckstr.(S1)": "Yorckstraße (Großgörschenstraße)",
    "Berlin Yorckstr.(S2)": "Yorckstraße",
}
# Prefix removed from raw names before the exact and fuzzy lookups.
NAME_PREFIX = "Berlin "

# --- FIXED VALUES: snapshot parsing ----------------------------------------
# Compact timestamp text used in folder names and XML attributes.
COMPACT_TS_FORMAT = "yyMMddHHmm"
# Train category whose stops are excluded.
EXCLUDED_CATEGORY = "Bus"
# Defaults for a stop's train line on the Spark path.
DEFAULT_CATEGORY = "Unknown"
DEFAULT_TRAIN_NUMBER = "0"
# Cancellation status value.
CANCELLED_STATUS = "c"
# Suffix of update (change) files; every other file is a plan file.
CHANGE_FILE_SUFFIX = "_change.xml"
PLAN_FILE_SUFFIX = "_timetable.xml"

# --- FIXED VALUES: time dimension and analysis ------------------------------
SLOT_MINUTES = 15
# Peak hours: [7, 9) and [17, 19).
PEAK_HOURS = (7, 8, 17, 18)
# Reference time-dimension bounds (inclusive).
TIME_DIM_START = "2025-09-02 00:00:00"
TIME_DIM_END = "2025-10-15 00:00:00"

# --- FIXED VALUES: routing ----------------------------------------------------
TRANSFER_BUFFER_MINUTES = 2
ROUTE_TIME_FORMAT = "yyyy-MM-dd HH:mm"
ITINERARY_TIME_FORMAT = "HH:mm"
STATUS_OK = "ok"
STATUS_NOT_FOUND = "Station not found"
STATUS_NO_CONNECTION = "No connection found"
