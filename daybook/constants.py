"""Fixed values that decide results.

These must stay exactly as written: they are the behaviour of the daily
load being rebuilt (validity sentinel, grace periods, report labels, feed
routing words and the file-name date shape).
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values -----------------------------------------------------------
# Open-ended validity of a history row.
OPEN_UNTIL = _dt.datetime(2999, 12, 31, 0, 0, 0)
# A closed row ends one second before the batch date (previous day 23:59:59).
CLOSE_OFFSET = "INTERVAL 1 SECOND"
# A passport is valid through 23:59:59 of its valid-to day.
PASSPORT_GRACE = "INTERVAL '23:59:59' HOUR TO SECOND"
# Report labels, in rule priority order for the static rules.
EVENT_EXPIRED_PASSPORT = "expired passport"
EVENT_BLACKLISTED = "passport in black list"
EVENT_INVALID_CONTRACT = "invalid contract"
EVENT_DIFFERENT_CITIES = "different cities"
# Feed routing: a file belongs to a feed when its name contains the word.
FEED_TRANSACTIONS = "transaction"
FEED_TERMINALS = "terminals"
FEED_BLACKLIST = "passport_blacklist"
# File names carry the batch date as ..._DDMMYYYY.<ext>
FILENAME_DATE_PATTERN = r"_(\d{8})\."
FILENAME_DATE_FORMAT = "ddMMyyyy"
# Delimited feed: ';' separator, header line, decimal comma.
DELIMITED_SEPARATOR = ";"
DECIMAL_COMMA = ","
# deleted_flg values
LIVE = 0
DELETED = 1
# ---------------------------------------------------------------------------

# SCD2 close modes.
CLOSE_OPEN_ONLY = "open_only"
CLOSE_ALL_VERSIONS = "all_versions"
