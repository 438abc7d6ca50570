"""Business codes, cuts and sentinels the results depend on."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

# Product master codes.
STOCKOUT_STATUSES = ("Basis", "Limitiert")
ASSORTMENT_STATUSES = ("Basis", "Limitiert", "Ex", "OneShot")
SHOP_ACTIVE = "activated"
SHOP_VISIBILITY = "Einzeln nicht sichtbar"
SHOP_VISIBILITY_CONFIG = "Katalog, Suche"

# Purchasing and ledger codes.
CAMPAIGN_TYPE = "AKT"
GIFT_TYPE = "GWP"
INBOUND_LOCATION = "MARK_WE"
PURCHASE_ENTRY = "0"
STATUS_CLOSED = "5"
STATUS_INTERNAL = "6"

# Dates used as markers.
LAST_VALID_DAY = dt.datetime(9999, 12, 31)
NO_DATE = dt.date(1753, 1, 1)

# Turnover clusters, upper share bound (inclusive) per letter.
TURNOVER_CUTS = (0.5382, 0.8005, 0.9479)
TURNOVER_LETTERS = ("A", "B", "C", "D")

# Forecast monitoring.
NO_SALES_MAPE = Decimal("9.99")
MIN_MAPE = Decimal("0.1")
MIN_MAD = 1

# Report windows in days, and default start days.
HORIZONS = (7, 30, 45, 56)
LAST_DAYS = 8
NEXT_DAYS = 6
ARCHIVE_DAYS = 60
YTD_START = dt.date(2018, 1, 1)
LEADTIME_YEAR = "2018"
SALES_SINCE = dt.date(2017, 1, 1)
AVAILABLE_LABEL = "[Available]"
