"""They must equal the business's own settings for results to be right."""

import datetime as dt

# --- dates -----------------------------------------------------------------------------------------
AS_OF = dt.date(2001, 8, 1)            # the day reports are run for
RECENT_CUTOFF = dt.datetime(2001, 7, 1)  # shipments from here on may still be under way

# --- domains ---------------------------------------------------------------------------------------
COUNTRIES = ["US", "CA", "GB", "FR", "DE", "NL", "BE", "ES", "IT"]
PAYMENT_TERMS = [0, 15, 30, 45, 60, 90]
ACCOUNT_STATUSES = ["Active", "Suspended", "Closed"]
ADDRESS_ROLES = ["Billing", "Warehouse", "Pickup", "Delivery", "Other"]
FACILITY_TYPES = ["Hub", "Depot", "RetailCounter"]
SERVICE_TIERS = ["Ground", "Express", "Freight"]
SHIPMENT_STATUSES = ["Created", "PickedUp", "InTransit", "OutForDelivery",
                     "Delivered", "FailedDelivery", "Returned", "Cancelled"]
RETAIL_PAYMENT_STATUSES = ["Pending", "Paid", "Refunded", "Waived"]
EVENT_CODES = ["PICKUP", "SCAN_HUB", "SCAN_DEPOT", "OUT_FOR_DELIVERY", "DELIVERED", "FAILED_DELIVERY",
               "CUSTOMS_HOLD", "CUSTOMS_CLEARED", "RETURNED_TO_SENDER", "DAMAGED", "EXCEPTION"]
VEHICLE_TYPES = ["Cargo Van", "Box Truck", "Semi", "Flatbed", "Refrigerated"]
CAPACITY_CLASSES = ["Light", "Medium", "Heavy"]
VEHICLE_STATUSES = ["Available", "In Use", "Maintenance", "Retired"]
ASSIGNMENT_STATUSES = ["Scheduled", "Active", "Completed", "Cancelled"]
INVOICE_STATUSES = ["Draft", "Issued", "PartiallyPaid", "Paid", "Overdue", "Cancelled", "Disputed"]
PAYMENT_METHODS = ["ACH", "Wire", "Check", "Credit Card", "Cash", "EFT", "Other"]

# --- tier shares: upper bounds of a 0-99 roll --------------------------------------------------------
TIER_BANDS = [(41, "Ground"), (88, "Express")]  # the rest is Freight
RECENT_STATUS_BANDS = [(10, "Created"), (25, "PickedUp"), (65, "InTransit"), (85, "OutForDelivery")]
SETTLED_STATUS_BANDS = [(88, "Delivered"), (92, "Returned"), (95, "Cancelled")]
PACKAGE_STATUS = {"Delivered": "Delivered", "FailedDelivery": "DeliveryAttempted",
                  "Returned": "DeliveryAttempted", "Cancelled": "Created",
                  "OutForDelivery": "OutForDelivery"}  # any other: InTransit

# --- event paths: (path, number of events) -> codes in order -----------------------------------------
EVENT_PATHS = {
    ("InProgress", 3): ["PICKUP", "SCAN_HUB", "SCAN_HUB"],
    ("InProgress", 4): ["PICKUP", "SCAN_HUB", "SCAN_HUB", "OUT_FOR_DELIVERY"],
    ("Completed", 3): ["PICKUP", "OUT_FOR_DELIVERY", "FINAL"],
    ("Completed", 4): ["PICKUP", "SCAN_HUB", "OUT_FOR_DELIVERY", "FINAL"],
    ("Completed", 5): ["PICKUP", "SCAN_HUB", "SCAN_HUB", "OUT_FOR_DELIVERY", "FINAL"],
    ("Completed", 6): ["PICKUP", "SCAN_HUB", "SCAN_HUB", "SCAN_DEPOT", "OUT_FOR_DELIVERY", "FINAL"],
}
PACKAGE_COUNT_BANDS = [(75, 3), (93, 4), (98, 5)]  # the rest has 6 events
PALLET_COUNT_BANDS = [(45, 3), (75, 4), (92, 5)]

# Hours between events: (least hours, number of possible hours)
PICKUP_HOURS = (0, 5)
HAUL_HOURS = {"Ground": (24, 49), "Express": (8, 23), "Freight": (24, 73)}  # first hub scan, depot scan
SECOND_HUB_HOURS = {"Package": (2, 7), "Pallet": (4, 13)}
LAST_MILE_HOURS = (8, 9)
OTHER_HOURS = (2, 7)

# --- rates -------------------------------------------------------------------------------------------
# tier: (current base rate per shipment, current surcharge per kg)
RATE_BASE = {"Ground": (4.50, 0.15), "Express": (9.00, 0.35), "Freight": (2.80, 0.10)}
# (from, to or None for open, years before current)
RATE_PERIODS = [("1995-01-01", "1996-12-31", 2), ("1997-01-01", "1998-12-31", 1), ("1999-01-01", None, 0)]
YEARLY_STEP = 1.05
CANADA_FACTOR = 1.20
CAD_TO_USD = "0.730000"

# --- waits that only mean a task is idle ---------------------------------------------------------------
BENIGN_WAITS = [
    "SLEEP_TASK", "BROKER_TO_FLUSH", "BROKER_TASK_STOP", "CLR_AUTO_EVENT",
    "DISPATCHER_QUEUE_SEMAPHORE", "FT_IFTS_SCHEDULER_IDLE_WAIT",
    "HADR_WORK_QUEUE", "LAZYWRITER_SLEEP", "LOGMGR_QUEUE",
    "REQUEST_FOR_DEADLOCK_SEARCH", "RESOURCE_QUEUE", "SERVER_IDLE_CHECK",
    "SLEEP_DBSTARTUP", "SLEEP_DBRECOVER", "SLEEP_MASTERDBREADY",
    "SLEEP_MASTERMDREADY", "SLEEP_MASTERUPGRADED", "SLEEP_MSDBSTARTUP",
    "SLEEP_SYSTEMTASK", "SLEEP_TEMPDBSTARTUP", "SNI_HTTP_ACCEPT",
    "SP_SERVER_DIAGNOSTICS_SLEEP", "SQLTRACE_BUFFER_FLUSH", "WAITFOR",
    "XE_DISPATCHER_WAIT", "XE_TIMER_EVENT", "SQLTRACE_INCREMENTAL_FLUSH_SLEEP",
]

# --- thresholds ----------------------------------------------------------------------------------------
LONG_RUNNING_MS = 30000
RETURNS_WATCH, RETURNS_ACT = 20, 34  # percent of a supplier's lines
LOW_BALANCE = 1000
MEDIUM_LINE, HEAVY_LINE = 49, 50  # heaviest line of a vehicle
ALERT_SEVERITY, ALERT_DELAY_SECONDS = 19, 300
