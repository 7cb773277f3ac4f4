"""Fixed values of the business rules.

These codes, names, thresholds and rates must equal the ones the source systems and the
finance rules use; they are data, not design.
"""

from datetime import date
from decimal import Decimal

# Pickup branches whose waybills are not commercial traffic.
EXCLUDED_BRANCHES = (
    "AGENT_LIAONING",
    "AGENT_SHANDONG",
    "TH TESTING HQ",
    "TH_DALIAN",
    "HEADQUARTER",
    "TH_SHENYANG",
    "TH_QINGDAO",
    "PDB_AIRPORT",
    "PDB_TECH",
    "PDB_SHENYANG",
    "PDB_QINGDAO",
    "TH_DALIAN1",
    "TH_QINGDAO1",
    "PDB_SHENYANG1",
)
TEST_HUB = "TH TESTING HQ"
EXCLUDED_ORDERS = ("EXAMPLE_ORDER_EXCLUSION",)

# Kinds of the code tables.
WAYBILL_SOURCE = "waybillSource"
ORDER_SOURCE = "orderSource"
SERVICE_TYPE = "serviceType"
EXPRESS_TYPE = "expressType"
OPERATION_TYPE = "operationType"
RETURN_FLAG = "returnFlag"
POD_FLAG = "podFlag"
VOID_FLAG = "voidFlag"
PAYMENT_TYPE = "paymentType"
VIP_SELLER = "vipSeller"

# Waybill source codes with their own tariff.
SOURCE_KEY_ACCOUNT = "00"
SOURCE_EXPRESS = "101"
SOURCE_PLATFORM = "104"
SOURCE_CROSSBORDER = "114"
SOURCE_MARKETPLACE = "756"
SOURCES_AREA_RATE = ("116", "801")
SOURCES_DESTINATION_RATE = ("803", "804")
SOURCE_WITHOUT_API_RATE = "813"
SOURCE_API_ALIAS = {"835": "829"}
CROSSBORDER_COD_CITY = "SIDOARJO"

# Names that rules compare with.
CARGO_EXPRESS = "iDtruck"
API_RATE_COLUMN = {"STD": "STD", "IDlite": "iDlite", "SMD": "SMD", "iDtruck": "iDtruck"}
SPECIAL_ACCOUNT = "PartnerB_SpecialService"
KEY_ACCOUNT_PORTAL = "Key Account Portal"
VIP_PORTAL = "VIP Customer Portal"
E_COMMERCE = "E-Commerce"
SOURCES_WITHOUT_API_COD = (
    "partner_c_legal_entity",
    "partner_d_legal_entity_1",
    "partner_d_legal_entity_2",
)
CATEGORY_SHORT_NAMES = {
    "Partner C Legal Entity": "PartnerC",
    "Partner D Legal Entity": "PartnerD",
}
ORIGIN_OUTSIDE = "Origin Non KR"
ORIGIN_INSIDE = "Origin KR"
FULL_SERVICE = "fm,mm,lm"
FIRST_MILE_ONLY = "fm"
MID_AND_LAST_MILE = "mm,lm"
POD_DELIVERY = "pod delivery"
POD_RETURN = "pod return"

# Thresholds, rates and start dates.
LITE_WEIGHT_BELOW = Decimal("0.51")
FREE_WEIGHT_UP_TO = Decimal("1.309")
WEIGHT_ROUNDING = Decimal("0.31")
EXPRESS_TAX = Decimal("0.011")
COD_RATE = Decimal("0.01")
VAT_RATE = Decimal("0.11")
MARKETPLACE_SCHEME_START = date(2025, 4, 1)
DROPSHIP_RULE_START = date(2024, 8, 1)
WALLET_HISTORY_START = date(2023, 7, 24)

# Branch prefixes and scan names of the mile classifier.
HUB_PREFIXES = ("MH", "DC", "HQ")
ARRIVAL_HUB_PREFIXES = ("MH", "DC")
STATION_PREFIXES = ("TH", "FB", "PD")
DELIVERY_PREFIXES = ("VH", "VT", "TH", "FB", "PD")
INBOUND_ORIGIN_PREFIXES = ("MH", "TH", "DC")
PICKUP_SCANS = ("Pick up scan", "Loading scan", "Packing scan", "Sending scan")
ARRIVAL_SCANS = (
    "Arrival scan",
    "Unloading scan",
    "Unpacking scan",
    "Delivery scan",
    "Create Return Bill",
    "Delivery Task Accept",
    "Collection",
)

# Order-journey event codes and partner types.
EVENT_HANDOVER = "61"
EVENT_PICKED_UP = "02"
EVENT_DISPATCHED = "04"
SUMMARY_EVENTS = ("61", "02", "04", "09")
JOURNEY_PARTNER_TYPES = ("A", "B", "C")

# Last day of each ageing bucket of unpaid virtual accounts. The label of
# 271-300 days starts at 270, as the finance team's reports have it.
AGEING_BUCKETS = (
    (0, "00NO_OD"),
    (7, "P001_007"),
    (30, "P008_030"),
    (60, "P031_060"),
    (90, "P061_090"),
    (120, "P091_120"),
    (150, "P121_150"),
    (180, "P151_180"),
    (210, "P181_210"),
    (240, "P211_240"),
    (270, "P241_270"),
    (300, "P270_300"),
)
AGEING_BEYOND = "P300_UP"
AGEING_PAID = "00NO_OD"

# Payment status of a virtual account.
VA_STATUS = {"0": "Not Paid", "1": "Paid", "2": "Expired"}
VA_PAID = "1"
VA_OPEN = ("0", "2")
