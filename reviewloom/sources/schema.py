"""The declared review schema and the known corrupt products."""

from __future__ import annotations

# Column names and types of a review file, in file order.
REVIEW_SCHEMA = """
    product_id string,
    product_name string,
    category string,
    discounted_price string,
    actual_price string,
    discount_percentage string,
    rating double,
    rating_count string,
    about_product string,
    user_id string,
    user_name string,
    review_id string,
    review_title string,
    review_content string,
    img_link string,
    product_link string
"""

REVIEW_COLUMNS = tuple(field.split()[0] for field in REVIEW_SCHEMA.split(","))

# Products whose rows were found damaged in the original file,
# as listed there (59 entries, 52 different ids).
CORRUPT_PRODUCT_IDS = (
    "B088Z1YWBC", "B0BLV1GNLN", "B0BF57RN3K", "B0B5LVS732", "B09V12K8NT",
    "B09NVPSCQT", "B0BF54972T", "B0BF563HB4", "B0BF4YBLPX", "B0B3N7LR6K",
    "B09ZQK9X8G", "B0BF54LXW6", "B09PNKXSKF", "B07WDKLRM4", "B0BP18W8TM",
    "B07WHQWXL7", "B09FKDH6FS", "B07WGPKTS4", "B097R25DP7", "B09V17S2BG",
    "B0BNV7JM5Y", "B0B53QFZPY", "B07WGPKMP5", "B09PLFJ7ZW", "B0B53NXFFR",
    "B0949SBKMP", "B0B53QLB9H", "B0BMVWKZ8G", "B0B5GF6DQD", "B09YV463SW",
    "B0BNVBJW2S", "B09BNXQ6BR", "B0B2X35B1K", "B09YV42QHZ", "B09NVPJ3P4",
    "B0B3NDPCS9", "B0BNXFDTZ2", "B0B5LVS732", "B09V12K8NT", "B09NVPSCQT",
    "B0B3N7LR6K", "B09ZQK9X8G", "B08MCD9JFY", "B097R25DP7", "B09P18XVW6",
    "B07Z1X6VFC", "B0949SBKMP", "B07Z1YVP72", "B08JMC1988", "B00N1U7JXM",
    "B09RKFBCV7", "B07Z53L5QL", "B09NC2TY11", "B08KRMK9LZ", "B094JB13XL",
    "B07Z1Z77ZZ", "B09939XJX8", "B0B2RBP83P", "B08S74GTBT",
)
