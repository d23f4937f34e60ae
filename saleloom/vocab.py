"""Label vocabularies. All are parameters of the cleaning plans; these are the defaults."""

# Match key -> canonical label. Keys are compared accent-free and in lower case.
CHANNELS = {
    "khac": "Khác",
    "xuat khau": "Xuất khẩu",
    "quan noi bo": "Quán nội bộ",
    "online": "Online",
    "mt": "MT",
    "gt": "GT",
    "horeca": "HORECA",
    "oem": "OEM",
}

PRODUCT_GROUPS = {
    "hoa tan": "Hòa tan",
    "rang xay": "Rang xay",
    "do uong": "Đồ uống",
    "khac": "Khác",
}

CUSTOMER_GROUPS = {
    "nhom khach hang noi dia": "Nhóm khách hàng nội địa",
    "internal": "Internal",
    "online": "Online",
    "f&b": "F&B",
    "distributor": "Distributor",
    "corporate": "Corporate",
    "airport": "Airport",
    "retail": "Retail",
    "export": "Export",
    "oem": "OEM",
}

RETURNED = {
    "no": "Không",
    "khong": "Không",
    "yes": "Có",
    "co": "Có",
}

# Labels written where a text column is null.
UNKNOWN = "Không xác định"
NO_DATA = "Không có dữ liệu"
NOT_APPLICABLE = "Không áp dụng"
NO_RETURN = "Không"
HAS_RETURN = "Có"

LABEL_DEFAULTS = {
    "doc_no": UNKNOWN,
    "uom": UNKNOWN,
    "customer_code": UNKNOWN,
    "customer_name": NO_DATA,
    "customer_group": UNKNOWN,
    "product_code": UNKNOWN,
    "product_name": NO_DATA,
    "product_group": UNKNOWN,
    "product_type": NO_DATA,
    "channel": UNKNOWN,
    "branch": NOT_APPLICABLE,
    "region": NOT_APPLICABLE,
    "returned": NO_RETURN,
    "period": UNKNOWN,
    "data_source": UNKNOWN,
}

# Provenance and report labels.
PERIOD_BEFORE = "Trước tái cấu trúc"
PERIOD_AFTER = "Sau tái cấu trúc"
SOURCE_HISTORICAL = "2023-2025"
SOURCE_CURRENT = "2026"
MONTH_PREFIX = "Tháng "
PARETO_TOP = "Top 80%"
PARETO_REST = "Còn lại"
OUTLIER_ALL = "Toan bo"
OUTLIER_NORMAL = "Binh thuong"
OUTLIER_LOW = "Thap bat thuong"
OUTLIER_HIGH = "Cao bat thuong"
STATE_NORMAL = "Bình thường"
STATE_OUTLIER = "Bất thường"
