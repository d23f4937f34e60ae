"""Table layouts: business column name, canonical name and Spark type of every table.

The engine works on canonical snake_case names. ``to_canonical`` renames a raw table on the way in
and ``to_business`` restores the business names on the way out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STR, DBL, INT, LONG, BOOL, TS = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)

# Business column names of the source and result tables, in table order.
HISTORICAL = [
    ("Ngày chứng từ", "doc_date", TS),
    ("Số chứng từ", "doc_no", STR),
    ("ĐVT", "uom", STR),
    ("Quy đổi", "conversion", DBL),
    ("Số lượng (KG )", "weight_kg", DBL),
    ("Số lượng", "quantity", DBL),
    ("Giá bán", "unit_price", DBL),
    ("Doanh số", "gross_sales", DBL),
    ("Chiết khấu", "discount", DBL),
    ("Doanh thu thuần", "net_revenue", DBL),
    ("Tên nhóm KH1", "customer_group", STR),
    ("Tháng", "month", DBL),
    ("Mã khách hàng", "customer_code", STR),
    ("Mã sản phẩm", "product_code", STR),
    ("Kênh", "channel", STR),
    ("Nhóm sp", "product_group", STR),
    ("Trả hàng", "returned", STR),
    ("Lợi nhuận", "profit", DBL),
    ("Nguồn sheet", "source_sheet", STR),
]

CURRENT = [
    ("Ngày chứng từ", "doc_date", TS),
    ("Số chứng từ", "doc_no", STR),
    ("ĐVT", "uom", STR),
    ("Tổng số lượng bán", "quantity", DBL),
    ("Đơn Giá Chuẩn", "unit_price", DBL),
    ("Doanh số bán", "gross_sales", DBL),
    ("Chiết khấu", "discount", DBL),
    ("Doanh thu thuần", "net_revenue", DBL),
    ("Tổng số lượng trả lại", "return_qty", DBL),
    ("Giá trị trả lại", "return_value", DBL),
    ("Kênh", "channel", STR),
    ("Tỷ lệ chuyển đổi", "conversion", DBL),
    ("Chi nhánh", "branch", STR),
    ("Vùng doanh thu", "region", STR),
    ("Khối lượng", "weight_kg", DBL),
    ("Mã sản phẩm", "product_code", STR),
    ("Tên sản phẩm", "product_name", STR),
    ("Nhóm sản phẩm", "product_group", STR),
    ("Loại sản phẩm", "product_type", STR),
    ("Mã khách hàng2", "customer_code", STR),
    ("Tên khách hàng2", "customer_name", STR),
    ("Nhóm khách hàng", "customer_group", STR),
]

COST = [
    ("Mã Sản phẩm", "product_code", STR),
    ("Nhóm SP Chuẩn", "std_group", STR),
    ("Loại SP Chuẩn", "std_type", STR),
    ("Tên SP Mới", "std_name", STR),
    ("Giá bán lẻ", "list_price", DBL),
    ("Giá vốn", "unit_cost", DBL),
]

SALES = [
    ("Ngày chứng từ", "doc_date", TS),
    ("Năm", "year", INT),
    ("Tháng", "month", INT),
    ("Quý", "quarter", INT),
    ("Năm-Tháng", "year_month", STR),
    ("Số chứng từ", "doc_no", STR),
    ("ĐVT", "uom", STR),
    ("Số lượng", "quantity", DBL),
    ("Khối lượng KG", "weight_kg", DBL),
    ("Đơn giá", "unit_price", DBL),
    ("Doanh số", "gross_sales", DBL),
    ("Chiết khấu", "discount", DBL),
    ("Doanh thu thuần", "net_revenue", DBL),
    ("Số lượng trả lại", "return_qty", DBL),
    ("Giá trị trả lại", "return_value", DBL),
    ("Giá vốn đơn vị", "unit_cost", DBL),
    ("Tổng giá vốn", "total_cost", DBL),
    ("Lợi nhuận", "profit", DBL),
    ("Lợi nhuận tính lại", "profit_recomputed", DBL),
    ("Mã khách hàng", "customer_code", STR),
    ("Tên khách hàng", "customer_name", STR),
    ("Nhóm khách hàng", "customer_group", STR),
    ("Mã sản phẩm", "product_code", STR),
    ("Tên sản phẩm", "product_name", STR),
    ("Nhóm sản phẩm", "product_group", STR),
    ("Loại sản phẩm", "product_type", STR),
    ("Kênh", "channel", STR),
    ("Chi nhánh", "branch", STR),
    ("Vùng doanh thu", "region", STR),
    ("Trả hàng", "returned", STR),
    ("Giai đoạn", "period", STR),
    ("Nguồn dữ liệu", "data_source", STR),
    ("Có dữ liệu giá vốn", "has_cost", BOOL),
    ("Cờ duplicate", "is_duplicate", BOOL),
    ("Biên lợi nhuận", "margin", DBL),
    ("Tỷ lệ chiết khấu", "discount_rate", DBL),
    ("Tỷ lệ hoàn trả", "return_rate", DBL),
    ("Giá trị TB/dòng", "avg_row_value", DBL),
]

# Columns that exist only in lookups, marts and reports.
RESULT_ONLY = [
    ("Nhóm sản phẩm chuẩn", "std_group", STR),
    ("Loại sản phẩm chuẩn", "std_type", STR),
    ("Tên sản phẩm chuẩn", "std_name", STR),
    ("Giá bán lẻ", "list_price", DBL),
    ("Tên tháng", "month_name", STR),
    ("Số đơn hàng", "orders", LONG),
    ("Số khách hàng", "customers", LONG),
    ("Số sản phẩm", "products", LONG),
    ("Giá trị TB/đơn", "avg_order_value", DBL),
    ("Tỷ trọng doanh thu", "revenue_share", DBL),
    ("Tỷ trọng lũy kế", "cumulative_share", DBL),
    ("Nhóm Pareto", "pareto_class", STR),
    ("Bảng", "table_name", STR),
    ("Số dòng", "row_count", LONG),
    ("Số cột", "column_count", INT),
    ("Số ô null", "null_cells", LONG),
    ("Số dòng duplicate toàn dòng", "duplicate_rows", LONG),
    ("Số dòng duplicate theo cờ", "flagged_duplicates", LONG),
    ("Nguồn sheet", "source_sheet", STR),
    ("Quy đổi", "conversion", DBL),
]

# Names that differ between the source tables and the unified table.
SOURCE_NAMES = {
    "historical": {canonical: business for business, canonical, _ in HISTORICAL},
    "current": {canonical: business for business, canonical, _ in CURRENT},
    "cost": {canonical: business for business, canonical, _ in COST},
}
UNIFIED_NAMES = {canonical: business for business, canonical, _ in SALES + RESULT_ONLY}


def columns(layout) -> list[str]:
    return [canonical for _, canonical, _ in layout]


def types(layout) -> dict[str, T.DataType]:
    return {canonical: dtype for _, canonical, dtype in layout}


def names_of_type(layout, dtype: T.DataType) -> list[str]:
    return [canonical for _, canonical, t in layout if t == dtype]


def struct(layout) -> T.StructType:
    return T.StructType([T.StructField(canonical, dtype) for _, canonical, dtype in layout])


def to_canonical(df: DataFrame, layout) -> DataFrame:
    """Rename the business columns of one source table; names already canonical stay."""
    return df.withColumnsRenamed({business: canonical for business, canonical, _ in layout})


def to_business(df: DataFrame, source: str | None = None) -> DataFrame:
    """Restore the business column names (``source`` picks a raw table's own spelling)."""
    names = {**UNIFIED_NAMES, **(SOURCE_NAMES[source] if source else {})}
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names})
