"""Sales data derived from the generated test tables: a typed view and raw, dirty source tables.

The select lists are plain SQL that Spark and DuckDB read alike; the reference SQL reuses them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleloom import schemas, vocab
from saleloom.plans.unify import derive_measures
from saleloom.operators.keys import INGEST
from saleloom.operators.work import freeze
from saleloom.plans.cleaning import ROW_ORDER
from saleloom.sources.files import size
from saleloom.sources.ingest import number_rows, placed
from saleloom.sources.readers import read_table, spread_small

# Which columns of the typed view need which join.
VIEW = {
    "doc_date": "o_orderdate",
    "year": "CAST(year(o_orderdate) AS INT)",
    "month": "CAST(month(o_orderdate) AS INT)",
    "quarter": "CAST(quarter(o_orderdate) AS INT)",
    "year_month": "substr(CAST(o_orderdate AS STRING), 1, 7)",
    "doc_no": "CAST(o_orderkey AS STRING)",
    "uom": "CASE l_linestatus WHEN 'O' THEN 'Kg' ELSE 'Bag' END",
    "quantity": "l_quantity",
    "weight_kg": "l_quantity * p_size",
    "unit_price": "l_extendedprice / l_quantity",
    "gross_sales": "l_extendedprice",
    "discount": "l_extendedprice * l_discount",
    "net_revenue": "l_extendedprice * (1 - l_discount)",
    "return_qty": "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END",
    "return_value": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END",
    "unit_cost": "CASE WHEN year(o_orderdate) <= 2000 THEN NULL WHEN p_type = 'PROMO' THEN 0.0 ELSE p_retailprice END",
    "total_cost": "CASE WHEN year(o_orderdate) <= 2000 THEN NULL WHEN p_type = 'PROMO' THEN 0.0"
    " ELSE p_retailprice * l_quantity END",
    "profit": "CASE WHEN year(o_orderdate) <= 2000 THEN l_extendedprice * 0.25 WHEN p_type = 'PROMO'"
    " THEN l_extendedprice * (1 - l_discount)"
    " ELSE l_extendedprice * (1 - l_discount) - p_retailprice * l_quantity END",
    "customer_code": "CAST(o_custkey AS STRING)",
    "customer_name": "CASE WHEN year(o_orderdate) <= 2000 THEN '" + vocab.NO_DATA + "' ELSE c_name END",
    "customer_group": "c_mktsegment",
    "product_code": "CAST(l_partkey AS STRING)",
    "product_name": "CASE WHEN year(o_orderdate) <= 2000 THEN '" + vocab.NO_DATA + "' ELSE p_name END",
    "product_group": "p_brand",
    "product_type": "p_type",
    "channel": "o_orderpriority",
    "branch": "s_name",
    "region": "r_name",
    "returned": "CASE WHEN l_returnflag = 'R' THEN '" + vocab.HAS_RETURN + "' ELSE '" + vocab.NO_RETURN + "' END",
    "period": "CASE WHEN year(o_orderdate) <= 2000 THEN '" + vocab.PERIOD_BEFORE + "' ELSE '" + vocab.PERIOD_AFTER + "' END",
    "data_source": "CASE WHEN year(o_orderdate) <= 2000 THEN '" + vocab.SOURCE_HISTORICAL + "' ELSE '" + vocab.SOURCE_CURRENT + "' END",
    "has_cost": "year(o_orderdate) > 2000 AND p_type <> 'PROMO'",
}

JOINS = {
    "orders": ("o_", "l_orderkey = o_orderkey"),
    "part": ("p_", "l_partkey = p_partkey"),
    "supplier": ("s_", "l_suppkey = s_suppkey"),
    "customer": ("c_", "o_custkey = c_custkey"),
    "nation": ("n_", "c_nationkey = n_nationkey"),
    "region": ("r_", "n_regionkey = r_regionkey"),
}
NEEDS = {"region": ("nation",), "nation": ("customer",), "customer": ("orders",)}

SMALL_LOOKUP_BYTES = 8 * 1024 * 1024  # stored bytes, compressed, up to which a table is broadcast to the lines or orders

PORTION_BYTES = 512 * 1024 * 1024  # stored bytes of lines that are joined at a time where the sources are stored in portions

# Measures that the view derives itself, with the columns they come from.
DERIVED_FROM = ("net_revenue", "profit", "quantity", "discount", "gross_sales", "return_value", "unit_cost", "total_cost")

_ISO = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_RAW_DATE = (
    f"CASE WHEN l_tax > 0.07 AND l_returnflag = 'N' THEN 'n/a'"
    f" WHEN o_orderstatus = 'P' THEN substr({_ISO}, 9, 2) || '/' || substr({_ISO}, 6, 2) || '/' || substr({_ISO}, 1, 4)"
    f" ELSE {_ISO} END"
)
_RAW_CHANNEL = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN '  HORECA' WHEN '2-HIGH' THEN 'Xuất   Khẩu '"
    " WHEN '3-MEDIUM' THEN 'KHÁC' WHEN '4-NOT SPECIFIED' THEN 'None' ELSE 'Siêu  thị' END"
)
_RAW_GROUP = (
    "CASE p_type WHEN 'ECONOMY' THEN 'HÒA TAN ' WHEN 'LARGE' THEN 'rang xay' WHEN 'MEDIUM' THEN 'Đồ   uống'"
    " WHEN 'PROMO' THEN 'khac' WHEN 'SMALL' THEN '' ELSE p_type END"
)
_RAW_CUSTOMER_GROUP = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ' Nhóm khách  hàng nội đia ' WHEN 'BUILDING' THEN 'RETAIL '"
    " WHEN 'FURNITURE' THEN 'f&b' WHEN 'HOUSEHOLD' THEN 'Export' ELSE c_mktsegment END"
)
_RAW_CUSTOMER = "CASE WHEN c_acctbal < 500 THEN '<NA>' ELSE ' ' || CAST(c_custkey AS STRING) END"
_RAW_GROSS = "CASE WHEN l_linenumber = 7 THEN '1,234' ELSE ' ' || CAST(l_extendedprice AS STRING) END"

# A range on the stored column, so that the scan can skip row groups.
HISTORY = "o_orderdate < TIMESTAMP '2001-01-01 00:00:00'"

# Lines that were sent twice: the copies are full-row duplicates.
SENT_TWICE = "l_returnflag = 'R' AND l_linenumber = 1"

RAW_HISTORICAL = {
    "doc_date": _RAW_DATE,
    "doc_no": "'  ' || CAST(o_orderkey AS STRING) || ' '",
    "uom": "CASE l_linestatus WHEN 'O' THEN 'Kg' ELSE 'nan' END",
    "conversion": "CAST(p_size AS STRING)",
    "weight_kg": "CAST(l_quantity * p_size AS STRING)",
    "quantity": "CAST(CAST(l_quantity AS INT) AS STRING) || ' '",
    "unit_price": "l_extendedprice / l_quantity",
    "gross_sales": _RAW_GROSS,
    "discount": "l_extendedprice * l_discount",
    "net_revenue": "l_extendedprice * (1 - l_discount)",
    "customer_group": _RAW_CUSTOMER_GROUP,
    "month": "'99'",
    "customer_code": _RAW_CUSTOMER,
    "product_code": "CAST(p_partkey AS STRING)",
    "channel": _RAW_CHANNEL,
    "product_group": _RAW_GROUP,
    "returned": "CASE l_returnflag WHEN 'R' THEN 'YES' WHEN 'A' THEN 'Không' END",
    "profit": "CASE WHEN l_linenumber = 6 THEN 'lost' ELSE CAST(l_extendedprice * 0.25 AS STRING) END",
    "source_sheet": "'sheet ' || CAST(year(o_orderdate) AS STRING)",
}

RAW_CURRENT = {
    "doc_date": _RAW_DATE,
    "doc_no": "CAST(o_orderkey AS STRING)",
    "uom": "'Kg'",
    "quantity": "l_quantity",
    "unit_price": "l_extendedprice / l_quantity",
    "gross_sales": _RAW_GROSS,
    "discount": "l_extendedprice * l_discount",
    "net_revenue": "l_extendedprice * (1 - l_discount)",
    "return_qty": "CASE WHEN l_returnflag = 'R' THEN l_quantity END",
    "return_value": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice END",
    "channel": _RAW_CHANNEL,
    "conversion": "CAST(p_size AS STRING)",
    "branch": "s_name",
    "region": "r_name",
    "weight_kg": "l_quantity * p_size",
    "product_code": "CASE WHEN p_size = 50 THEN 'None' ELSE CAST(p_partkey AS STRING) END",
    "product_name": "CASE WHEN l_returnflag = 'A' THEN '' ELSE p_name END",
    "product_group": _RAW_GROUP,
    "product_type": "CASE WHEN l_linestatus = 'O' THEN 'nan' ELSE p_type END",
    "customer_code": _RAW_CUSTOMER,
    "customer_name": "c_name",
    "customer_group": _RAW_CUSTOMER_GROUP,
}

# Promotion parts have no agreed cost. Large parts are listed without a code. Every part appears with an
# old and a new cost; the higher row order is the newer one.
RAW_COST = {
    "product_code": "CASE WHEN p_size = 50 THEN '' ELSE ' ' || CAST(p_partkey AS STRING) END",
    "std_group": _RAW_GROUP,
    "std_type": "p_type",
    "std_name": "'Part ' || CAST(p_partkey AS STRING)",
    "list_price": "CAST(p_retailprice * 2 AS STRING)",
    "unit_cost": "CASE WHEN version = 1 THEN 'old' WHEN p_size = 49 THEN 'n/a' ELSE CAST(p_retailprice AS STRING) END",
    "row_order": "p_partkey * 2 + version",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _needed(sql: Iterable[str]) -> list[str]:
    text = " ".join(sql)
    wanted = {t for t, (prefix, _) in JOINS.items() if f" {prefix}" in f" {text.replace('(', ' ')}"}
    for table in ("region", "nation", "customer"):
        if table in wanted:
            wanted.update(NEEDS[table])
    return [t for t in JOINS if t in wanted]


def _small(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table to look up in; broadcast if it is small where it is stored."""
    df = read(spark, folder, table)
    return F.broadcast(df) if size(spark, f"{folder}/{table}.parquet") <= SMALL_LOOKUP_BYTES else df


def _lines(
    spark: SparkSession, folder: str, sql: Iterable[str], spread: bool = False, ingest: bool = False, where: str | None = None,
    portion: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Line items joined to just the tables that the select list mentions; ``ingest`` numbers them in file order.

    Orders meet customers, nations and regions before the lines meet them, so that lines are shuffled for orders and parts
    alone. With a condition ``where`` on the orders these come first, else the parts, whose columns are narrower.
    ``portion`` (n, of) takes the n-th of so many portions of the orders, with their lines.
    """
    path = f"{folder}/lineitem.parquet"
    lines = number_rows(placed(read_table(spark, path, row_order=True), ROW_ORDER)) if ingest else read(spark, folder, "lineitem")
    if spread:
        lines = spread_small(lines, path)
    needed = _needed([*sql, *([where] if where else [])])
    orders = read(spark, folder, "orders").where(where) if where else read(spark, folder, "orders")
    if portion[1] > 1:
        lines, orders = (df.where(f"pmod(xxhash64(CAST({k} AS LONG)), {portion[1]}) = {portion[0]}") for df, k in ((lines, "l_orderkey"), (orders, "o_orderkey")))
    for table in ("customer", "nation", "region"):
        if table in needed:
            left, right = JOINS[table][1].split(" = ")
            orders = orders.join(other := _small(spark, folder, table), orders[left] == other[right])
    # The supplier, the smallest of the others, is last: its columns are in no other shuffle.
    for table in ("orders", "part", "supplier") if where else ("part", "orders", "supplier"):
        if table in needed:
            left, right = JOINS[table][1].split(" = ")
            other = orders if table == "orders" else _small(spark, folder, table)
            lines = lines.join(other, lines[left] == other[right])
    return lines


def sales_view(spark: SparkSession, folder: str, columns: Iterable[str], spread: bool = False, ingest: bool = False) -> DataFrame:
    """The typed sales table with the wanted columns; only the joins they need are planned.

    ``spread`` distributes a small input over all cores, for queries with much work per row. ``ingest`` adds the
    position of every line in its file.
    """
    wanted = list(columns)
    derived = {"margin", "discount_rate", "return_rate", "avg_row_value", "profit_recomputed"}
    costs = {"unit_cost", "total_cost"}
    base = [c for c in VIEW if c in wanted]
    if derived.intersection(wanted) or costs.intersection(wanted):
        base = [c for c in VIEW if c in wanted or c in DERIVED_FROM]
    sql = [f"{VIEW[c]} AS {c}" for c in base]
    position = [INGEST] if ingest else []
    view = _lines(spark, folder, sql, spread, ingest).selectExpr(*sql, *position)
    if len(base) != len(wanted) or costs.intersection(wanted):
        view = derive_measures(view)
    return view.select(*wanted, *position)


# A copy stands right behind its line.
COPY_POSITION = (f"{INGEST} * 2 + copy - 1 AS {INGEST}",)


def _twice(lines: DataFrame) -> DataFrame:
    return lines.selectExpr("*", f"explode(sequence(1, CASE WHEN {SENT_TWICE} THEN 2 ELSE 1 END)) AS copy")


def raw_historical(
    spark: SparkSession, folder: str, columns: Iterable[str] | None = None, ingest: bool = False, portion: tuple[int, int] = (0, 1),
    stored: DataFrame | None = None,
) -> DataFrame:
    names = list(columns or schemas.columns(schemas.HISTORICAL))
    sql = [f"{RAW_HISTORICAL[c]} AS {c}" for c in names]
    if stored is not None:
        return _twice(_of_stored(spark, folder, stored, sql, HISTORY)).selectExpr(*sql)
    lines = _lines(spark, folder, sql, spread=True, ingest=ingest, where=HISTORY, portion=portion)
    return _twice(lines).selectExpr(*sql, *(COPY_POSITION if ingest else ()))


def raw_current(
    spark: SparkSession, folder: str, columns: Iterable[str] | None = None, ingest: bool = False, portion: tuple[int, int] = (0, 1),
    stored: DataFrame | None = None,
) -> DataFrame:
    names = list(columns or schemas.columns(schemas.CURRENT))
    sql = [f"{RAW_CURRENT[c]} AS {c}" for c in names]
    if stored is not None:
        return _twice(_of_stored(spark, folder, stored, sql, f"NOT ({HISTORY})")).selectExpr(*sql)
    lines = _lines(spark, folder, sql, spread=True, ingest=ingest, where=f"NOT ({HISTORY})", portion=portion)
    return _twice(lines).selectExpr(*sql, *(COPY_POSITION if ingest else ()))


def portions(spark: SparkSession, folder: str) -> Iterator[tuple[int, int]]:
    """The portions of orders in which the lines are joined, of ``PORTION_BYTES`` of stored lines each; one if these are few."""
    count = max(1, math.ceil(size(spark, f"{folder}/lineitem.parquet") / PORTION_BYTES))
    return ((n, count) for n in range(count))


def stored_lines(spark: SparkSession, folder: str, portion: tuple[int, int]) -> DataFrame:
    """One portion of the lines, stored with all columns that the raw sources take of lines, orders, customers and parts.

    Both sources join these tables, so that both are made of it. What the current one alone takes is stored for its lines alone.
    """
    of = [set(re.findall(r"\b[locp]_\w+", " ".join([*raw.values(), HISTORY, SENT_TWICE]))) for raw in (RAW_HISTORICAL, RAW_CURRENT)]
    of[1] |= {"l_suppkey", "c_nationkey"}
    sql = [c if c in of[0] else f"CASE WHEN NOT ({HISTORY}) THEN {c} END AS {c}" for c in sorted(of[0] | of[1])]
    # Without a condition orders come last: lines of one order lie together, which stores their common columns in few bytes.
    return freeze(_lines(spark, folder, sql, portion=portion).where("o_orderdate IS NOT NULL").selectExpr(*sql), "lines", compact=True)


def _of_stored(spark: SparkSession, folder: str, lines: DataFrame, sql: Iterable[str], where: str) -> DataFrame:
    """The lines of one source out of ``stored_lines``, joined to the tables that these do not hold."""
    lines = lines.where(where)
    for table in ("nation", "region", "supplier"):
        if table in _needed(sql):
            left, right = JOINS[table][1].split(" = ")
            lines = lines.join(other := _small(spark, folder, table), lines[left] == other[right])
    return lines


def raw_cost(spark: SparkSession, folder: str) -> DataFrame:
    parts = read(spark, folder, "part").where("p_type <> 'PROMO'").selectExpr("*", "explode(array(1, 2)) AS version")
    return parts.selectExpr(*[f"{sql} AS {c}" for c, sql in RAW_COST.items()])
