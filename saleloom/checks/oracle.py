"""Reference SQL of the named queries, written for DuckDB over the same tables.

It shares only the derivation of the raw test data with the engine; every operator is restated in SQL.
"""

from __future__ import annotations

from saleloom import schemas, vocab
from saleloom.checks import tables
from saleloom.checks.queries import PARETO_COLUMNS
from saleloom.operators import forecast as fc
from saleloom.operators import kpi, outliers, star

ORACLE: dict[str, str] = {}

ALL_JOINS = "lineitem " + " ".join(f"JOIN {t} ON {on}" for t, (_, on) in tables.JOINS.items())
# Every line with its position in the file, under the name of the table.
NUMBERED = ALL_JOINS.replace("lineitem ", "(SELECT *, row_number() OVER () - 1 AS line FROM lineitem) lineitem ", 1)
COPIES = f"JOIN (VALUES (1), (2)) copies(copy) ON copy = 1 OR ({tables.SENT_TWICE})"
WHITESPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]+"


def rnd(sql: str, digits: int, name: str | None = None) -> str:
    return f"round(CAST({sql} AS DOUBLE), {digits}) AS {name or sql}"


def columns_of(mapping, names=None) -> str:
    return ", ".join(f"{mapping[c]} AS {c}" for c in (names or mapping))


def exact(sql: str) -> str:
    return f"coalesce(sum(CAST({sql} AS DECIMAL(18, 6))), 0)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


# Scalar functions in SQL


def squeeze(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '{WHITESPACE}', ' ', 'g'))"


def clean(sql: str) -> str:
    s = squeeze(sql)
    return f"CASE WHEN {s} NOT IN ('', 'nan', 'None', '<NA>') THEN {s} END"


def key(sql: str) -> str:
    return f"lower(replace(replace(strip_accents({squeeze(sql)}), 'đ', 'd'), 'Đ', 'D'))"


def label(sql: str, vocabulary) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocabulary.items())
    return f"CASE WHEN ({clean(sql)}) IS NULL THEN NULL ELSE CASE {key(sql)} {whens} ELSE {clean(sql)} END END"


def number(sql: str) -> str:
    return f"coalesce(TRY_CAST(trim(CAST({sql} AS STRING)) AS DOUBLE), 0)"


def date(sql: str) -> str:
    return f"coalesce(try_strptime({sql}, '%Y-%m-%d'), try_strptime({sql}, '%d/%m/%Y'))"


# Common tables


def view() -> str:
    """The typed sales view with back-filled cost and row ratios."""
    backfilled = {"total_cost", "unit_cost"}
    base = [c for c in tables.VIEW if c not in backfilled]
    return f"""
    v0 AS (SELECT {columns_of(tables.VIEW)} FROM {ALL_JOINS}),
    v1 AS (SELECT {", ".join(base)}, unit_cost AS given_cost, coalesce(total_cost, net_revenue - profit) AS total_cost FROM v0),
    v AS (SELECT *, coalesce(given_cost, {div("total_cost", "quantity")}) AS unit_cost,
        {div("profit", "net_revenue")} AS margin, {div("discount", "gross_sales")} AS discount_rate,
        {div("return_value", "gross_sales")} AS return_rate, net_revenue AS avg_row_value FROM v1)"""


VIEW = view()

VOCABULARIES = {
    "channel": vocab.CHANNELS,
    "product_group": vocab.PRODUCT_GROUPS,
    "customer_group": vocab.CUSTOMER_GROUPS,
    "returned": vocab.RETURNED,
    "std_group": vocab.PRODUCT_GROUPS,
}


def raw_table(mapping, where: str) -> str:
    return f"SELECT {columns_of(mapping)} FROM {ALL_JOINS} {COPIES} WHERE {where}"


RAW = f"""
    raw_h AS ({raw_table(tables.RAW_HISTORICAL, tables.HISTORY)}),
    raw_c AS ({raw_table(tables.RAW_CURRENT, f"NOT ({tables.HISTORY})")}),
    raw_k AS (SELECT {columns_of(tables.RAW_COST)} FROM part CROSS JOIN (VALUES (1), (2)) versions(version)
        WHERE p_type <> 'PROMO')"""


def cleaned(layout, source: str, extra: str = "", skip=()) -> str:
    out = []
    for _, name, dtype in layout:
        if name in skip:
            continue
        if dtype == schemas.DBL:
            sql = number(name)
        elif dtype == schemas.TS:
            sql = date(name)
        elif name in VOCABULARIES:
            sql = label(name, VOCABULARIES[name])
        else:
            sql = clean(name)
        out.append(f"{sql} AS {name}")
    return f"SELECT {', '.join(out)}{extra} FROM {source}"


DATE_PARTS = (
    "CAST(year(doc_date) AS INTEGER) AS year, CAST(month(doc_date) AS INTEGER) AS month,"
    " CAST(quarter(doc_date) AS INTEGER) AS quarter, strftime(doc_date, '%Y-%m') AS year_month"
)

HIST_COLUMNS = [c for c in schemas.columns(schemas.HISTORICAL) if c != "month"]
CURRENT_COLUMNS = schemas.columns(schemas.CURRENT)

CLEANED = f"""{RAW},
    h0 AS ({cleaned(schemas.HISTORICAL, "raw_h", skip=("month",))}),
    h1 AS (SELECT *, {DATE_PARTS}, '{vocab.PERIOD_BEFORE}' AS period, '{vocab.SOURCE_HISTORICAL}' AS data_source,
        CAST(NULL AS DOUBLE) AS unit_cost, CAST(NULL AS DOUBLE) AS total_cost, profit AS profit_recomputed,
        FALSE AS has_cost FROM h0),
    h AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(HIST_COLUMNS)}) > 1 AS is_duplicate FROM h1),
    k0 AS ({cleaned(schemas.COST, "raw_k", ", row_order")}),
    k AS (SELECT * EXCLUDE (row_order) FROM k0
        QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY row_order DESC) = 1),
    c0 AS ({cleaned(schemas.CURRENT, "raw_c")}),
    c1 AS (SELECT c0.*, {DATE_PARTS}, k.std_group, k.std_type, k.std_name, k.list_price,
        coalesce(k.unit_cost, 0) AS unit_cost FROM c0 LEFT JOIN k ON c0.product_code IS NOT DISTINCT FROM k.product_code),
    c2 AS (SELECT *, unit_cost * quantity AS total_cost FROM c1),
    c3 AS (SELECT *, net_revenue - total_cost AS profit_recomputed, net_revenue - total_cost AS profit,
        unit_cost > 0 AS has_cost, CASE WHEN return_value > 0 THEN '{vocab.HAS_RETURN}' ELSE '{vocab.NO_RETURN}' END AS returned,
        '{vocab.PERIOD_AFTER}' AS period, '{vocab.SOURCE_CURRENT}' AS data_source FROM c2),
    c AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(CURRENT_COLUMNS)}) > 1 AS is_duplicate FROM c3)"""


def _aligned(source: str, own: dict[str, str]) -> str:
    present = own.get
    names = [c for c in schemas.columns(schemas.SALES) if c not in ("margin", "discount_rate", "return_rate", "avg_row_value")]
    return f"SELECT {', '.join(f'{present(c, c)} AS {c}' for c in names)} FROM {source}"


_NULL_TEXT = "CAST(NULL AS STRING)"
ALIGNED_H = _aligned(
    "h",
    {
        "return_qty": "CAST(0 AS DOUBLE)",
        "return_value": "CAST(0 AS DOUBLE)",
        **dict.fromkeys(("customer_name", "product_name", "product_type", "branch", "region"), _NULL_TEXT),
    },
)
ALIGNED_C = _aligned(
    "c",
    {
        "product_name": "coalesce(product_name, std_name)",
        "product_group": "coalesce(product_group, std_group)",
        "product_type": "coalesce(product_type, std_type)",
    },
)


def _filled(source: str) -> str:
    names = [c for c in schemas.columns(schemas.SALES) if c not in ("margin", "discount_rate", "return_rate", "avg_row_value")]
    out = [f"coalesce({c}, '{vocab.LABEL_DEFAULTS[c]}') AS {c}" if c in vocab.LABEL_DEFAULTS else c for c in names]
    return f"SELECT {', '.join(out)} FROM {source}"


UNIFIED = f"""{CLEANED},
    u0 AS ({ALIGNED_H} UNION ALL {ALIGNED_C}),
    u1 AS ({_filled("u0")}),
    u2 AS (SELECT * EXCLUDE (total_cost, unit_cost, profit_recomputed), unit_cost AS given_cost,
        coalesce(total_cost, net_revenue - profit) AS total_cost FROM u1),
    u AS (SELECT * EXCLUDE (given_cost), coalesce(given_cost, {div("total_cost", "quantity")}) AS unit_cost,
        coalesce(net_revenue - total_cost, profit) AS profit_recomputed,
        {div("profit", "net_revenue")} AS margin, {div("discount", "gross_sales")} AS discount_rate,
        {div("return_value", "gross_sales")} AS return_rate, net_revenue AS avg_row_value FROM u2)"""


# Sources, scalar functions

ORACLE["source_union_tagged"] = """
    SELECT o_orderkey AS doc_no, o_totalprice AS gross_sales, CAST(NULL AS STRING) AS channel, '1995-1997' AS source_sheet
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderpriority, '1998-2001' FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"""

_PADDED = "'  ' || regexp_replace(text, ' ', '   ', 'g') || chr(10)"
ORACLE["clean_text_documents"] = f"""
    SELECT doc_id, {clean(_PADDED)} AS text, {clean("CASE WHEN lang = 'de' THEN 'nan' ELSE ' ' || lang END")} AS lang
    FROM documents"""

ORACLE["accent_key"] = f"SELECT doc_id, {key("' Đồ  uống đặc biệt ' || text")} AS key FROM documents"

ORACLE["vocab_map"] = f"""
    WITH {RAW} SELECT {", ".join(f"{label(c, VOCABULARIES[c])} AS {c}" for c in ("channel", "product_group", "customer_group", "returned"))},
        count(*) AS row_count FROM raw_h GROUP BY 1, 2, 3, 4"""

_FILL = ("channel", "product_name", "product_type", "customer_code")
ORACLE["label_defaults"] = f"""
    WITH {RAW} SELECT {", ".join(f"coalesce({clean(c)}, '{vocab.LABEL_DEFAULTS[c]}') AS {c}" for c in _FILL)},
        count(*) AS row_count FROM raw_c GROUP BY 1, 2, 3, 4"""

ORACLE["parse_numbers"] = f"""
    WITH {RAW} SELECT doc_no, product_code, {", ".join(f"{number(c)} AS {c}" for c in ("gross_sales", "quantity", "profit"))} FROM raw_h
    UNION ALL SELECT doc_no, product_code, {number("gross_sales")}, {number("quantity")}, 0 FROM raw_c"""

ORACLE["parse_dates"] = f"WITH {RAW} SELECT {date('doc_date')} AS doc_date, count(*) AS row_count FROM (SELECT doc_date FROM raw_h UNION ALL SELECT doc_date FROM raw_c) GROUP BY 1"

_ISO_DAY = "try_strptime(doc_date, '%Y-%m-%d')"
_SLASHED = "try_strptime(doc_date, '%d/%m/%Y')"
ORACLE["date_election"] = f"""
    WITH {RAW}, r AS (SELECT doc_date FROM raw_h UNION ALL SELECT doc_date FROM raw_c),
    d AS (SELECT doc_date, day({_ISO_DAY}) AS d, day({_SLASHED}) AS s FROM r)
    SELECT 'doc_date' AS column_name, count(doc_date) AS texts, count(*) FILTER (WHERE s > 12) AS only_day_first, CAST(0 AS BIGINT) AS only_month_first,
        count(*) FILTER (WHERE s <= 12) AS either, count(*) FILTER (WHERE doc_date IS NOT NULL AND d IS NULL AND s IS NULL) AS rejected, TRUE AS day_first FROM d
    UNION ALL SELECT 'month_first', count(d), 0, count(*) FILTER (WHERE d > 12), count(*) FILTER (WHERE d <= 12), 0, FALSE FROM d
    UNION ALL SELECT 'day_first', count(d), count(*) FILTER (WHERE d > 12), 0, count(*) FILTER (WHERE d <= 12), 0, TRUE FROM d"""

ORACLE["date_columns"] = f"""
    SELECT o_orderkey AS doc_no, {DATE_PARTS.replace("doc_date", "o_orderdate")},
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
        '{vocab.MONTH_PREFIX}' || CAST(month(o_orderdate) AS STRING) AS month_name,
        strftime(o_orderdate, '%Y-%m') AS period_key FROM orders"""

# Cleaning, enrichment, unification

ORACLE["cost_latest"] = f"WITH {CLEANED} SELECT * FROM k"

ORACLE["cost_enrichment"] = f"""
    WITH {CLEANED} SELECT doc_no, product_code, quantity, net_revenue, std_name, list_price, unit_cost,
        total_cost, profit, profit_recomputed, has_cost, returned FROM c"""

ORACLE["cost_match_rate"] = f"WITH {CLEANED} SELECT {rnd('avg(CASE WHEN has_cost THEN 1.0 ELSE 0.0 END)', 8, 'match_rate')} FROM c"

ORACLE["unified_sales"] = f"WITH {UNIFIED} SELECT {', '.join(schemas.columns(schemas.SALES))} FROM u"

ORACLE["ingest_positions"] = f"""
    WITH raw_h AS (SELECT {columns_of(tables.RAW_HISTORICAL)}, line * 2 + copy - 1 AS place FROM {NUMBERED} {COPIES} WHERE {tables.HISTORY}),
    raw_c AS (SELECT {columns_of(tables.RAW_CURRENT)}, line * 2 + copy - 1 AS place FROM {NUMBERED} {COPIES} WHERE NOT ({tables.HISTORY})),
    h AS ({cleaned(schemas.HISTORICAL, "raw_h", ", place", skip=("month",))}),
    c AS ({cleaned(schemas.CURRENT, "raw_c", ", place")})
    SELECT place AS ingest_order, doc_no, coalesce(product_code, '{vocab.LABEL_DEFAULTS["product_code"]}') AS product_code, quantity, gross_sales,
        '{vocab.SOURCE_HISTORICAL}' AS data_source, row_number() OVER (PARTITION BY {", ".join(HIST_COLUMNS)} ORDER BY place) > 1 AS is_duplicate FROM h
    UNION ALL SELECT place + 1 + (SELECT max(place) FROM raw_h), doc_no, coalesce(product_code, '{vocab.LABEL_DEFAULTS["product_code"]}'), quantity,
        gross_sales, '{vocab.SOURCE_CURRENT}', row_number() OVER (PARTITION BY {", ".join(CURRENT_COLUMNS)} ORDER BY place) > 1 FROM c"""

ORACLE["row_ratios"] = f"""
    WITH {VIEW} SELECT doc_no, product_code, margin, discount_rate, return_rate, unit_cost, avg_row_value FROM v"""

_LABELS = "product_group, product_type, channel, customer_group, region, returned, period, data_source, has_cost"
ORACLE["canonical_fact_defaults"] = f"WITH {UNIFIED} SELECT {_LABELS}, count(*) AS row_count FROM u1 GROUP BY {_LABELS}"

ORACLE["order_value_labels"] = f"""
    WITH {VIEW} SELECT doc_no, product_code, {rnd("log10(net_revenue)", 8, "log_revenue")},
        CASE WHEN return_value > 0 THEN '{vocab.STATE_OUTLIER}' ELSE '{vocab.STATE_NORMAL}' END AS outlier_state,
        net_revenue / 1e9 AS net_revenue_bn FROM v WHERE net_revenue > 0"""

# Data quality

_DUP = "doc_no, product_code, quantity, gross_sales, returned, source_sheet"
ORACLE["duplicate_flags"] = f"WITH {RAW} SELECT {_DUP}, row_number() OVER (PARTITION BY {_DUP}) > 1 AS is_duplicate FROM raw_h"

_DUP_COUNT = "doc_no, customer_group, channel, source_sheet"
ORACLE["duplicate_flag_count"] = f"""
    WITH {RAW}, f AS (SELECT source_sheet, row_number() OVER (PARTITION BY {_DUP_COUNT}) > 1 AS d FROM raw_h)
    SELECT source_sheet, count(*) AS row_count, count(*) FILTER (WHERE d) AS flagged FROM f GROUP BY 1"""


def _overview(name: str, source: str, names, flag: bool, extra: str = "") -> str:
    compared = [c for c in names if c != "is_duplicate"]
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in names)
    flagged = "count(*) FILTER (WHERE is_duplicate)" if flag else "CAST(NULL AS BIGINT)"
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, {len(names)} AS column_count, {nulls} AS null_cells,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT {", ".join(compared)} FROM {source})) AS duplicate_rows,
        {flagged} AS flagged_duplicates FROM {source}"""


_DATED = ["year", "month", "quarter", "year_month"]
_H_ALL = [*HIST_COLUMNS, *_DATED, "period", "data_source", "unit_cost", "total_cost", "profit_recomputed", "has_cost", "is_duplicate"]
_C_ALL = [
    *CURRENT_COLUMNS,
    *_DATED,
    *("std_group", "std_type", "std_name", "list_price", "unit_cost", "total_cost", "profit_recomputed", "profit"),
    *("has_cost", "returned", "period", "data_source", "is_duplicate"),
]
_COST_COLUMNS = schemas.columns(schemas.COST)
_STAGES = [
    ("raw_sales_historical", "raw_h", schemas.columns(schemas.HISTORICAL), False),
    ("raw_sales_current", "raw_c", CURRENT_COLUMNS, False),
    ("raw_cost", "raw_k", _COST_COLUMNS, False),
    ("sales_historical_clean", "h", _H_ALL, True),
    ("sales_current_clean", "c", _C_ALL, True),
    ("cost_clean", "k", _COST_COLUMNS, False),
    ("sales_final", "u", schemas.columns(schemas.SALES), True),
]
ORACLE["quality_overview"] = f"WITH {UNIFIED} " + " UNION ALL ".join(_overview(*s) for s in _STAGES)

ORACLE["duplicate_counts_with_flag"] = f"WITH {UNIFIED} " + " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {", ".join(cols)} FROM {s})) AS duplicate_rows
    FROM {s}"""
    for n, s, cols, flag in _STAGES
    if flag
)

_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_cells, count(*) AS n FROM c" for c in _C_ALL)
ORACLE["null_profile"] = f"""
    WITH {CLEANED} SELECT column_name, null_cells, {rnd("null_cells / n", 8, "null_share")} FROM ({_NULLS})
    WHERE null_cells > 0 ORDER BY null_cells DESC, column_name LIMIT 15"""

_COUNTS = "count(DISTINCT doc_no) AS orders, count(DISTINCT customer_code) AS customers, count(DISTINCT product_code) AS products"
ORACLE["scope_by_year"] = f"""
    WITH {VIEW}, g AS (SELECT year, min(doc_date) AS first_date, max(doc_date) AS last_date, count(*) AS row_count, {_COUNTS},
        {exact("net_revenue")} AS net_revenue, {exact("profit")} AS profit FROM v GROUP BY year)
    SELECT * EXCLUDE (net_revenue, profit), {rnd("net_revenue", 4)}, {rnd("profit", 4)},
        {rnd(div("profit", "net_revenue"), 8, "margin")} FROM g"""

ORACLE["table_shape"] = f"""
    WITH {VIEW} SELECT count(*) AS row_count, 3 AS column_count, min(doc_date) AS first_date, max(doc_date) AS last_date FROM v"""


def _profile() -> str:
    rows = []
    dtypes = {"o_orderstatus": "string", "o_orderpriority": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz"}
    for c, dtype in dtypes.items():
        rows.append(f"SELECT '{c}' AS column_name, 'dtype' AS metric, CAST(NULL AS DOUBLE) AS number, '{dtype}' AS label")
        rows.append(f"SELECT '{c}', 'count', CAST(count({c}) AS DOUBLE), NULL FROM orders")
        if dtype == "double":
            figures = {"mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "max": f"max({c})"}
            figures |= {f"{int(p * 100)}%": f"quantile_cont({c}, {p})" for p in (0.25, 0.5, 0.75)}
            rows += [f"SELECT '{c}', '{m}', round({sql}, 4), NULL FROM orders" for m, sql in figures.items()]
        else:
            top = f"(SELECT CAST({c} AS STRING) AS v, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
            rows.append(f"SELECT '{c}', 'unique', CAST(count(DISTINCT {c}) AS DOUBLE), NULL FROM orders")
            rows.append(f"SELECT '{c}', 'top', NULL, v FROM {top}")
            rows.append(f"SELECT '{c}', 'freq', CAST(n AS DOUBLE), NULL FROM {top}")
    return " UNION ALL ".join(rows)


ORACLE["column_profile"] = _profile()

# Star schema

ORACLE["dim_date"] = f"""
    WITH {VIEW} SELECT DISTINCT CAST(strftime(doc_date, '%Y%m%d') AS INTEGER) AS date_key, doc_date, year, quarter, month,
        '{vocab.MONTH_PREFIX}' || CAST(month AS STRING) AS month_name, year_month FROM v"""


def _dimension(key_name: str, natural: str, attrs, known: str = "") -> str:
    order = ", ".join([*([known] if known else []), *star.SOURCE_ORDER, *attrs])
    return f"""SELECT row_number() OVER (ORDER BY {natural}) AS {key_name}, {", ".join([natural, *attrs])} FROM (
        SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY {natural} ORDER BY {order}) = 1)"""


DIMS = f"""{VIEW},
    dc AS ({_dimension("customer_key", "customer_code", star.CUSTOMER_ATTRS)}),
    dp AS ({_dimension("product_key", "product_code", star.PRODUCT_ATTRS)}),
    dh AS ({_dimension("channel_key", "channel", ())})"""
ORACLE["dim_customer"] = f"WITH {DIMS} SELECT * FROM dc"
ORACLE["dim_product"] = f"WITH {DIMS} SELECT * FROM dp"
ORACLE["dim_channel"] = f"WITH {DIMS} SELECT * FROM dh"
_UNKNOWN_LAST = f"(customer_name = '{vocab.NO_DATA}')"
ORACLE["dim_customer_known"] = f"WITH {VIEW} {_dimension('customer_key', 'customer_code', star.CUSTOMER_ATTRS, _UNKNOWN_LAST)}"

_FIRST = ", ".join(f"arg_min_null({c}, line) AS {c}" for c in star.CUSTOMER_ATTRS)
ORACLE["dim_customer_ingest"] = f"""
    WITH v AS (SELECT line, {columns_of(tables.VIEW, ["customer_code", *star.CUSTOMER_ATTRS])} FROM {NUMBERED})
    SELECT row_number() OVER (ORDER BY customer_code) AS customer_key, customer_code, {", ".join(star.CUSTOMER_ATTRS)}
    FROM (SELECT customer_code, {_FIRST} FROM v GROUP BY customer_code)"""

ORACLE["fact_sales"] = f"""
    WITH {DIMS.replace(ALL_JOINS, NUMBERED).replace("v0 AS (SELECT ", "v0 AS (SELECT line, ").replace("v1 AS (SELECT ", "v1 AS (SELECT line, ")},
        f AS (SELECT v.line + 1 AS sales_id,
        CAST(strftime(doc_date, '%Y%m%d') AS INTEGER) AS date_key, dc.customer_key, dp.product_key, dh.channel_key, v.*
        FROM v LEFT JOIN dc ON v.customer_code = dc.customer_code LEFT JOIN dp ON v.product_code = dp.product_code
        LEFT JOIN dh ON v.channel = dh.channel)
    SELECT {', '.join(star.FACT_COLUMNS)} FROM f"""

# Marts


def kpi_block(by) -> str:
    sums = ", ".join(f"{exact(m)} AS {m}" for m in kpi.MEASURES)
    return f"SELECT {', '.join(by)}, {sums}, {_COUNTS} FROM v GROUP BY {', '.join(by)}"


def kpi_columns(by) -> str:
    ratios = {
        "margin": ("profit", "net_revenue"),
        "discount_rate": ("discount", "gross_sales"),
        "return_rate": ("return_value", "gross_sales"),
    }
    return ", ".join(
        [
            *by,
            *[rnd(m, 4) for m in kpi.MEASURES],
            *kpi.COUNTS,
            *[rnd(div(a, b), 8, name) for name, (a, b) in ratios.items()],
            f"{div('net_revenue', 'orders')} AS avg_order_value",
        ]
    )


for _name, _grain in kpi.GRAINS.items():
    ORACLE[_name] = f"WITH {VIEW}, g AS ({kpi_block(_grain)}) SELECT {kpi_columns(_grain)} FROM g"


def _shares(source: str, ties: str) -> str:
    so_far = f"sum(net_revenue) OVER (PARTITION BY year ORDER BY net_revenue DESC, {ties} ROWS UNBOUNDED PRECEDING)"
    return f"""SELECT *, {div("net_revenue", "sum(net_revenue) OVER (PARTITION BY year)")} AS revenue_share,
        {div(so_far, "sum(net_revenue) OVER (PARTITION BY year)")} AS cumulative_share FROM {source}"""


_CLASS = f"CASE WHEN cumulative_share <= 0.8 THEN '{vocab.PARETO_TOP}' ELSE '{vocab.PARETO_REST}' END AS pareto_class"
_SHARE_COLUMNS = ", ".join(rnd(c, 8) for c in PARETO_COLUMNS) + ", " + _CLASS
ORACLE["mart_pareto_customer_group"] = f"""
    WITH {VIEW}, g AS ({kpi_block(kpi.PARETO_GRAIN)}), p AS ({_shares("g", "customer_group, period")})
    SELECT {kpi_columns(kpi.PARETO_GRAIN)}, {_SHARE_COLUMNS} FROM p"""

_GRAINS = {**kpi.GRAINS, "mart_pareto_customer_group": kpi.PARETO_GRAIN}
_BLOCKS = ", ".join(f"g_{n} AS ({kpi_block(g)})" for n, g in _GRAINS.items())
_STACKED = [f"SELECT '{n}' AS mart, {kpi_columns(g)} FROM g_{n}" for n, g in kpi.GRAINS.items()]
_STACKED.append(f"SELECT 'mart_pareto_customer_group' AS mart, {kpi_columns(kpi.PARETO_GRAIN)}, {_SHARE_COLUMNS} FROM p")
ORACLE["marts_one_pass"] = f"""
    WITH {VIEW}, {_BLOCKS}, p AS ({_shares("g_mart_pareto_customer_group", "customer_group, period")})
    {" UNION ALL BY NAME ".join(_STACKED)}"""

# Reports

_YTD = "FROM v WHERE month(doc_date) <= 5"
ORACLE["ytd_kpi_yoy"] = f"""
    WITH {VIEW}, g AS (SELECT year, {exact("net_revenue")} AS net_revenue, {exact("profit")} AS profit, {_COUNTS} {_YTD} GROUP BY year),
    w AS (SELECT *, lag(net_revenue) OVER (ORDER BY year) AS r0, lag(profit) OVER (ORDER BY year) AS p0 FROM g)
    SELECT year, {rnd("net_revenue", 4)}, {rnd("profit", 4)}, {rnd("CAST(net_revenue AS DOUBLE) / 1e9", 8, "net_revenue_bn")},
        {rnd("CAST(profit AS DOUBLE) / 1e9", 8, "profit_bn")}, {rnd(div("profit", "net_revenue"), 8, "margin")},
        {rnd(div("net_revenue - r0", "r0"), 8, "net_revenue_yoy")}, {rnd(div("profit - p0", "p0"), 8, "profit_yoy")},
        orders, customers, products, {div("net_revenue", "orders")} AS avg_order_value FROM w"""

_SUMS = f"{exact('net_revenue')} AS net_revenue, {exact('profit')} AS profit"
_SUMS_OUT = f"{rnd('net_revenue', 4)}, {rnd('profit', 4)}, {rnd(div('profit', 'net_revenue'), 8, 'margin')}"
ORACLE["ytd_channel"] = f"""
    WITH {VIEW}, g AS (SELECT year, channel, {_SUMS}, count(*) AS row_count {_YTD} GROUP BY year, channel)
    SELECT year, channel, row_count, {_SUMS_OUT} FROM g"""

_PIVOT = ", ".join(
    rnd(f"coalesce(sum(CASE WHEN channel = '{c}' THEN CAST(net_revenue AS DECIMAL(18, 6)) END), 0)", 4, f'"{c}"')
    for c in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
)
ORACLE["ytd_channel_pivot"] = f"WITH {VIEW} SELECT year, {_PIVOT} {_YTD} GROUP BY year"

ORACLE["ytd_product_group"] = f"""
    WITH {VIEW}, g AS (SELECT year, product_group, {_SUMS}, {exact("quantity")} AS quantity, count(DISTINCT product_code) AS products
        {_YTD} GROUP BY year, product_group)
    SELECT year, product_group, {rnd("quantity", 4)}, products, {_SUMS_OUT} FROM g"""

ORACLE["ytd_pareto"] = f"""
    WITH {VIEW}, g AS (SELECT year, customer_group, {exact("net_revenue")} AS net_revenue {_YTD} AND year IS NOT NULL
        GROUP BY year, customer_group), p AS ({_shares("g", "customer_group")})
    SELECT year, customer_group, {rnd("net_revenue", 4)}, {_SHARE_COLUMNS} FROM p"""

ORACLE["monthly_trend"] = f"""
    WITH {VIEW}, g AS (SELECT year, month, period, {_SUMS} FROM v GROUP BY year, month, period)
    SELECT year, month, CAST(year AS STRING) || '-' || lpad(CAST(month AS STRING), 2, '0') AS period_key, {_SUMS_OUT},
        {rnd("CAST(net_revenue AS DOUBLE) / 1e9", 8, "net_revenue_bn")}, {rnd("CAST(profit AS DOUBLE) / 1e9", 8, "profit_bn")} FROM g"""



def _positions(name: str, label: str, by: str, order: str, where: str) -> str:
    grouped = f"SELECT {by}, {exact('net_revenue')} AS net_revenue FROM v WHERE {where} GROUP BY {by}"
    return f"""SELECT '{name}' AS report, row_number() OVER (ORDER BY {order}) AS position, year, {label} AS label,
        {rnd("net_revenue", 4)} FROM ({grouped})"""


_EARLY = "month(doc_date) <= 5"
ORACLE["report_positions"] = f"WITH {VIEW} " + " UNION ALL ".join(
    [
        _positions("report_kpi", "CAST(NULL AS STRING)", "year", "year", _EARLY),
        _positions("report_month_trend", "year_month", "year, month, year_month, period", "year, month", "TRUE"),
        *[_positions(n, c, f"year, {c}", f"year, net_revenue DESC, {c}", _EARLY)
          for n, c in (("report_channel", "channel"), ("report_product_group", "product_group"), ("report_pareto", "customer_group"))],
    ]
)

# Outliers


def _bounds(metrics, factor: float, by: str = "") -> str:
    figures = []
    for m in metrics:
        figures += [f"quantile_cont({m}, 0.25) AS {m}_q1", f"quantile_cont({m}, 0.75) AS {m}_q3"]
    derived = []
    for m in metrics:
        iqr = f"({m}_q3 - {m}_q1)"
        derived += [f"{iqr} AS {m}_iqr", f"{m}_q1 - {factor} * {iqr} AS {m}_low", f"{m}_q3 + {factor} * {iqr} AS {m}_high"]
    group = f" GROUP BY {by}" if by else ""
    head = f"{by}, " if by else ""
    return f"SELECT *, {', '.join(derived)} FROM (SELECT {head}{', '.join(figures)} FROM v{group})"


_LIMITS = [f"{m}_{x}" for m in outliers.METRICS for x in ("q1", "q3", "iqr", "low", "high")]
ORACLE["outlier_thresholds"] = f"""
    WITH {VIEW}, b AS ({_bounds(outliers.METRICS, 3.0)}) SELECT {", ".join(rnd(c, 8) for c in _LIMITS)} FROM b"""


def _flag(m: str) -> str:
    return f"coalesce({m} < {m}_low OR {m} > {m}_high, FALSE)"


def _level(m: str) -> str:
    return (
        f"CASE WHEN {m} < {m}_low THEN '{vocab.OUTLIER_LOW}' WHEN {m} > {m}_high THEN '{vocab.OUTLIER_HIGH}'"
        f" ELSE '{vocab.OUTLIER_NORMAL}' END"
    )


_TWO = ("net_revenue", "profit")
ORACLE["outlier_flags"] = f"""
    WITH {VIEW}, b AS ({_bounds(_TWO, 1.5)})
    SELECT doc_no, product_code, {", ".join(f"{_flag(m)} AS {m}_outlier, {_level(m)} AS {m}_level" for m in _TWO)} FROM v, b"""


def _summary(factor: float, by: str = "") -> str:
    join = f"JOIN b USING ({by})" if by else "CROSS JOIN b"
    name = by or f"'{vocab.OUTLIER_ALL}'"
    rows = []
    for m in outliers.METRICS:
        figures = {"q1": f"{m}_q1", "q3": f"{m}_q3", "iqr": f"{m}_iqr", "lower_bound": f"{m}_low", "upper_bound": f"{m}_high"}
        limits = ", ".join(rnd(f"any_value({sql})", 8, n) for n, sql in figures.items())
        rows.append(
            f"""SELECT '{m}' AS metric, {name} AS group_name, count(*) AS total_rows, count({m}) AS valid_rows, {limits},
            count(*) FILTER (WHERE {_flag(m)}) AS outlier_rows,
            {rnd(div(f"count(*) FILTER (WHERE {_flag(m)})", f"count({m})"), 8, "outlier_rate")},
            min(CASE WHEN {_flag(m)} THEN doc_date END) AS first_outlier_date,
            max(CASE WHEN {_flag(m)} THEN doc_date END) AS last_outlier_date FROM v {join} GROUP BY group_name"""
        )
    return f"WITH {VIEW}, b AS ({_bounds(outliers.METRICS, factor, by)}) " + " UNION ALL ".join(rows)


ORACLE["outlier_summary"] = _summary(3.0)
ORACLE["outlier_by_group"] = _summary(1.5, "product_group")

_LOGGED = f"""{VIEW}, b AS ({_bounds(("net_revenue",), 1.5)}),
    l AS (SELECT product_group, CASE WHEN {_flag("net_revenue")} THEN '{vocab.STATE_OUTLIER}' ELSE '{vocab.STATE_NORMAL}' END AS outlier_state,
        log10(net_revenue) AS x FROM v, b WHERE net_revenue > 0)"""
_INSIDE = "x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)"
ORACLE["revenue_box_stats"] = f"""
    WITH {_LOGGED}, q AS (SELECT product_group, outlier_state, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
        quantile_cont(x, 0.75) AS q3 FROM l GROUP BY ALL)
    SELECT product_group, outlier_state, {rnd("q1", 8)}, {rnd("median", 8)}, {rnd("q3", 8)}, count(*) AS row_count,
        {rnd(f"min(CASE WHEN {_INSIDE} THEN x END)", 8, "whisker_low")}, {rnd(f"max(CASE WHEN {_INSIDE} THEN x END)", 8, "whisker_high")},
        count(*) FILTER (WHERE NOT ({_INSIDE})) AS fliers
    FROM l JOIN q USING (product_group, outlier_state) GROUP BY product_group, outlier_state, q.q1, q.median, q.q3"""
ORACLE["revenue_decades"] = f"""
    WITH {_LOGGED} SELECT CAST(floor(min(x)) AS INTEGER) AS decade_min, CAST(ceil(max(x)) AS INTEGER) AS decade_max FROM l"""

# Forecast and correlation

MONTHLY = f"""{VIEW},
    m0 AS (SELECT region, CAST(date_trunc('month', doc_date) AS DATE) AS month_start,
        CAST({exact("net_revenue")} AS DOUBLE) AS net_revenue FROM v GROUP BY 1, 2),
    span AS (SELECT region, min(month_start) AS a, max(month_start) AS b FROM m0 GROUP BY region),
    cal AS (SELECT region, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM span),
    m AS (SELECT region, month_start, CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month,
        coalesce(net_revenue, 0) AS net_revenue FROM cal LEFT JOIN m0 USING (region, month_start))"""
ORACLE["monthly_base"] = f"WITH {MONTHLY} SELECT region, month_start, year, month, {rnd('net_revenue', 4)} FROM m"

_ORDER = "PARTITION BY region ORDER BY month_start"
FEATURES = f"""{MONTHLY},
    f AS (SELECT *, CAST(row_number() OVER ({_ORDER}) AS INTEGER) AS trend,
        {", ".join(f"lag(net_revenue, {n}) OVER ({_ORDER}) AS lag_{n}" for n in fc.LAGS)},
        avg(net_revenue) OVER ({_ORDER} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS trailing_mean FROM m)"""
ORACLE["monthly_features"] = f"""
    WITH {FEATURES} SELECT region, month_start, year, month, {rnd("net_revenue", 4)}, trend,
        {", ".join(rnd(f"lag_{n}", 4) for n in fc.LAGS)}, {rnd("trailing_mean", 5)} FROM f"""

_PAST = f"OVER ({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
BACKTEST = f"""{FEATURES},
    w AS (SELECT *, regr_slope(net_revenue, trend) {_PAST} * trend + regr_intercept(net_revenue, trend) {_PAST} AS line FROM f),
    t0 AS (SELECT * FROM w WHERE trend > {fc.MIN_HISTORY}),
    t1 AS (SELECT *, 'seasonal_naive' AS model, lag_12 AS predicted FROM t0 UNION ALL
        SELECT *, 'trailing_mean', trailing_mean FROM t0 UNION ALL SELECT *, 'linear_trend', line FROM t0),
    t AS (SELECT *, predicted - net_revenue AS error FROM t1 WHERE predicted IS NOT NULL)"""
ORACLE["forecast_backtest"] = f"""
    WITH {BACKTEST} SELECT region, month_start, year, month, {rnd("net_revenue", 4)}, model, {rnd("predicted", 2)}, {rnd("error", 2)} FROM t"""
ORACLE["forecast_metrics"] = f"""
    WITH {BACKTEST} SELECT region, model, count(*) AS months, {rnd("avg(abs(error))", 2, "mae")},
        {rnd("sqrt(avg(error * error))", 2, "rmse")}, {rnd("avg(abs(error) / nullif(abs(net_revenue), 0))", 6, "mape")} FROM t GROUP BY 1, 2"""

ORACLE["forecast_vs_actual"] = f"""
    WITH {MONTHLY}, hist AS (SELECT *, row_number() OVER ({_ORDER}) AS trend FROM m WHERE month_start < DATE '2001-01-01'),
    lines AS (SELECT region, regr_slope(net_revenue, trend) AS slope, regr_intercept(net_revenue, trend) AS start,
        max(trend) AS last_trend, max(month_start) AS last_month FROM hist GROUP BY region),
    seasons AS (SELECT region, month, avg(net_revenue / nullif(slope * trend + start, 0)) AS season
        FROM hist JOIN lines USING (region) GROUP BY region, month),
    steps AS (SELECT region, slope * (last_trend + ahead) + start AS line,
        CAST(last_month + to_months(CAST(ahead AS INTEGER)) AS DATE) AS month_start
        FROM lines CROSS JOIN generate_series(1, {fc.HORIZON}) s(ahead)),
    fcst AS (SELECT steps.region, steps.month_start, CAST(year(steps.month_start) AS INTEGER) AS year,
        CAST(month(steps.month_start) AS INTEGER) AS month,
        line * coalesce(season, 1) AS forecast
        FROM steps LEFT JOIN seasons ON steps.region = seasons.region AND seasons.month = month(steps.month_start))
    SELECT fcst.region, fcst.month_start, fcst.year, fcst.month, {rnd("forecast", 2)}, {rnd("m0.net_revenue", 4, "actual")},
        {rnd("forecast - m0.net_revenue", 2, "error")}, {rnd(div("forecast - m0.net_revenue", "m0.net_revenue"), 6, "error_share")}
    FROM fcst LEFT JOIN m0 ON fcst.region = m0.region AND fcst.month_start = m0.month_start"""

_PAIRS = ["quantity", "gross_sales", "discount", "net_revenue", "profit"]
ORACLE["indicator_corr"] = f"WITH {VIEW} " + " UNION ALL ".join(
    f"SELECT '{a}' AS indicator_a, '{b}' AS indicator_b, {rnd(f'corr({a}, {b})', 6, 'correlation')} FROM v"
    for i, a in enumerate(_PAIRS)
    for b in _PAIRS[i + 1 :]
)
