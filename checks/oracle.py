"""The same results in SQL over the sample tables, written from the report rules.

``BASE`` holds the report tables as common table expressions; every query adds
its own steps. Nothing here is shared with the Spark code but the headings.
"""

from __future__ import annotations

from stocklens.plans.labels import DEAL_LABELS, EXPORT_LABELS, transfer_labels
from stocklens.sources.sample import SAMPLE_CONFIG

AS_OF = "DATE '2001-08-01'"
YEAR = 2000
FISCAL = 2001


def dec(x: str, precision: int, scale: int) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,10)) AS DECIMAL({precision},{scale}))"


def whole(x: str) -> str:
    return f"CAST(trunc({x}) AS BIGINT)"


def money(x: str, digits: int = 4) -> str:
    return f"CAST({dec(x, 18, digits)} AS DOUBLE)"


def text(x: str) -> str:
    return (
        f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
        f"ELSE CAST({x} AS VARCHAR) END"
    )


BASE = f"""
place AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
),
sup AS (
  SELECT s_suppkey, s_name, r_name AS s_region,
         CASE WHEN s_nationkey % 2 = 0 THEN 113 ELSE 100 END AS s_currency
  FROM supplier JOIN place ON s_nationkey = n_nationkey
),
cus AS (
  SELECT c_custkey, c_name, c_mktsegment, n_name AS c_country, r_name AS c_region,
         CASE WHEN c_nationkey % 2 = 0 THEN 113 ELSE 100 END AS c_currency
  FROM customer JOIN place ON c_nationkey = n_nationkey
),
docs AS (
  SELECT o_orderkey AS findoc, o_orderstatus AS state, CAST(o_orderdate AS DATE) AS d,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS kind, o_orderpriority AS kind_name,
         o_custkey, o_totalprice
  FROM orders
),
item AS (
  SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS code, p_name AS name,
         p_type AS category, p_brand AS maker, p_retailprice AS net, p_size,
         CASE WHEN p_partkey % 2 = 0 THEN p_partkey + 1 END AS rel,
         CASE WHEN p_partkey % 7 <> 0 THEN 'PN-' || p_partkey END AS part_no,
         CASE WHEN p_partkey % 5 <> 0 THEN 'Size ' || p_size END AS specs
  FROM part
),
line AS (
  SELECT l_orderkey, l_partkey AS mtrl, l_suppkey, l_quantity AS qty,
         l_extendedprice AS val, l_extendedprice / l_quantity AS price, l_discount AS disc,
         l_linestatus, l_returnflag,
         CASE WHEN l_linestatus = 'O' THEN 11 END AS rest,
         CASE WHEN l_linestatus = 'O'
              THEN l_quantity - (CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END)
                   - (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)
              ELSE 0 END AS open
  FROM lineitem
),
dl AS (
  SELECT * FROM docs
  JOIN line ON l_orderkey = findoc
  LEFT JOIN item ON id = mtrl
  LEFT JOIN sup ON s_suppkey = l_suppkey
  LEFT JOIN cus ON c_custkey = o_custkey
),
pur AS (
  SELECT *, CASE WHEN s_currency <> 100 THEN CAST({dec("val / qty", 10, 2)} AS DOUBLE)
                 ELSE price END AS euro
  FROM dl WHERE state = 'O' AND kind <> 5
),
arr AS (
  SELECT code, s_region, s_name, open, euro * open AS value FROM pur
  WHERE kind IN (1, 2, 3) AND open <> 0
),
sale AS (
  SELECT *, date_diff('day', d, {AS_OF}) AS age FROM dl
  WHERE state = 'F' AND kind IN (1, 2, 3, 4)
),
stk AS (
  SELECT l_partkey AS p, l_suppkey % 10 AS src,
         sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS h,
         sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS r,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS s
  FROM lineitem GROUP BY 1, 2
),
pos AS (
  SELECT p, count(*) AS pairs,
         sum(h) FILTER (WHERE src < 4) AS own_h, sum(r) FILTER (WHERE src < 4) AS own_r,
         sum(h) FILTER (WHERE src = 4) AS tql_h, sum(r) FILTER (WHERE src = 4) AS tql_r,
         sum(s) FILTER (WHERE src = 4) AS tql_s,
         sum(h) FILTER (WHERE src = 5) AS dsv_h, sum(r) FILTER (WHERE src = 5) AS dsv_r,
         sum(h) FILTER (WHERE src = 6) AS dc_h, sum(r) FILTER (WHERE src = 6) AS dc_r,
         sum(h) FILTER (WHERE src = 7) AS hub_h, sum(r) FILTER (WHERE src = 7) AS hub_r,
         sum(h) FILTER (WHERE src = 8) AS inc, sum(r) AS all_r
  FROM stk GROUP BY p
),
cost AS (
  SELECT mtrl AS c_mtrl, year(d) AS fy,
         CAST({dec("avg(val / qty)", 12, 2)} AS DOUBLE) AS fifo,
         CAST({dec("min(val / qty)", 12, 2)} AS DOUBLE) AS std
  FROM dl GROUP BY 1, 2
)
"""

def query(steps: str, select: str) -> str:
    extra = f",\n{steps}" if steps else ""
    return f"WITH {BASE}{extra}\n{select}"


ORACLE: dict[str, str] = {}

# ---- sources and lines ------------------------------------------------------------------------

ORACLE["scan_documents"] = query(
    "",
    """SELECT findoc, 1251 AS sosource, kind AS fprms, CAST(month(d) AS INTEGER) AS period,
              d AS trndate,
              o_totalprice AS sumamnt
       FROM docs WHERE state = 'O'""",
)

ORACLE["scan_stock"] = query(
    "",
    """SELECT p AS productid, CAST(p AS VARCHAR) AS supplierproductid,
              CAST(src AS INTEGER) AS supplierid, h AS units_in_stock,
              r AS customer_order_units, s AS supplier_order_units
       FROM stk WHERE src < 4""",
)

ALL_PURCHASES = f"""
allpur AS (
  SELECT d.*, l.*, i.*, s.*,
         CASE WHEN s_currency <> 100 THEN CAST({dec("val / qty", 10, 2)} AS DOUBLE)
              ELSE coalesce(price, 0) END AS euro
  FROM docs d LEFT JOIN line l ON l_orderkey = findoc
  LEFT JOIN item i ON id = mtrl LEFT JOIN sup s ON s_suppkey = l_suppkey
  WHERE state = 'O'
)"""

ORACLE["document_lines"] = query(
    ALL_PURCHASES,
    """SELECT findoc AS doc_id, mtrl AS item_id, qty AS qty1, code AS item_code,
              s_name AS partner, s_currency AS currency, val AS line_value FROM allpur""",
)

ORACLE["purchase_lines"] = query(
    ALL_PURCHASES,
    """SELECT 'Month ' || month(d) AS period, d AS doc_date, kind_name AS doc_type,
              CAST(findoc AS VARCHAR) AS doc_no, CAST(s_suppkey AS VARCHAR) AS supplier_code,
              s_name AS supplier, o_totalprice AS doc_total, code AS item_code,
              name AS description, coalesce(qty, 0) AS quantity,
              coalesce(open, 0) AS open_quantity, coalesce(price, 0) AS price,
              coalesce(val, 0) AS line_value, category, maker, s_currency AS currency,
              euro AS euro_price, s_region AS warehouse
       FROM allpur WHERE kind <> 5""",
)

ORACLE["staged_purchases"] = query(
    ALL_PURCHASES,
    """SELECT kind_name AS doc_type, count(*) AS lines, sum(coalesce(qty, 0)) AS quantity,
              sum(coalesce(open, 0)) AS open_quantity, count(DISTINCT code) AS items
       FROM allpur WHERE kind <> 5 GROUP BY kind_name""",
)

ORACLE["sales_lines"] = query(
    "",
    """SELECT d AS doc_date, '12:00' AS entry_clock, CAST(findoc AS VARCHAR) AS doc_no,
              s_region AS warehouse, c_mktsegment AS branch,
              CAST(c_custkey AS VARCHAR) AS customer_code, c_name AS customer,
              o_totalprice AS doc_total, code AS item_code, name AS description, category, maker,
              qty AS quantity, kind AS doc_type_id
       FROM sale""",
)

ORACLE["sales_excluding_types"] = query(
    "",
    """SELECT CAST(findoc AS VARCHAR) AS doc_no, code AS item_code, qty AS quantity,
              s_region AS warehouse, kind AS doc_type_id
       FROM sale WHERE kind NOT IN (1, 2) AND s_region <> 'AFRICA'""",
)

ORACLE["transfer_lines"] = query(
    "",
    """SELECT d AS doc_date, kind_name AS doc_type, CAST(findoc AS VARCHAR) AS doc_no,
              code AS item_code, name AS description, coalesce(qty, 0) AS quantity,
              coalesce(open, 0) AS open_quantity, s_region AS warehouse, c_region AS destination
       FROM docs LEFT JOIN line ON l_orderkey = findoc LEFT JOIN item ON id = mtrl
       LEFT JOIN sup ON s_suppkey = l_suppkey LEFT JOIN cus ON c_custkey = o_custkey
       WHERE state = 'P' AND kind IN (2, 3) AND findoc % 3 IN (0, 2)""",
)

ORACLE["open_quantity"] = query(
    "",
    """SELECT findoc AS doc_id, mtrl AS item_id, qty AS qty1, rest AS rest_mode,
              open AS open_quantity FROM dl WHERE state = 'O'""",
)

ORACLE["unit_prices"] = query(
    "",
    f"""SELECT findoc AS doc_id, mtrl AS item_id, qty, c_currency AS currency,
               CASE WHEN c_currency <> 100 THEN CAST({dec("val / qty", 10, 2)} AS DOUBLE)
                    ELSE price END AS euro_price,
               CASE WHEN c_currency <> 100 THEN price ELSE 0 END AS foreign_price
        FROM dl WHERE state = 'F' AND kind IN (1, 2)""",
)

EXPORT_FIELDS = f"""
    d AS doc_date, '12:00' AS entry_clock, CAST(findoc AS VARCHAR) AS doc_no,
    s_region AS warehouse, c_mktsegment AS branch, CAST(c_custkey AS VARCHAR) AS customer_code,
    c_country AS country, c_name AS customer, o_totalprice AS doc_total, code AS item_code,
    name AS description, part_no, category, maker, qty AS quantity,
    CASE WHEN c_currency <> 100 THEN CAST({dec("val / qty", 10, 2)} AS DOUBLE)
         ELSE price END AS euro_price,
    CASE WHEN c_currency <> 100 THEN price ELSE 0 END AS foreign_price"""
EXPORT_INVOICES = f"""
    SELECT {EXPORT_FIELDS}, disc AS discount, val AS line_value, state, mtrl AS item_id
    FROM dl
    WHERE state = 'F' AND kind IN (1, 2) AND year(d) = {YEAR} AND qty >= 1 AND val > 50000"""
EXPORT_PENDING = f"""
    SELECT {EXPORT_FIELDS}, CAST({dec("disc", 10, 2)} AS DOUBLE) AS discount,
           val AS line_value, state, mtrl AS item_id
    FROM dl WHERE state = 'F' AND kind = 5 AND findoc % 8 <> 6 AND l_linestatus = 'O'
      AND rest IS NOT NULL AND year(d) = {YEAR} AND qty >= 1 AND val > 50000"""

ORACLE["export_invoice_lines"] = query("", EXPORT_INVOICES)
ORACLE["pending_order_lines"] = query("", EXPORT_PENDING)
ORACLE["export_lines_union"] = query("", f"{EXPORT_INVOICES} UNION {EXPORT_PENDING}")

ORACLE["entry_time"] = "SELECT event_id, strftime(ts, '%I:%M') AS entry_clock FROM events"

# ---- lookups ----------------------------------------------------------------------------------

ORACLE["dimension_lookup"] = query(
    "", "SELECT id AS item_id, code AS item_code, category, maker FROM item"
)

ORACLE["category_like"] = query(
    "",
    """SELECT code AS item_code, name AS description, category FROM item
       WHERE (category ILIKE 'economy%' OR category ILIKE 'promo%' OR category ILIKE '%TANDAR%')
         AND name NOT ILIKE '%OLD%'""",
)

ORACLE["collated_key_join"] = """
    SELECT n.p_name AS name, count(*) AS items, max(s.price) AS top_price
    FROM (SELECT DISTINCT p_name FROM part) n
    JOIN (SELECT upper(p_name) || '  ' AS loud, p_retailprice AS price FROM part) s
      ON lower(strip_accents(rtrim(s.loud))) = lower(strip_accents(n.p_name))
    GROUP BY n.p_name"""

ORACLE["unicode_key_join"] = """
    SELECT n.p_name AS name, count(*) AS items, max(s.price) AS top_price
    FROM (SELECT DISTINCT p_name FROM part) n
    JOIN (SELECT translate(upper(p_name), 'AEIOU', 'ÁÉÍÓÚ') || '  ' AS loud, p_retailprice AS price FROM part) s
      ON lower(strip_accents(rtrim(s.loud))) = lower(strip_accents(n.p_name))
    GROUP BY n.p_name"""

ORACLE["related_item"] = query(
    "",
    """SELECT a.code, r.code AS related_code, r.net AS related_net_price
       FROM item a LEFT JOIN item r ON r.id = a.rel""",
)

ORACLE["item_year_data"] = query(
    "",
    f"""SELECT id AS item_id, CASE WHEN y.mtrl IS NOT NULL THEN {YEAR} END AS item_year
        FROM item LEFT JOIN (SELECT DISTINCT mtrl FROM dl WHERE year(d) = {YEAR}) y
          ON y.mtrl = item.id""",
)

ORACLE["stock_for_items"] = query(
    "",
    """SELECT code, own_h AS own_on_hand, own_r AS own_reserved, hub_h AS hub_on_hand
       FROM item LEFT JOIN pos ON CAST(p AS VARCHAR) = code""",
)

ORACLE["prefixed_key_lookup"] = query(
    "",
    """SELECT code, h AS incoming FROM item
       LEFT JOIN (SELECT 'ID' || p AS k, h FROM stk WHERE src = 8) ON k = 'ID' || code""",
)

RELATED = """
rel_stock AS (SELECT CAST(p AS VARCHAR) AS k, sum(h) AS v FROM stk
              WHERE src IN (0, 1, 2, 3, 7) GROUP BY 1),
rel_coming AS (SELECT 'ID' || p AS k, h AS v FROM stk WHERE src = 8),
rel_reserved AS (SELECT CASE WHEN src = 8 THEN 'ID' ELSE '' END || p AS k, sum(r) AS v
                 FROM stk GROUP BY 1)"""

ORACLE["related_item_position"] = query(
    RELATED,
    """SELECT a.code, r.code AS related_code, coalesce(x.v, 0) AS related_stock,
              coalesce(y.v, 0) AS related_arrivals, coalesce(z.v, 0) AS related_reserved,
              coalesce(x.v, 0) + coalesce(y.v, 0) - coalesce(z.v, 0) AS related_net
       FROM item a LEFT JOIN item r ON r.id = a.rel
       LEFT JOIN rel_stock x ON x.k = r.code LEFT JOIN rel_coming y ON y.k = 'ID' || r.code
       LEFT JOIN rel_reserved z ON z.k = r.code""",
)

ORACLE["items_seen_at_site"] = query(
    "",
    """SELECT DISTINCT mtrl AS item_id FROM line JOIN sup ON s_suppkey = l_suppkey
       WHERE s_region = 'AMERICA'""",
)

# ---- stock and movements ----------------------------------------------------------------------

ORACLE["stock_position"] = query(
    "",
    """SELECT p AS productid, n AS stock_rows,
              own_h AS own_on_hand, own_r AS own_reserved, tql_h AS tql_on_hand,
              tql_r AS tql_reserved, tql_s AS tql_deals_reserved, dsv_h AS dsv_on_hand,
              dsv_r AS dsv_reserved, dc_h AS dc_on_hand, dc_r AS dc_reserved,
              hub_h AS hub_on_hand, hub_r AS hub_reserved, inc AS incoming,
              all_r AS all_reserved
       FROM pos JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p""",
)

REGIONS = {
    "own": "('ASIA', 'EUROPE')",
    "tql": "('AFRICA')",
    "dc": "('MIDDLE EAST')",
    "dsv": "('AMERICA')",
    "hub": "('MIDDLE EAST')",
}


def arrivals(site: str) -> str:
    return f"""a_{site} AS (
      SELECT code, sum(open) AS q, sum(value) / nullif(sum(open), 0) AS w FROM arr
      WHERE s_region IN {REGIONS[site]} GROUP BY code)"""


ARRIVALS = ",\n".join(arrivals(s) for s in ("own", "tql", "dc", "dsv"))

ORACLE["expected_arrivals"] = query(
    ARRIVALS,
    """SELECT k.code AS key, """
    + ", ".join(
        f"a_{s}.q AS {s}_arrivals, {money(f'a_{s}.w')} AS {s}_weighted_price"
        for s in ("own", "tql", "dc", "dsv")
    )
    + " FROM (SELECT DISTINCT code FROM arr) k "
    + " ".join(f"LEFT JOIN a_{s} ON a_{s}.code = k.code" for s in ("own", "tql", "dc", "dsv")),
)

VIRTUAL = """SELECT code AS key, sum(open) AS virtual_arrivals FROM arr
       WHERE s_region IN ('ASIA', 'EUROPE') AND s_name IN ({})
       GROUP BY code"""
DSV_SUPPLIERS = "'Supplier#000000005', 'Supplier#000000007'"
TQL_SUPPLIERS = "'Supplier#000000003', 'Supplier#000000004'"
DC_SUPPLIERS = "'Supplier#000000009'"

ORACLE["virtual_arrivals"] = query("", VIRTUAL.format(f"{DSV_SUPPLIERS}, {TQL_SUPPLIERS}"))

ORACLE["sales_last_30_90"] = query(
    "",
    """SELECT code AS key, sum(qty) FILTER (WHERE age BETWEEN 0 AND 30) AS sold_30,
              sum(qty) AS sold_90
       FROM sale WHERE age BETWEEN 0 AND 90 GROUP BY code""",
)

CHANNELS = """SELECT code AS key,
              sum(qty) FILTER (WHERE s_region = 'MIDDLE EAST') AS hub_sales,
              sum(qty) FILTER (WHERE kind NOT IN (1, 2)) AS store_sales,
              sum(qty) FILTER (WHERE kind NOT IN (1, 2) AND s_region <> 'MIDDLE EAST')
                AS non_hub_sales
       FROM sale WHERE age BETWEEN 0 AND 30 AND qty >= 1 GROUP BY code"""
ORACLE["sales_by_channel"] = query(
    f"ch AS ({CHANNELS})",
    "SELECT * FROM ch WHERE hub_sales IS NOT NULL OR store_sales IS NOT NULL",
)


def transfers(site: str, kinds: str) -> str:
    return f"""SELECT code AS key, sum(qty) AS transfers,
              sum(qty) FILTER (WHERE s_region IN {REGIONS[site]}
                               AND c_region IN ('ASIA', 'EUROPE')) AS to_store_transfers,
              sum(qty) FILTER (WHERE c_region = 'MIDDLE EAST') AS to_hub_transfers
       FROM dl WHERE state = 'P' AND kind IN ({kinds}) AND findoc % 3 IN (0, 2) GROUP BY code"""


ORACLE["transfers_in"] = query("", transfers("dsv", "2, 3"))

MONTHS = """SELECT mtrl AS item_id,
              sum(qty) FILTER (WHERE ym = '2001-05') AS month_3,
              sum(qty) FILTER (WHERE ym = '2001-06') AS month_2,
              sum(qty) FILTER (WHERE ym = '2001-07') AS month_1,
              sum(qty) FILTER (WHERE ym = '2001-08') AS month_0
       FROM (SELECT mtrl, qty, strftime(d, '%Y-%m') AS ym FROM dl WHERE state = 'F')
       WHERE ym BETWEEN '2001-05' AND '2001-08' GROUP BY mtrl"""
ORACLE["monthly_sales_trend"] = query("", MONTHS)

ORACLE["fifo_price"] = query(
    f"""this AS (SELECT * FROM cost WHERE fy = {FISCAL}),
        last AS (SELECT * FROM cost WHERE fy = {FISCAL - 1})""",
    """SELECT coalesce(this.c_mtrl, last.c_mtrl) AS item_id, this.fifo AS fifo_this_year,
              coalesce(this.fifo, last.fifo) AS fifo_with_fallback,
              this.std AS standard_this_year
       FROM this FULL JOIN last ON this.c_mtrl = last.c_mtrl""",
)

ORACLE["line_fifo_cost"] = query(
    f"inv AS ({EXPORT_INVOICES})",
    f"""SELECT doc_no, item_code, quantity, {dec("fifo", 10, 0)} AS fifo_cost
        FROM inv LEFT JOIN cost ON c_mtrl = item_id AND fy = year(doc_date)""",
)

# ---- suppliers --------------------------------------------------------------------------------

LOGISTICS = f"{DSV_SUPPLIERS}, {TQL_SUPPLIERS}, {DC_SUPPLIERS}"


def supplier_lists(rows: str, name: str = "lists") -> str:
    return f"""{name} AS (
      SELECT i.mtrl AS list_item, l.suppliers
      FROM (SELECT DISTINCT mtrl, name FROM {rows}) i
      LEFT JOIN (SELECT name, string_agg(s_name, ', ' ORDER BY s_name) AS suppliers
                 FROM (SELECT DISTINCT name, s_name FROM {rows}) GROUP BY name) l
        ON l.name = i.name)"""


DEAL_LISTS = (
    f"deal_pur AS (SELECT * FROM pur WHERE s_name NOT IN ({LOGISTICS})),\n"
    + supplier_lists("deal_pur")
)

ORACLE["supplier_list"] = query(DEAL_LISTS, "SELECT list_item AS item_id, suppliers FROM lists")
ORACLE["supplier_list_width"] = query(
    DEAL_LISTS,
    "SELECT CAST(max(len(string_split(suppliers, ', '))) AS INTEGER) AS max_tokens FROM lists",
)
ORACLE["supplier_tokens"] = query(
    DEAL_LISTS,
    """SELECT list_item AS item_id, CAST(len(string_split(suppliers, ', ')) AS INTEGER) AS tokens,
              replace(suppliers, ', ', '|') AS listed FROM lists""",
)
ORACLE["supplier_columns"] = query(
    DEAL_LISTS,
    "SELECT list_item AS item_id, suppliers, "
    + ", ".join(f"string_split(suppliers, ', ')[{i}] AS supplier_{i}" for i in range(1, 6))
    + " FROM lists",
)

SPREAD = (
    DEAL_LISTS
    + """,
spread AS (
  SELECT lower(name) AS description_key, s_name AS supplier,
         CAST(row_number() OVER (PARTITION BY name ORDER BY s_name) AS INTEGER) AS place
  FROM (SELECT DISTINCT name, s_name FROM deal_pur))"""
)

ORACLE["supplier_places_by_range"] = query(SPREAD, "SELECT * FROM spread")

# the width comes from the data here too: PIVOT makes one column per place that occurs
ORACLE["supplier_wide"] = query(
    SPREAD,
    """SELECT i.item_id, w.* EXCLUDE (description_key)
       FROM (SELECT DISTINCT mtrl AS item_id, lower(name) AS description_key FROM deal_pur) i
       LEFT JOIN (PIVOT (SELECT description_key, 'supplier_' || CAST(place AS VARCHAR) AS col, supplier
                         FROM spread)
                  ON col USING first(supplier) GROUP BY description_key) w
         ON w.description_key = i.description_key""",
)

PAGED = (
    SPREAD
    + """,
ids AS (SELECT description_key, CAST(row_number() OVER (ORDER BY description_key) AS INTEGER) AS list_id
        FROM (SELECT DISTINCT description_key FROM spread))"""
)

ORACLE["supplier_pages"] = query(
    PAGED,
    """SELECT list_id, CAST((place - 1) // 50 + 1 AS INTEGER) AS page,
              string_agg(supplier, ', ' ORDER BY place) AS suppliers
       FROM spread JOIN ids USING (description_key)
       GROUP BY list_id, (place - 1) // 50 + 1""",
)

ORACLE["supplier_list_ids"] = query(
    PAGED,
    """SELECT i.item_id, ids.list_id
       FROM (SELECT DISTINCT mtrl AS item_id, lower(name) AS description_key FROM deal_pur) i
       LEFT JOIN ids USING (description_key)""",
)

ORACLE["supplier_spread"] = query(
    DEAL_LISTS,
    """SELECT lower(name) AS description_key, s_name AS supplier,
              CAST(row_number() OVER (PARTITION BY name ORDER BY s_name) AS INTEGER) AS place
       FROM (SELECT DISTINCT name, s_name FROM deal_pur)""",
)

# ---- transfer suggestions ---------------------------------------------------------------------


def transfer_steps(site: str) -> str:
    """Steps up to ``final``: one row per candidate of an outside site."""
    source = {"dsv": 5, "tql": 4}[site]
    others = [s for s in ("dsv", "tql", "dc") if s != site]
    suppliers = {"dsv": DSV_SUPPLIERS, "tql": TQL_SUPPLIERS}[site]
    arr_names = [s for s in dict.fromkeys(("own", site, "hub"))]
    return f"""
{", ".join(arrivals(s) for s in arr_names)},
virt AS ({VIRTUAL.format(suppliers)}),
ch AS ({CHANNELS}),
tr AS ({transfers(site, "2, 3")}),
seen AS (SELECT DISTINCT mtrl AS seen_id FROM line JOIN sup ON s_suppkey = l_suppkey
         WHERE s_region IN {REGIONS[site]}),
cand AS (
  SELECT a.*, r.code AS related_code,
         coalesce(o.{site}_h, 0) AS site_h, coalesce(o.{site}_r, 0) AS site_r,
         coalesce(sa.q, 0) AS site_arr,
         coalesce(x.own_h, 0) AS own_h, coalesce(x.own_r, 0) AS own_r,
         coalesce(oa.q, 0) AS own_arr,
         coalesce(x.hub_h, 0) AS hub_h, coalesce(x.hub_r, 0) AS hub_r,
         coalesce(ha.q, 0) AS hub_arr,
         coalesce(x.{site}_h, 0) AS site_h2,
         coalesce(x.{others[0]}_h, 0) + coalesce(x.{others[1]}_h, 0) AS other_h,
         coalesce(hub_sales, 0) AS s_hub, coalesce(store_sales, 0) AS s_all,
         coalesce(non_hub_sales, 0) AS s_nonhub,
         coalesce(to_store_transfers, 0) AS tr_store, coalesce(to_hub_transfers, 0) AS tr_hub,
         coalesce(v.virtual_arrivals, 0) AS virtual
  FROM item a
  LEFT JOIN item r ON r.id = a.rel
  LEFT JOIN pos o ON CAST(o.p AS VARCHAR) = a.code
  LEFT JOIN pos x ON CAST(x.p AS VARCHAR) = r.code
  LEFT JOIN a_{site} sa ON sa.code = a.code
  LEFT JOIN a_own oa ON oa.code = r.code
  LEFT JOIN a_hub ha ON ha.code = r.code
  LEFT JOIN ch ON ch.key = r.code LEFT JOIN tr ON tr.key = r.code
  LEFT JOIN virt v ON v.key = r.code
  WHERE a.id IN (SELECT seen_id FROM seen)
),
kept AS (
  SELECT *, {whole("site_h")} + {whole("site_arr")} - {whole("site_r")} AS avail,
         own_h + site_h2 + hub_h + other_h + own_arr + s_hub + s_all AS total,
         maker NOT IN ('Brand#1', 'Brand#2') AS allowed
  FROM cand WHERE {whole("site_h")} + site_arr > 0
),
needs AS (
  SELECT *, CASE WHEN total = 0 AND allowed AND category IN ('SMALL', 'MEDIUM') THEN 20
                 WHEN total = 0 AND allowed THEN 5 ELSE 0 END AS base,
         greatest(CASE WHEN s_nonhub > 0 AND allowed
           THEN {dec("1.5 * s_nonhub - (own_h + tr_store + own_arr - own_r)", 18, 2)}
           ELSE 0 END, 0) AS store_need,
         greatest(CASE WHEN s_hub > 0 AND allowed
           THEN {dec("s_hub - (hub_h + tr_hub + hub_arr - hub_r)", 18, 2)} ELSE 0 END, 0)
           AS hub_need
  FROM kept
),
capped AS (
  SELECT *, CASE WHEN base > avail THEN greatest(avail, 0) ELSE base END AS minimum,
         CAST(round(CASE WHEN store_need > avail THEN greatest(avail, 0) ELSE store_need END, 0)
              AS DECIMAL(18,0)) AS store,
         CAST(round(CASE WHEN hub_need > avail THEN greatest(avail, 0) ELSE hub_need END, 0)
              AS DECIMAL(18,0)) AS hub
  FROM needs
),
final AS (
  SELECT *, CASE WHEN CAST(hub AS BIGINT) > left_over THEN left_over
                 ELSE CAST(CAST(hub AS BIGINT) AS DOUBLE) END AS hub_final
  FROM (SELECT *, site_h + {whole("site_arr")} - site_r - CAST(store AS BIGINT) AS left_over
        FROM capped)
)"""


TRANSFER_SELECT = f"""
SELECT code, category, maker, name AS description, coalesce(part_no, '') AS part_no,
       coalesce(related_code, '') AS related_code, {whole("site_h")} AS site_stock,
       {whole("site_r")} AS site_reserved, {whole("site_arr")} AS site_arrivals,
       {whole("own_h")} AS own_stock, {whole("own_arr")} AS own_arrivals,
       {whole("own_r")} AS own_reserved, {whole("hub_h")} AS hub_stock,
       {whole("hub_r")} AS hub_reserved, {whole("hub_arr")} AS hub_arrivals,
       s_hub AS hub_sales, s_all AS total_sales, minimum AS minimum_quantity,
       store AS store_suggestion, tr_store AS store_transfers, hub_final AS hub_suggestion,
       tr_hub AS hub_transfers, virtual AS virtual_arrivals
FROM final"""

ORACLE["transfer_suggestions"] = query(transfer_steps("dsv"), TRANSFER_SELECT)
ORACLE["transfer_suggestions_tql"] = query(transfer_steps("tql"), TRANSFER_SELECT)
ORACLE["minimum_quantity"] = query(
    transfer_steps("dsv"),
    """SELECT code, avail AS available, total AS activity, minimum AS minimum_quantity
       FROM final""",
)
ORACLE["own_store_suggestion"] = query(
    transfer_steps("dsv"),
    "SELECT code, avail AS available, store AS store_suggestion FROM final",
)
ORACLE["hub_suggestion"] = query(
    transfer_steps("dsv"),
    """SELECT code, avail AS available, hub AS hub_wanted, hub_final AS hub_suggestion
       FROM final""",
)
ORACLE["flag_positive"] = query(
    transfer_steps("dsv"),
    f"""SELECT code, {text("virtual")} AS virtual_arrivals, virtual > 0 AS flagged FROM final""",
)

# ---- deals ------------------------------------------------------------------------------------

DEAL_FACTS = f"""
{ARRIVALS},
virt AS ({VIRTUAL.format(f"{DSV_SUPPLIERS}, {TQL_SUPPLIERS}")}),
{RELATED},
s90 AS (SELECT code, sum(qty) AS q FROM sale WHERE age BETWEEN 0 AND 90 GROUP BY 1),
s90x AS (SELECT code, sum(qty) AS q FROM sale
         WHERE age BETWEEN 0 AND 90 AND kind IN (1, 2) GROUP BY 1),
s30 AS (SELECT code, sum(qty) AS q FROM sale WHERE age BETWEEN 0 AND 30 GROUP BY 1),
tr AS (SELECT code, sum(qty) AS q FROM dl
       WHERE state = 'P' AND kind = 2 AND findoc % 3 IN (0, 2) GROUP BY 1),
facts AS (
  SELECT a.*, r.code AS related_code, r.net AS related_net_price,
         coalesce(own_h, 0) AS own_h,
         coalesce(own_h, 0) + coalesce(tql_h, 0) + coalesce(dc_h, 0) + coalesce(dsv_h, 0) AS ready,
         coalesce(own_r, 0) + coalesce(tql_s, 0) + coalesce(dc_r, 0) + coalesce(dsv_r, 0) AS des,
         coalesce(inc, 0) AS inc, v.virtual_arrivals AS virt_raw,
         coalesce(v.virtual_arrivals, 0) AS virt,
         coalesce(a_own.q, 0) AS q_own, coalesce(a_tql.q, 0) AS q_tql,
         coalesce(a_dc.q, 0) AS q_dc, coalesce(a_dsv.q, 0) AS q_dsv,
         coalesce(a_own.q, 0) + coalesce(a_tql.q, 0) + coalesce(a_dc.q, 0)
           + coalesce(a_dsv.q, 0) AS q,
         coalesce(a_own.w, 0) + coalesce(a_tql.w, 0) + coalesce(a_dc.w, 0)
           + coalesce(a_dsv.w, 0) AS w,
         coalesce(s90.q, 0) AS sold_90_all, coalesce(s90x.q, 0) AS sold_90_exp,
         coalesce(s30.q, 0) AS sold_30, coalesce(tr.q, 0) AS tr,
         coalesce(x.v, 0) AS related_stock, coalesce(y.v, 0) AS related_arrivals,
         coalesce(z.v, 0) AS related_reserved,
         this.fifo AS fifo, last.fifo AS fifo_last, this.std AS std
  FROM item a
  LEFT JOIN item r ON r.id = a.rel
  LEFT JOIN pos ON CAST(p AS VARCHAR) = a.code
  LEFT JOIN a_own ON a_own.code = a.code LEFT JOIN a_tql ON a_tql.code = a.code
  LEFT JOIN a_dc ON a_dc.code = a.code LEFT JOIN a_dsv ON a_dsv.code = a.code
  LEFT JOIN virt v ON v.key = r.code
  LEFT JOIN s90 ON s90.code = a.code LEFT JOIN s90x ON s90x.code = a.code
  LEFT JOIN s30 ON s30.code = r.code LEFT JOIN tr ON tr.code = a.code
  LEFT JOIN rel_stock x ON x.k = r.code LEFT JOIN rel_coming y ON y.k = 'ID' || r.code
  LEFT JOIN rel_reserved z ON z.k = r.code
  LEFT JOIN cost this ON this.c_mtrl = a.id AND this.fy = {FISCAL}
  LEFT JOIN cost last ON last.c_mtrl = a.id AND last.fy = {FISCAL - 1}
)"""

DEAL_COMMON = """
    code, category, maker, name AS description, ready AS ready_stock, des AS reserved,
    {own} AS own_stock, ready - des AS free_stock, inc AS incoming, {actual} AS actual_stock,
    {b2b} AS actual_b2b, {virt} AS virtual_arrivals, {final} AS final_stock, {s90} AS sold_90,
    sold_30, CASE WHEN w = 0 THEN std ELSE w END AS standard_cost, {fifo} AS fifo_price,
    {net} AS net_retail, {cost} AS blended_cost, coalesce(part_no, '') AS part_no,
    coalesce(specs, '') AS specs, coalesce(related_code, '') AS related_code, related_stock,
    related_arrivals, related_reserved,
    related_stock + related_arrivals - related_reserved AS related_net,
    q_own AS own_arrivals, q_tql AS tql_arrivals, q_dc AS dc_arrivals, q_dsv AS dsv_arrivals"""

BRANCH_1 = DEAL_COMMON.format(
    own="own_h - virt",
    actual="CAST(NULL AS DOUBLE)",
    b2b="ready + inc - (des + tr)",
    virt="virt_raw",
    final="inc + (ready - virt) - des",
    s90="sold_90_all",
    fifo="fifo",
    net="related_net_price",
    cost="""(coalesce((greatest(own_h - virt, 0) + ready - own_h) * fifo, 0) + q * w)
            / nullif(greatest(own_h - virt, 0) + ready - own_h + q, 0)""",
)
BRANCH_2 = DEAL_COMMON.format(
    own="own_h",
    actual="inc + ready - des",
    b2b="CAST(NULL AS DOUBLE)",
    virt="CAST(NULL AS DOUBLE)",
    final="inc",
    s90="sold_90_exp",
    fifo="coalesce(fifo, fifo_last)",
    net="net",
    cost="(coalesce(ready * coalesce(fifo, fifo_last), 0) + q * w) / nullif(ready + q, 0)",
)

DEAL_STEPS = f"""{DEAL_FACTS},
main AS (
  SELECT id, {BRANCH_1} FROM facts
  WHERE category IN ('ECONOMY', 'PROMO')
    AND (ready - virt + q > 1
         OR (CASE WHEN category ILIKE '%tandar%' THEN ready - virt + q ELSE 0 END) > 5)
  UNION
  SELECT id, {BRANCH_2} FROM facts
  WHERE category IN ('SMALL', 'STANDARD')
    AND (ready + inc - des > 9 OR inc > 9
         OR (CASE WHEN category ILIKE '%tandar%' THEN ready + q ELSE 0 END) > 5)
    AND maker <> 'Brand#3'
),
detail AS (
  SELECT id, code, category, maker, description, {whole("free_stock")} AS free_stock,
         {whole("incoming")} AS incoming, {whole("actual_stock")} AS actual_retail_only,
         {whole("actual_b2b")} AS actual_b2b, virtual_arrivals,
         {whole("coalesce(actual_stock, final_stock)")} AS final_stock, sold_90, sold_30,
         {dec("standard_cost", 10, 2)} AS standard_cost, {dec("fifo_price", 10, 2)} AS fifo_price,
         {dec("net_retail", 10, 2)} AS net_retail, {dec("blended_cost", 10, 2)} AS blended_cost,
         part_no, specs, related_code, {whole("related_stock")} AS related_stock,
         {whole("related_arrivals")} AS related_arrivals,
         {whole("related_reserved")} AS related_reserved,
         {whole("related_net")} AS related_net
  FROM main
  WHERE (actual_b2b > 0 OR actual_b2b IS NULL)
    AND code NOT IN (SELECT related_code FROM main WHERE description ILIKE '%RING%')
),
header AS (
  SELECT DISTINCT CASE WHEN category ILIKE '%tandard%' THEN 'Standrad' ELSE category END AS category
  FROM main
),
shown AS (
  SELECT category FROM header
  WHERE category IN (SELECT category FROM detail) OR category = 'Standrad'
)"""

ORACLE["stock_position_metrics"] = query(
    DEAL_STEPS,
    """SELECT code, ready_stock, reserved, own_stock, free_stock, incoming, actual_stock,
              actual_b2b, virtual_arrivals, final_stock FROM main""",
)
ORACLE["deal_candidates"] = query(
    DEAL_STEPS,
    f"""SELECT * EXCLUDE (id) REPLACE ({money("standard_cost")} AS standard_cost,
                                       {money("blended_cost")} AS blended_cost) FROM main""",
)
ORACLE["standard_cost"] = query(
    DEAL_STEPS, f"SELECT code, category, {money('standard_cost')} AS standard_cost FROM main"
)
ORACLE["blended_cost"] = query(
    DEAL_STEPS,
    f"""SELECT code, category, fifo_price, {money("blended_cost")} AS blended_cost FROM main""",
)
ORACLE["exclude_related_items"] = query(DEAL_STEPS, "SELECT * EXCLUDE (id) FROM detail")
ORACLE["category_header_rows"] = query(DEAL_STEPS, "SELECT category FROM shown")

DEAL_REPORT = f"""
SELECT r.* EXCLUDE (id),
       CASE WHEN category IN ('ECONOMY', 'SMALL') THEN 1
            WHEN category ILIKE '%standard%' THEN 3 ELSE 2 END AS block,
       CASE category WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 ELSE 0 END AS rank
FROM (
  SELECT d.*, coalesce(suppliers, '') AS suppliers, 1 AS is_detail
  FROM detail d LEFT JOIN lists ON list_item = d.id
  UNION ALL BY NAME
  SELECT category, 0 AS is_detail FROM shown
) r"""
ORACLE["deal_report"] = query(f"{DEAL_STEPS},\n{DEAL_LISTS}", DEAL_REPORT)

# ---- export and retail ------------------------------------------------------------------------


def present(c: str, row: str) -> str:
    return f"CASE WHEN {row} IS NOT NULL THEN coalesce({c}, 0) END"


def net(p: str) -> str:
    on_hand = " + ".join(f"coalesce({p}.{s}_h, 0)" for s in ("own", "hub", "dsv", "tql", "dc"))
    reserved = " + ".join(f"coalesce({p}.{s}_r, 0)" for s in ("own", "hub", "dsv", "tql", "dc"))
    return f"({on_hand} + {p}.inc) - ({reserved})"


def blank(c: str) -> str:
    return f"coalesce({text(c)}, '')"


BOTH_STOCKS = f"""
both_stocks AS (
  SELECT a.id AS stock_item, r.code AS rcode, {present("e.own_h", "e.p")} AS export_stock,
         e.inc AS export_incoming,
         {present("e.own_r", "e.p")} AS export_reserved, {net("e")} AS export_net,
         {blank(present("t.own_h", "t.p"))} AS retail_stock, {blank("t.inc")} AS retail_incoming,
         {blank(present("t.own_r", "t.p"))} AS retail_reserved, {net("t")} AS retail_net,
         r.net AS retail_price, r.id AS retail_id
  FROM item a LEFT JOIN item r ON r.id = a.rel
  LEFT JOIN pos e ON CAST(e.p AS VARCHAR) = a.code
  LEFT JOIN pos t ON CAST(t.p AS VARCHAR) = r.code
)"""

ORACLE["export_vs_retail_stock"] = query(
    BOTH_STOCKS,
    """SELECT stock_item AS item_id, export_stock, export_incoming, export_reserved, export_net,
              retail_stock, retail_incoming, retail_reserved, retail_net FROM both_stocks""",
)

EXPORT_STEPS = f"""
allbought AS (SELECT * FROM dl WHERE state = 'O'),
{supplier_lists("allbought")},
{BOTH_STOCKS},
months AS ({MONTHS}),
lines AS ({EXPORT_INVOICES} UNION {EXPORT_PENDING})"""


def month(k: int) -> str:
    return (
        f"CASE WHEN rcode IS NULL THEN '' ELSE {text(f'coalesce(m.month_{k}, 0)')} END AS month_{k}"
    )


EXPORT_SELECT = f"""
SELECT doc_date, doc_no, warehouse, branch, country, customer, state, item_code, description,
       coalesce(part_no, '') AS part_no, category, maker, quantity, euro_price, foreign_price,
       discount, line_value, {dec("fifo", 10, 0)} AS fifo_cost, export_stock, export_incoming,
       export_reserved, export_net, coalesce(rcode, '') AS retail_code, retail_stock,
       retail_incoming, retail_reserved, retail_net,
       CASE WHEN rcode IS NULL THEN '' ELSE {text("retail_price")} END AS net_retail,
       {month(3)}, {month(2)}, {month(1)}, {month(0)}, suppliers
FROM lines l
LEFT JOIN cost ON c_mtrl = l.item_id AND fy = year(doc_date)
LEFT JOIN both_stocks ON stock_item = l.item_id
LEFT JOIN months m ON m.item_id = retail_id
LEFT JOIN lists ON list_item = l.item_id"""
ORACLE["export_report"] = query(EXPORT_STEPS, EXPORT_SELECT)


def retail(year: int) -> str:
    steps = f"""
    bought AS (
      SELECT *, CAST(quarter(d) AS INTEGER) AS qu FROM dl
      WHERE state = 'O' AND kind IN (1, 2, 3, 4) AND category NOT ILIKE 'PROMO%'
        AND year(d) = {year} AND qty >= 1
    ),
    totals AS (SELECT category AS cat, qu AS tq, sum(qty) AS total FROM bought GROUP BY 1, 2)"""
    return query(
        steps,
        f"""SELECT CAST(year(d) AS INTEGER) AS year, qu AS quarter, c_mktsegment AS branch,
               category,
               CAST(s_suppkey AS VARCHAR) AS supplier_code, s_name AS supplier,
               sum(qty) AS quantity, {money("sum(val)", 2)} AS value,
               {dec("sum(qty) / total * 100", 10, 2)} AS share_pct, total AS category_quantity
        FROM bought LEFT JOIN totals ON cat = category AND tq = qu
        GROUP BY year(d), qu, c_mktsegment, category, s_suppkey, s_name, total""",
    )


ORACLE["retail_category_share"] = retail(YEAR)
ORACLE["sink_full_refresh"] = retail(YEAR)
ORACLE["sink_versioned_refresh"] = retail(YEAR)
ORACLE["sink_year_slice"] = f"""
    SELECT *, {YEAR} AS report_year FROM ({retail(YEAR)})
    UNION ALL
    SELECT *, {YEAR - 1} AS report_year FROM ({retail(YEAR - 1)})"""

ORACLE["report_row_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS report, count(*) AS report_rows FROM ({sql})"
    for name, sql in (
        ("retail", retail(YEAR)),
        ("export", ORACLE["export_report"]),
        ("transfers", ORACLE["transfer_suggestions"]),
        ("deals", ORACLE["deal_report"]),
    )
)

ORACLE["written_report_counts"] = ORACLE["report_row_counts"]

# ---- from one run to the next -----------------------------------------------------------------

NEXT_RUN = """
current_rows AS (
  SELECT p_partkey, p_name AS description,
         CASE WHEN p_partkey % 4 = 0 THEN ' ' || p_partkey || '.0 '
              ELSE CAST(p_partkey AS VARCHAR) END AS code FROM part
),
previous_rows AS (
  SELECT p_partkey AS prev, p_retailprice AS last_price,
         CASE WHEN p_partkey % 5 = 0 THEN p_retailprice * 0.9 END AS new_price
  FROM part WHERE p_partkey % 3 <> 0
)"""

ORACLE["new_items"] = f"""WITH {NEXT_RUN}
    SELECT code, description, CASE WHEN prev IS NULL THEN 'NEW' END AS status
    FROM current_rows LEFT JOIN previous_rows ON prev = p_partkey"""

ORACLE["carry_forward_overrides"] = f"""WITH {NEXT_RUN}
    SELECT code, description, {money("coalesce(new_price, last_price)", 2)} AS last_price,
           CAST(NULL AS DOUBLE) AS new_price
    FROM current_rows LEFT JOIN previous_rows ON prev = p_partkey"""

ORACLE["normalised_keys"] = """
    SELECT p_partkey, CASE p_partkey % 6 WHEN 2 THEN 'AB-' || p_partkey WHEN 3 THEN NULL
                      WHEN 4 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS normalised
    FROM part"""

ORACLE["coerce_integers"] = """
    SELECT p_partkey, CASE WHEN p_partkey % 6 IN (0, 1, 5) THEN p_partkey END AS raw FROM part"""

ORACLE["deal_export"] = query(
    f"{DEAL_STEPS},\n{DEAL_LISTS},\n{NEXT_RUN}",
    f"""SELECT r.* EXCLUDE (block, rank, is_detail),
               CASE WHEN code IS NOT NULL AND prev IS NULL THEN 'NEW' END AS status,
               {money("coalesce(new_price, last_price)", 2)} AS last_price,
               CAST(NULL AS DOUBLE) AS new_price
        FROM ({DEAL_REPORT}) r LEFT JOIN previous_rows ON CAST(prev AS VARCHAR) = code""",
)

ORACLE["deal_export_second_run"] = f"""
    SELECT code, category, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS DOUBLE) AS new_price,
           CASE WHEN code IS NULL THEN NULL WHEN incoming % 2 = 0 THEN free_stock + 0.25
                ELSE last_price END AS last_price
    FROM ({ORACLE["deal_export"]})"""


def headed(sql: str, labels: dict[str, str]) -> str:
    """The columns of ``sql`` under their headings; one it lacks is NULL."""
    columns = ", ".join(f'{column} AS "{heading}"' for column, heading in labels.items())
    return f"SELECT {columns} FROM ({sql})"


ORACLE["labelled_deal_report"] = headed(
    f"""SELECT *, CAST(NULL AS DOUBLE) AS last_price, CAST(NULL AS DOUBLE) AS new_price,
               CAST(NULL AS VARCHAR) AS status FROM ({ORACLE["deal_report"]})""",
    DEAL_LABELS,
)
ORACLE["labelled_transfer_report"] = headed(
    ORACLE["transfer_suggestions"], transfer_labels(SAMPLE_CONFIG.dsv)
)
ORACLE["labelled_export_report"] = headed(ORACLE["export_report"], EXPORT_LABELS)

ORACLE["labelled_retail_report"] = f"""
    SELECT year AS "Έτος", quarter AS "Τρίμηνο", branch AS "Υποκ/μα",
           category AS "Εμπορ.κατηγορία", supplier_code AS "Κωδικός", supplier AS "Προμηθευτής",
           quantity AS "Συνολική Ποσότητα", value AS "Συνολική Αξία", share_pct AS "Ποσοστό %",
           category_quantity AS "Σύνολο Αγορασθέντων"
    FROM ({retail(YEAR)})"""
