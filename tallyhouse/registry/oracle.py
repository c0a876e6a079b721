"""DuckDB twins of the registered queries, written from the given tables up."""

from __future__ import annotations

#: Fixed values of the studies, stated here again so that the twins share nothing with what they judge.
PRODUCTS = (
    "Cake Red Velvet",
    "Cake Chocolate Temptation",
    "Cheesecake Pistachio",
    "Macarons French",
    "Cake Carrot",
    "Cake Cappuccino",
    "Cheesecake Dulce de Leche",
    "Cheesecake Strawberry",
    "Tiramisu With Ladyfingers",
    "Tiramisu",
    "Cheesecake Chocolate Ganache",
    "Cake Torta Nocciola",
    "Tart Mixed Berry",
    "Cake Ricotta and Pistachio",
    "Cake Chocolate Fondant",
    "Cake Tres Leches",
    "Cake Red Velvet Mini Gluten Free",
    "Cheesecake Brownie",
)
EXACT_NAMES = {
    "torta nocciola": "Cake Torta Nocciola",
    "red velvet cake": "Cake Red Velvet",
    "mini gf red velvet cake": "Cake Red Velvet Mini Gluten Free",
    "mini gluten-free red velvet": "Cake Red Velvet Mini Gluten Free",
    "tres leches cake": "Cake Tres Leches",
    "chocolate ganache cheesecake": "Cheesecake Chocolate Ganache",
    "macarons french collection": "Macarons French",
    "french macarons": "Macarons French",
    "macaron": "Macarons French",
    "strawberry cheesecake": "Cheesecake Strawberry",
    "tiramisu individual": "Tiramisu",
    "tiramisu big ladyfinger": "Tiramisu With Ladyfingers",
    "tiramisu with ladyfingers": "Tiramisu With Ladyfingers",
    "mixed berry tart": "Tart Mixed Berry",
    "chocolate temptation cake": "Cake Chocolate Temptation",
    "cheesecake pistachio": "Cheesecake Pistachio",
    "pistachio cheesecake": "Cheesecake Pistachio",
    "cappuccino cake": "Cake Cappuccino",
    "carrot cake": "Cake Carrot",
    "dulce de leche cheesecake": "Cheesecake Dulce de Leche",
    "chocolate fondant cake": "Cake Chocolate Fondant",
    "cheesecake brownie": "Cheesecake Brownie",
    "brownie cheesecake": "Cheesecake Brownie",
    "ricotta & pistachio cake": "Cake Ricotta and Pistachio",
    "ricotta and pistachio cake": "Cake Ricotta and Pistachio",
}


def rdiv(num: str, den: str, places: int) -> str:
    """num / den rounded half away from zero in integer arithmetic, as a double."""
    n = f"CAST(({num}) * 1000 AS HUGEINT)"
    d = f"CAST(({den}) * 1000 AS HUGEINT)"
    return (
        f"CASE WHEN {d} <> 0 THEN CAST(sign({n}) * sign({d}) * "
        f"((2 * abs({n}) * {10**places} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {10**places} END"
    )


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def key(x: str) -> str:
    return f"CAST(('0x' || substr(md5({x}), 1, 15)) AS BIGINT)"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def cases(pairs: dict, col: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


RC_A = {"STANDARD": "Beverages", "PROMO": "FOOD", "LARGE": "Retail", "SMALL": "Combo Meal",
        "ECONOMY": "NO TAX", "MEDIUM": "Hot Food"}
RC_B = {"STANDARD": "Beverages(1024306750423249)", "PROMO": "Bottled Drinks(2024)",
        "LARGE": "Retail Items(3024)", "SMALL": "Bakery(4024)", "ECONOMY": "Gift Cards(5024)",
        "MEDIUM": "Grab & Go(6024)"}
DEST = {"1-URGENT": "Dine In", "2-HIGH": "DRIVE THRU", "3-MEDIUM": "To Go",
        "4-NOT SPECIFIED": "Delivery", "5-LOW": "Catering"}
FIRST = {"small": "Mini Gluten Red Velvet", "red": "Red Velvet", "blue": "Pistashio",
         "hot": "Choc Ganache", "old": "Carot", "large": "Tiramiso", "new": "Ricota",
         "cold": "Strabery"}
SECOND = {"ring": "Cake", "widget": "Chees Cake", "bolt": "Cupcake", "gear": "Tart",
          "gizmo": "Latte", "plate": "Ladyfinger", "rod": "Brawni Cheesecake",
          "anvil": "Individual"}

CAT_A = """CASE WHEN regexp_matches(lower({0}), 'beverage') THEN 'Beverage'
 WHEN regexp_matches(lower({0}), 'food') THEN 'Food' WHEN regexp_matches(lower({0}), 'retail') THEN 'Retail'
 WHEN regexp_matches(lower({0}), 'combo') THEN 'Food' ELSE 'Other' END"""
CAT_B = """CASE WHEN regexp_matches(lower(split_part({0}, '(', 1)), 'beverage|bottled drink') THEN 'Beverage'
 WHEN regexp_matches(lower(split_part({0}, '(', 1)), 'food|bakery|grab|taste of italy|combo|cold good') THEN 'Food'
 WHEN regexp_matches(lower(split_part({0}, '(', 1)), 'retail') THEN 'Retail' ELSE 'Other' END"""
STORE = """upper(trim(CASE WHEN lower({0}) LIKE 'bluebird coffee %' THEN substr({0}, 17)
 WHEN lower({0}) LIKE 'bluebird %' THEN substr({0}, 10) ELSE {0} END))"""
CANON_A = r"regexp_replace({0}, '^[0-9]+\s*OZ\s+', '')"
CANON_B = r"regexp_replace({0}, '\s*\(\s*[0-9]+\s*OZ\s*\)\s*[A-Z]{{0,3}}\s*$', '')"

LINES = f"""
ln AS (
 SELECT o_orderkey AS ok, o_custkey AS ck, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pri,
  CAST(o_totalprice AS DECIMAL(18,2)) AS otot, l_linenumber AS lno, l_partkey AS pk, l_suppkey AS sk,
  CAST(l_quantity AS DECIMAL(18,3)) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS disc,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS net,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tax,
  l_returnflag AS rf, p_name, p_type, p_size, s_name, n_nationkey AS nk,
  CASE n_nationkey WHEN 1 THEN 'Las Vegas' WHEN 2 THEN 'Meijer Midtown' ELSE n_name END AS store,
  CASE WHEN o_orderkey % 2 = 1 THEN 'feed_b' WHEN o_orderkey % 10 = 4 THEN 'feed_c' ELSE 'feed_a' END AS feed
 FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey),
lx AS (
 SELECT *, CAST(d + CAST(ok % 5 AS INTEGER) AS TIMESTAMP) + INTERVAL 8 HOUR AS ing,
  CAST(d AS TIMESTAMP) + INTERVAL 1 MINUTE * CAST((ok * 37) % 1440 AS INTEGER) AS closed,
  CASE nk % 3 WHEN 0 THEN 'Bluebird Coffee ' || store WHEN 1 THEN 'BLUEBIRD ' || store
   ELSE ' ' || store || ' ' END AS loc,
  (lno = 7 AND rf = 'R') AS void, (lno = 6 AND rf = 'R') AS modi,
  'DDBB_' || strftime(d, '%b_%y') || '.csv' AS file_a,
  'bluebirdcoffee-hqaccount_bluebirdcoffee' || lower(replace(store, ' ', '_')) || '_transactions_all.csv' AS file_b,
  CASE WHEN sk % 10 = 0 THEN NULL WHEN sk % 10 = 1 THEN CAST(sk + 673508000 AS VARCHAR)
   ELSE lower(s_name) || ' ' END AS emp_a,
  CASE WHEN ck % 50 <> 0 THEN {cases(DEST, 'pri')} END AS dest_a,
  CASE WHEN d < DATE '1998-07-01' THEN p_size || 'OZ ' || p_name ELSE p_size || ' OZ ' || p_name || ' ' END AS name_a,
  {cases(RC_A, 'p_type')} AS rc_a,
  CASE WHEN lno = 6 AND rf = 'R' THEN 'Modifiers(7024)' ELSE {cases(RC_B, 'p_type')} END AS grp_b,
  CASE WHEN sk % 10 <> 0 THEN s_name END AS staff_b,
  {cases(FIRST, "split_part(p_name, ' ', 1)")} || ' ' || {cases(SECOND, "split_part(p_name, ' ', 2)")} AS dessert,
  lno || '-' || pk || '-' || sk || '-' || CAST(q AS INTEGER) AS entry
 FROM ln),
ra AS (SELECT loc, d, emp_a AS emp, pk, name_a AS iname, CAST(pk * 10 AS DOUBLE) AS plu, price, disc, tax,
  net, rc_a AS rc, dest_a AS dest, void, modi, CAST(ok AS VARCHAR) AS oid, 'feed_a' AS src, ing, file_a
 FROM lx WHERE feed = 'feed_a'),
rc AS (SELECT loc, d, CAST(ok % 7 + 5000 AS VARCHAR) AS emp, pk, CAST(NULL AS VARCHAR) AS iname,
  CAST(NULL AS DOUBLE) AS plu, price, CAST(NULL AS DECIMAL(18,2)) AS disc,
  CAST(otot * 0.05 AS DECIMAL(18,2)) AS tax, net, CAST(p_size + 640207700 AS VARCHAR) AS rc,
  substr(pri, 1, 1) AS dest, void, FALSE AS modi, CAST(ok AS VARCHAR) AS oid, 'feed_c' AS src, ing,
  CAST(NULL AS VARCHAR) AS file_a, entry, store FROM lx WHERE feed = 'feed_c'),
rb AS (SELECT ok || '-' || lno || '-' || pk || '-' || sk AS ident, d, CAST(ck AS VARCHAR) AS account,
  staff_b AS staff, CAST(ok AS VARCHAR) AS ref, CASE WHEN lno = 3 THEN 'UPDATE' ELSE 'SALE' END AS typ,
  CASE WHEN rf = 'R' THEN -q ELSE q END AS qty, CASE WHEN rf = 'R' THEN -net ELSE net END AS fp, disc, tax,
  ' ' || p_name || ' (' || p_size || ' oz) m' AS item, grp_b AS grp, 'Bluebird Coffee ' || store AS loc,
  ing, file_b FROM lx WHERE feed = 'feed_b' AND NOT void),
bac AS (SELECT loc, d, emp, pk, iname, plu, price, disc, tax, net, rc, dest, void, modi, oid, src, ing FROM ra
 UNION ALL SELECT loc, d, emp, pk, iname, plu, price, disc, tax, net, rc, dest, void, modi, oid, src, ing
 FROM rc WHERE (loc, d) NOT IN (SELECT loc, d FROM ra)),
cat AS (SELECT pk AS item_id, upper(trim(iname)) AS item_name, plu AS item_plu, rc AS revenue_center
 FROM ra WHERE trim(iname) <> ''
 QUALIFY row_number() OVER (PARTITION BY pk ORDER BY d DESC, upper(trim(iname)), plu, rc) = 1),
en AS (SELECT b.*, CASE WHEN regexp_full_match(b.rc, '[0-9]+') THEN c.revenue_center ELSE b.rc END AS erc,
  coalesce(upper(trim(b.iname)), c.item_name) AS ename FROM bac b LEFT JOIN cat c ON c.item_id = b.pk),
sa AS (SELECT d AS sale_date, {STORE.format('loc')} AS store_name, {CAT_A.format('erc')} AS revenue_center,
  net AS net_sales, oid AS order_id, oid AS order_ref, CAST(1 AS DECIMAL(18,3)) AS qty,
  CAST(0 AS DECIMAL(18,2)) AS tip_amount, upper(trim(dest)) AS destination,
  upper(trim(emp)) AS employee_name, tax AS tax_amount, disc AS discount_total, ename AS product_name,
  {CANON_A.format('ename')} AS product_canonical_name, src AS _source_system, ing AS _ingested_at
 FROM en WHERE void = FALSE AND modi = FALSE AND net IS NOT NULL),
sb AS (SELECT d AS sale_date, {STORE.format('loc')} AS store_name, {CAT_B.format('grp')} AS revenue_center,
  fp AS net_sales, account AS order_id, ref AS order_ref, qty, CAST(0 AS DECIMAL(18,2)) AS tip_amount,
  CAST(NULL AS VARCHAR) AS destination, upper(trim(staff)) AS employee_name, tax AS tax_amount,
  disc AS discount_total, upper(trim(item)) AS product_name,
  {CANON_B.format('upper(trim(item))')} AS product_canonical_name, 'feed_b' AS _source_system,
  ing AS _ingested_at FROM rb WHERE lower(split_part(grp, '(', 1)) NOT LIKE '%modifier%' AND fp IS NOT NULL),
st AS (SELECT * FROM sa UNION ALL SELECT * FROM sb),
dd AS (SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS date_key, CAST(x AS DATE) AS date,
  CAST(isodow(x) AS INTEGER) AS day_of_week, dayname(x) AS day_name, CAST(week(x) AS INTEGER) AS week_number,
  CAST(month(x) AS INTEGER) AS month, monthname(x) AS month_name, CAST(quarter(x) AS INTEGER) AS quarter,
  CAST(year(x) AS INTEGER) AS year, isodow(x) > 5 AS is_weekend
 FROM (SELECT unnest(generate_series(CAST(date_trunc('year', min(sale_date)) AS TIMESTAMP), CAST(make_date(CAST(year(max(sale_date)) + 3 AS INTEGER), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS x FROM st)),
ds AS (SELECT {key('store_name')} AS store_key, store_name,
  CAST(CASE WHEN starts_with(store_name, 'MEIJER') THEN 0.04 WHEN store_name = 'LAS VEGAS' THEN 0.08
   ELSE 0.07 END AS DECIMAL(5,2)) AS royalty_rate, TRUE AS is_active FROM (SELECT DISTINCT store_name FROM st)),
pn AS (SELECT DISTINCT upper(trim(iname)) AS n, {CANON_A.format('upper(trim(iname))')} AS c,
  {CAT_A.format('rc')} AS r, 1 AS p FROM bac WHERE trim(iname) <> '' AND NOT void AND NOT modi
 UNION ALL SELECT DISTINCT upper(trim(item)), {CANON_B.format('upper(trim(item))')}, {CAT_B.format('grp')}, 2
 FROM rb WHERE trim(item) <> '' AND lower(split_part(grp, '(', 1)) NOT LIKE '%modifier%'),
dp AS (SELECT {key('n')} AS product_key, n AS product_name, c AS product_canonical_name, r AS revenue_center_name
 FROM pn QUALIFY row_number() OVER (PARTITION BY n ORDER BY p, r, c) = 1
 UNION ALL SELECT 0, 'UNKNOWN', 'UNKNOWN', 'Other'),
dx AS (SELECT {key('n')} AS destination_key, n AS destination_name,
  CASE WHEN n LIKE '%DINE%' THEN 'In-Store' WHEN n LIKE '%DRIVE%' THEN 'Drive-Thru' WHEN n LIKE '%GO%' THEN 'Takeout'
   WHEN n LIKE '%DELIVERY%' THEN 'Delivery' WHEN n LIKE '%CATER%' THEN 'Catering' ELSE 'Other' END AS channel
 FROM (SELECT DISTINCT upper(trim(dest)) AS n FROM bac WHERE trim(dest) <> '')
 UNION ALL SELECT 0, 'UNKNOWN', 'Unknown'),
de AS (SELECT {key('n')} AS employee_key, n AS employee_name FROM (
  SELECT upper(trim(emp)) AS n FROM bac WHERE trim(emp) <> '' AND NOT regexp_full_match(emp, '[0-9]+')
  UNION SELECT upper(trim(staff)) FROM rb WHERE trim(staff) <> '')
 UNION ALL SELECT 0, 'UNKNOWN'),
cs AS (SELECT DISTINCT p_name AS product_canonical_name,
  CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'spring launch' WHEN 'blue' THEN 'spring launch'
   WHEN 'hot' THEN 'winter menu' WHEN 'cold' THEN 'summer menu' WHEN 'new' THEN 'all year' END AS campaign_name,
  CAST(CASE split_part(p_name, ' ', 1) WHEN 'red' THEN '2000-03-01' WHEN 'blue' THEN '2000-03-01'
   WHEN 'hot' THEN '2000-11-01' END AS DATE) AS campaign_start_date,
  CAST(CASE split_part(p_name, ' ', 1) WHEN 'red' THEN '2000-05-31' WHEN 'blue' THEN '2000-05-31'
   WHEN 'cold' THEN '1999-08-31' END AS DATE) AS campaign_end_date FROM part),
dc AS (SELECT {key('upper(campaign_name)')} AS campaign_key, upper(campaign_name) AS campaign_name,
  upper(product_canonical_name) AS product_canonical_name, campaign_start_date, campaign_end_date
 FROM cs WHERE campaign_name IS NOT NULL
 UNION ALL SELECT 0, 'NO CAMPAIGN', NULL, NULL, NULL),
og AS (SELECT _source_system AS source_system, order_ref AS order_id, max(store_name) AS store_name,
  max(destination) AS destination, max(sale_date) AS sale_date, sum(net_sales) AS order_net_sales,
  sum(discount_total) AS discount_total, sum(tax_amount) AS tax_amount, sum(tip_amount) AS tip_amount,
  max(_ingested_at) AS ing FROM st WHERE trim(order_ref) <> '' GROUP BY ALL),
fo AS (SELECT og.*, date_key, store_key, coalesce(destination_key, 0) AS destination_key,
  coalesce(channel, 'Unknown') AS channel, coalesce(dx.destination_name, 'UNKNOWN') AS dname, royalty_rate,
  CAST(date_trunc('month', sale_date) AS DATE) AS mon, day_of_week, day_name, month, month_name, quarter,
  year, is_weekend, strftime(sale_date, '%Y-%m') AS ym
 FROM og JOIN dd ON dd.date = sale_date JOIN ds USING (store_name)
 LEFT JOIN dx ON dx.destination_name = coalesce(destination, 'UNKNOWN')),
il AS (SELECT st.*, date_key, store_key, coalesce(product_key, 0) AS product_key,
  coalesce(destination_key, 0) AS destination_key, coalesce(employee_key, 0) AS employee_key,
  coalesce(dp.product_name, 'UNKNOWN') AS pname, dp.revenue_center_name AS pcat,
  CAST(date_trunc('month', sale_date) AS DATE) AS mon
 FROM st JOIN dd ON dd.date = sale_date JOIN ds USING (store_name)
 LEFT JOIN dp ON dp.product_name = upper(trim(st.product_name))
 LEFT JOIN dx ON dx.destination_name = coalesce(destination, 'UNKNOWN')
 LEFT JOIN de ON de.employee_name = coalesce(st.employee_name, 'UNKNOWN')
 WHERE trim(order_ref) <> ''),
fi AS (SELECT date_key, store_key, product_key, destination_key, _source_system AS source_system,
  order_ref AS order_id, mon, store_name, sale_date, sum(qty) AS qty, sum(net_sales) AS item_net_sales,
  max(_ingested_at) AS ing FROM il GROUP BY ALL),
fp AS (SELECT fi.*, product_name, product_canonical_name AS canon, revenue_center_name AS rcat,
  strftime(mon, '%Y-%m') AS ym FROM fi JOIN dp USING (product_key)),
fe AS (SELECT date_key, store_key, il.employee_key, mon, store_name, de.employee_name AS ename,
  strftime(mon, '%Y-%m') AS ym, sum(net_sales) AS net_sales, count(DISTINCT order_ref) AS order_count,
  sum(tip_amount) AS tip_amount, sum(tax_amount) AS tax_amount, sum(discount_total) AS discount_total,
  max(_ingested_at) AS ing FROM il JOIN de ON de.employee_key = il.employee_key GROUP BY ALL),
lmo AS (SELECT max(mon) AS m FROM fo),
lmi AS (SELECT max(mon) AS m FROM fi),
lme AS (SELECT max(mon) AS m FROM fe),
mf AS (SELECT source_name, filename, count(*) AS row_count, max(ing) AS loaded_at FROM (
  SELECT 'feed_a' AS source_name, file_a AS filename, ing FROM ra
  UNION ALL SELECT 'feed_b', file_b, ing FROM rb) GROUP BY ALL),
ta AS (SELECT *, CASE WHEN lno = 5 AND rf = 'R' THEN NULL ELSE net END AS cur,
  CASE WHEN lno = 5 AND rf = 'R' THEN -net ELSE net END AS acc FROM lx WHERE feed = 'feed_a'),
tb AS (SELECT *, CASE WHEN void THEN 'VOID' WHEN lno = 3 THEN 'UPDATE' WHEN lno = 4 AND rf = 'R' THEN
  'TRANSITORY_COMP' ELSE 'SALE' END AS typ, CASE WHEN rf = 'R' THEN -net ELSE net END AS fpx,
  CASE WHEN rf = 'R' THEN -q ELSE q END AS qx,
  CASE WHEN starts_with(p_name, 'new ') THEN 'Ricotta & Pistachio Cake ' ELSE dessert END AS item
 FROM lx WHERE feed = 'feed_b')
"""

ORD = "sum(order_net_sales)"
CNT = "count(*)"
TICKET = rdiv(ORD, CNT, 2)
SALES = f"{dbl(ORD)} AS net_sales, {big(CNT)} AS order_count"
STG = f"""sale_date, store_name, revenue_center, {dbl('net_sales')} AS net_sales, order_id, order_ref,
 {dbl('qty')} AS qty, {dbl('tip_amount')} AS tip_amount, destination, employee_name,
 {dbl('tax_amount')} AS tax_amount, {dbl('discount_total')} AS discount_total, product_name,
 product_canonical_name, _source_system, {ts('_ingested_at')} AS _ingested_at"""
ATT = f"""att AS (SELECT ym, mon, count(*) FILTER (drink) AS b, count(*) FILTER (drink AND food) AS p FROM (
 SELECT order_id, sale_date, mon, strftime(mon, '%Y-%m') AS ym, bool_or(pcat = 'Beverage') AS drink,
  bool_or(pcat = 'Food') AS food FROM il WHERE net_sales > 0 AND pcat IS NOT NULL GROUP BY ALL) GROUP BY ALL)"""
ATT_COLS = f"{big('b')} AS beverage_orders, {big('p')} AS paired_orders, {rdiv('p', 'b', 4)} AS attachment_rate_pct"
SIZED = """(product_name LIKE '{0} OZ %' OR product_name LIKE '{0}OZ %')"""
SUMMARY = f"""SELECT _source_system AS {{0}}, {big('count(DISTINCT order_id)')} AS order_count,
 {big('count(*)')} AS row_count, {dbl('sum(net_sales)')} AS net_sales, {dbl('sum(tax_amount)')} AS tax_amount,
 {dbl('sum(discount_total)')} AS discount_total, {big('count(*) - count(destination)')} AS null_destination,
 {big('count(*) - count(employee_name)')} AS null_employee{{1}} FROM st GROUP BY 1"""

WORDS = {
    "cheese": "cheesecake|cheese cake|chees cake|chesscake|chescake|chssecake|chz cake|chez cake|"
              "cheeze cake|cheescake|chesecake|cheeaecake|cheasecake|cheesecakw|che cake",
    "pist": "pistachio|pistashio|pistacio|piatachio|pitachio|pstachio",
    "ric": "ricotta|ricota|riotta|icotta",
    "brown": "browni|brawni|brwni",
    "tira": "tiramisu|taramisu|tiramiso|tirmisu",
    "straw": "strawberry|straberry|strabery|strwberry|strabrry|stwberry|trawberry",
}


def classified(x: str) -> str:
    """Keyword class of a name, as one CASE over regular expressions."""
    def has(words: str) -> str:
        return f"regexp_matches(lower(trim({x})), '{WORDS.get(words, words)}')"

    rungs = [
        (f"{has('velvet')} AND {has('mini|gluten')}", "Cake Red Velvet Mini Gluten Free"),
        (f"{has('red velvet|re velvet|red velt|redvelvet|rv cake')} AND NOT {has('mini|cupcake|cup cake')}",
         "Cake Red Velvet"),
        (has("temptation"), "Cake Chocolate Temptation"),
        (f"{has('ric')} AND ({has('pist')} OR {has('cak')})", "Cake Ricotta and Pistachio"),
        (f"{has('pist')} AND {has('cheese')} AND NOT {has('ric')}", "Cheesecake Pistachio"),
        (has("macaron"), "Macarons French"),
        (f"{has('carrot|carot')} AND {has('cak')}", "Cake Carrot"),
        (f"{has('cappuccino')} AND {has('cak')}", "Cake Cappuccino"),
        (f"{has('dulce')} AND ({has('cheese')} OR {has('leche')})", "Cheesecake Dulce de Leche"),
        (f"({has('straw')} AND {has('cheese')}) OR ({has('fragola')} AND {has('cheese')}) OR "
         f"({has('2 strawberry')} AND {has('cake')})", "Cheesecake Strawberry"),
        (f"{has('tira')} AND {has('ladyfinger')}", "Tiramisu With Ladyfingers"),
        (f"{has('tira')} AND NOT {has('latte')}", "Tiramisu"),
        (f"({has('ganache')} AND {has('cheese')}) OR {has('choc gan')}", "Cheesecake Chocolate Ganache"),
        (has("nocciola"), "Cake Torta Nocciola"),
        (f"{has('berry|bery')} AND {has('tart|trt|tar$')}", "Tart Mixed Berry"),
        (has("fondant"), "Cake Chocolate Fondant"),
        (has("tres lech"), "Cake Tres Leches"),
        (f"{has('brown')} AND {has('cheese')}", "Cheesecake Brownie"),
    ]
    return "CASE " + " ".join(f"WHEN {c} THEN '{p}'" for c, p in rungs) + " END"


def named(x: str) -> str:
    exact = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXACT_NAMES.items())
    return f"coalesce(CASE lower(trim({x})) {exact} END, {classified(x)})"


FOOD = f"""food AS (SELECT * FROM (
 SELECT d AS sale_date, loc AS location, {classified('dessert')} AS product, coalesce(cur, 0) AS net_sales,
  dessert AS item_name, 'feed_a' AS source FROM ta WHERE NOT void AND NOT modi
 UNION ALL SELECT d, 'Feed B', {named('item')}, fpx, item, 'feed_b' FROM tb WHERE typ = 'SALE')
 WHERE product IS NOT NULL)"""
FOOD_SUM = f"{dbl('sum(net_sales)')} AS net_sales, {big('count(*)')} AS units"
CHAN = """ch AS (SELECT d, dest_a AS dest, acc, coalesce(dest_a = 'DRIVE THRU', FALSE) AS lane, NOT modi AS item
 FROM ta WHERE contains(loc, 'NATION_1') AND NOT void)"""
CHAN_SUM = f"""{dbl("coalesce(sum(acc) FILTER (lane), 0)")} AS drive_sales, {big("count(*) FILTER (lane AND item)")} AS drive_items,
 {dbl("coalesce(sum(acc) FILTER (NOT lane), 0)")} AS other_sales, {big("count(*) FILTER (NOT lane AND item)")} AS other_items,
 {dbl('sum(acc)')} AS total_sales, {big('count(*) FILTER (item)')} AS total_items"""
HRS = """hr AS (SELECT CAST(hour(closed) AS INTEGER) AS h, d, ok, acc FROM ta
 WHERE loc LIKE '%NATION_2%' AND NOT void AND NOT modi)"""
HRS_SUM = f"{big('count(DISTINCT ok)')} AS orders, {dbl('sum(acc)')} AS net_sales"
ITEM = """it AS (SELECT d, emp_a AS employee, dest_a AS destination, ok, acc, disc, price FROM ta
 WHERE loc LIKE '%NATION%' AND lower(dessert) = 'red velvet cake' AND NOT void
 AND d >= DATE '1997-03-15' AND d < DATE '2001-03-01')"""
ITEM_SUM = f"""{big('count(*)')} AS transactions, {big('count(DISTINCT ok)')} AS orders, {dbl('sum(acc)')} AS net_sales,
 {dbl('sum(price)')} AS gross_sales, {dbl('sum(disc)')} AS total_discounts"""
ITEM_AVG = f"{rdiv('sum(acc)', 'count(acc)', 2)} AS avg_net_sales"
VERSION = f"{big('count(*)')} AS lines, {dbl('sum(net)')} AS net_sales"
RELOADED = "('2000-05-01', '2000-06-01', '2000-08-01')"


def q(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([LINES, *ctes]) + body


def not_null_counts(table: str, label: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, 'not_null({c})' AS check_name, "
        f"{big(f'count(*) - count({c})')} AS failures FROM {table}" for c in cols
    )


def repeated(label: str, table: str, cols: str) -> str:
    return (f"SELECT '{label}' AS table_name, {big('count(*)')} AS repeated_keys FROM "
            f"(SELECT {cols} FROM {table} GROUP BY {cols} HAVING count(*) > 1)")


def size(label: str, table: str) -> str:
    return f"SELECT '{label}' AS table_name, {big('count(*)')} AS row_count FROM {table}"


FE_NAMED = "employee_key <> 0 AND mon = (SELECT m FROM lme)"

TWINS: dict[str, str] = {
    "A1_feed_a_scan": q(f"""SELECT loc AS location, d AS sale_date, emp_a AS employee_name, pk AS item_id,
 dessert AS item_name, {dbl('price')} AS price, {dbl('cur')} AS net_sales, void AS voided, modi AS is_modifier,
 dest_a AS destination, CAST(ok AS VARCHAR) AS order_id, file_a AS _source_file, 'feed_a' AS _source_system FROM ta"""),
    "A2_feed_b_scan": q(f"""SELECT 'Bluebird Coffee ' || CASE nk WHEN 1 THEN 'Las_Vegas' WHEN 2 THEN 'Meijer_Midtown'
 ELSE 'Nation_' || nk END AS location, d AS sale_date, CAST(ck AS VARCHAR) AS account, staff_b AS staff,
 CAST(ok AS VARCHAR) AS reference, typ AS type, {dbl('qx')} AS qty, {dbl('fpx')} AS final_price, item,
 grp_b AS item_group, file_b AS _source_file FROM tb WHERE typ IN ('SALE', 'UPDATE')"""),
    "A2_line_balance": q(f"""SELECT file, {big('count(*)')} AS raw_lines, {big('count(*) FILTER (good)')} AS kept_lines,
 {big('count(*) FILTER (NOT good)')} AS filtered_lines, CAST(0 AS BIGINT) AS malformed_lines, CAST(0 AS BIGINT) AS undated_lines
 FROM (SELECT file_a AS file, TRUE AS good FROM ta UNION ALL SELECT file_b, typ IN ('SALE', 'UPDATE') FROM tb) GROUP BY file"""),
    "A3_mixed_dates": q(f"SELECT d AS day, CAST(hour(closed) AS INTEGER) AS hour, {big('count(*)')} AS lines FROM ta GROUP BY ALL"),
    "A4_feed_b_dates": q(f"SELECT d AS day, {big('count(*)')} AS lines FROM tb GROUP BY ALL"),
    "A5_clean_currency": q(f"""SELECT file_a AS file, {dbl('sum(cur)')} AS net_sales,
 {big('count(*) - count(cur)')} AS unreadable FROM ta GROUP BY ALL"""),
    "A6_clean_accounting": q(f"""SELECT file_a AS file, {dbl('sum(acc)')} AS net_sales,
 CAST(0 AS BIGINT) AS unreadable FROM ta GROUP BY file_a"""),
    "A7_lineage": q(f"""SELECT file_a AS _source_file, 'feed_a' AS _source_system,
 '2001-08-10 06:00:00' AS _ingested_at, {big('count(*)')} AS lines FROM ta GROUP BY ALL"""),
    "A8_store_from_filename": q(f"""SELECT file_b AS file, {big('count(*)')} AS lines, 'Bluebird Coffee ' ||
 CASE nk WHEN 1 THEN 'Las_Vegas' WHEN 2 THEN 'Meijer_Midtown' ELSE 'Nation_' || nk END AS store FROM tb GROUP BY ALL"""),
    "A9_order_rows": q(f"""SELECT DISTINCT CAST(ok AS VARCHAR) AS order_id, CAST(ok % 1000 AS VARCHAR) AS order_number,
 TRUE AS is_closed, FALSE AS is_refund, FALSE AS is_voided, CAST(NULL AS DOUBLE) AS net_sales,
 CAST(NULL AS DOUBLE) AS gross_sales, {dbl('otot')} AS total, CAST(NULL AS DOUBLE) AS subtotal,
 {dbl('CAST(otot * 0.05 AS DECIMAL(18,2))')} AS tax, CAST(NULL AS VARCHAR) AS guest_count,
 CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS VARCHAR) AS opened_time,
 strftime(closed, '%Y-%m-%d %H:%M') AS closed_time, CAST(NULL AS VARCHAR) AS terminal_id,
 CAST(NULL AS VARCHAR) AS till_number, CAST(ok % 7 + 5000 AS VARCHAR) AS employee_id,
 substr(pri, 1, 1) AS destination_id, loc AS store_name, d AS business_date
 FROM lx WHERE feed = 'feed_c'"""),
    "A9_entry_rows": q(f"""SELECT CAST(ok AS VARCHAR) AS order_id, entry AS entry_id, CAST(pk AS VARCHAR) AS item_id,
 CAST(p_size + 640207700 AS VARCHAR) AS revenue_center_id, {dbl('net')} AS net_sales, {dbl('price')} AS gross_sales,
 {dbl('price')} AS display_price, void AS is_voided, FALSE AS is_deleted, loc AS store_name,
 d AS business_date FROM lx WHERE feed = 'feed_c'"""),
    "A10_entries_to_bronze": q(f"""SELECT loc AS location, d AS sale_date, emp AS employee_name,
 pk AS item_id, {dbl('price')} AS price, {dbl('tax')} AS taxes, {dbl('net')} AS net_sales, {dbl('price')} AS total_sales,
 rc AS revenue_center, dest AS destination, void AS voided, modi AS is_modifier, oid AS order_id, entry AS entry_id FROM rc"""),
    "A11_replace_slice": q(f"""SELECT trim(loc) AS store, d AS sale_date, {big('count(*)')} AS lines,
 {dbl('sum(CASE WHEN year(d) = 2000 THEN net + 1 ELSE net END)')} AS net_sales FROM rc GROUP BY ALL"""),
    "A12_replace_entries": q(f"""SELECT trim(loc) AS store, d AS sale_date, {big('count(*)')} AS lines,
 {dbl('sum(net)')} AS net_sales, {big('count(*) FILTER (void)')} AS voided FROM (
 SELECT *, count(*) FILTER (NOT void) OVER (PARTITION BY loc, d) AS good FROM rc)
 WHERE NOT (void AND year(d) = 1999 AND good > 0) GROUP BY ALL"""),
    "A13_new_files": q("""SELECT DISTINCT 'feed_a' AS source_name, file_a AS filename FROM ta WHERE file_a NOT IN (
 SELECT filename FROM mf WHERE loaded_at < TIMESTAMP '2000-01-01')"""),
    "A14_reload_range": q(f"""SELECT d AS sale_date, CAST(CASE WHEN d >= DATE '2000-05-01'
 AND d < DATE '2000-09-01' THEN 2 ELSE 1 END AS INTEGER) AS version, {VERSION} FROM ra
 WHERE strftime(d, '%Y-%m') <> '2000-07' GROUP BY ALL"""),
    "A15_reload_scope": q(f"""SELECT trim(loc) AS store, d AS sale_date,
 CAST(CASE WHEN loc LIKE '%NATION_5' AND d >= DATE '2000-05-01' AND d < DATE '2000-09-01' THEN 2 ELSE 1 END AS INTEGER)
 AS version, {big('count(*)')} AS lines, {dbl('sum(fp)')} AS net_sales FROM rb
 WHERE NOT (loc LIKE '%NATION_5' AND strftime(d, '%Y-%m') = '2000-07') GROUP BY ALL"""),
    "A16_full_refresh": q(f"""SELECT d AS sale_date, 2 AS version, {VERSION} FROM ra
 WHERE strftime(d, '%Y-%m-01') IN {RELOADED} GROUP BY ALL"""),
    "A18_load_seed": q("SELECT * FROM cs"),
    "A19_split_by_source": q(f"""SELECT {big('a + c')} AS total_rows, {big('a')} AS feed_a_rows, {big('c')} AS feed_c_rows,
 CAST(0 AS BIGINT) AS unassigned_rows, {big('a')} AS feed_a_written, {big('c')} AS feed_c_written
 FROM (SELECT (SELECT count(*) FROM ra) AS a, (SELECT count(*) FROM rc) AS c)"""),
    "A20_as_utc": "SELECT event_id, epoch_us(ts) AS utc_micros FROM events",
    "A21_read_many": q(f"""SELECT location, promo_code, {big('count(*)')} AS lines, {big('count(n)')} AS priced_lines FROM (
 SELECT trim(loc) AS location, CAST(NULL AS VARCHAR) AS promo_code, net AS n FROM ta
 UNION ALL SELECT trim(loc), dest, NULL FROM rc) GROUP BY ALL"""),
    "A22_since": q(f"SELECT d AS sale_date, {big('count(*)')} AS lines FROM ra WHERE d > DATE '2000-12-31' GROUP BY ALL"),
    "A23_publish": q(" UNION ALL ".join([
        size("dim_date", "dd"), size("dim_destination", "dx"), size("dim_employee", "de"),
        size("dim_product", "dp"), size("dim_store", "ds"), size("fact_order", "fo"),
        size("fact_order_detail", "fo"), size("fact_sale_item", "fi"), size("fact_by_employee", "fe")])),
    "A24_bronze_b": q(f"""SELECT ident AS identifier, d AS sale_date, account, staff, ref AS reference, typ AS type,
 {dbl('qty')} AS qty, {dbl('fp')} AS final_price, {dbl('disc')} AS discount, item, grp AS item_group,
 {dbl('tax')} AS tax_amount, loc AS location, file_b AS _source_file, {ts('ing')} AS _ingested_at FROM rb"""),
    "A24_files_to_gold": q(f"""SELECT source_system, store_name, {big('count(DISTINCT ok)')} AS orders, {dbl('sum(n)')} AS net_sales,
 {dbl('sum(i)')} AS items_sold, {dbl('sum(n)')} AS item_net_sales FROM (
 SELECT 'feed_a' AS source_system, upper(store) AS store_name, ok, cur AS n, 1 AS i FROM ta
  WHERE NOT void AND NOT modi AND cur IS NOT NULL
 UNION ALL SELECT 'feed_b', upper(store), ok, fpx, qx FROM tb
  WHERE typ IN ('SALE', 'UPDATE') AND NOT modi
 UNION ALL SELECT 'feed_c', upper(store), ok, net, 1 FROM lx WHERE feed = 'feed_c' AND NOT void
  AND (loc, d) NOT IN (SELECT loc, d FROM ta)) GROUP BY ALL"""),
    "A24_incremental_to_gold": q(f"""SELECT source_system, sale_month, orders, net_sales, items_sold,
 {dbl('sum(exact) OVER (PARTITION BY sale_month)')} AS staff_net_sales FROM (
 SELECT source_system, CAST(date_trunc('month', d) AS DATE) AS sale_month,
 {big('count(DISTINCT ok)')} AS orders, {dbl('sum(n)')} AS net_sales, {dbl('sum(i)')} AS items_sold, sum(n) AS exact FROM (
 SELECT 'feed_a' AS source_system, d, ok, CASE WHEN strftime(d, '%Y-%m') = '2000-05' THEN 7 ELSE cur END AS n, 1 AS i FROM ta
  WHERE NOT void AND NOT modi AND (cur IS NOT NULL OR strftime(d, '%Y-%m') = '2000-05')
 UNION ALL SELECT 'feed_b', d, ok, fpx, qx FROM tb WHERE typ IN ('SALE', 'UPDATE') AND NOT modi
 UNION ALL SELECT 'feed_c', d, ok, CASE WHEN strftime(d, '%Y-%m') = '2000-04' THEN 5 ELSE net END, 1 FROM lx
  WHERE feed = 'feed_c' AND NOT void AND (loc, d) NOT IN (SELECT loc, d FROM ta)) GROUP BY ALL)"""),
    "B1_source_precedence": q(f"""SELECT loc AS location, d AS sale_date, src AS _source_system, {VERSION}
 FROM bac GROUP BY ALL"""),
    "B2_item_catalog": q("SELECT * FROM cat"),
    "B3_enrich": q(f"""SELECT oid AS order_id, pk AS item_id, {dbl('net')} AS net_sales, src AS _source_system,
 erc AS eff_revenue_center, ename AS eff_item_name FROM en"""),
    "B4_store_name": q(f"SELECT loc AS raw, upper(trim(store)) AS clean, {big('count(*)')} AS lines FROM lx WHERE feed = 'feed_a' GROUP BY ALL"),
    "B5_category_a": q(f"SELECT rc AS raw, {CAT_A.format('rc')} AS clean, {big('count(*)')} AS lines FROM bac GROUP BY ALL"),
    "B6_category_b": q(f"SELECT grp AS raw, {CAT_B.format('grp')} AS clean, {big('count(*)')} AS lines FROM rb GROUP BY ALL"),
    "B7_canonical_a": q(f"SELECT name_a AS raw, upper(p_name) AS clean, {big('count(*)')} AS lines FROM lx WHERE feed = 'feed_a' GROUP BY ALL"),
    "B8_canonical_b": q(f"""SELECT ' ' || p_name || ' (' || p_size || ' oz) m' AS raw, upper(p_name) AS clean,
 {big('count(*)')} AS lines FROM lx WHERE feed = 'feed_b' AND NOT void GROUP BY ALL"""),
    "B9_filter_a": q(f"""SELECT src AS _source_system, {big('count(*)')} AS lines,
 {big('count(*) FILTER (NOT void AND NOT modi)')} AS kept FROM bac GROUP BY ALL"""),
    "B10_filter_b": q(f"""SELECT 'feed_b' AS _source_system, {big('count(*)')} AS lines,
 {big("count(*) FILTER (grp NOT LIKE 'Modifier%')")} AS kept FROM rb"""),
    "B11_stg_a": q(f"SELECT {STG} FROM sa"),
    "B12_stg_b": q(f"SELECT {STG} FROM sb"),
    "B13_stg_orders": q(f"SELECT {STG} FROM st"),
    "C1_dim_date": q("SELECT * FROM dd"),
    "C2_dim_store": q(f"SELECT store_key, store_name, {dbl('royalty_rate')} AS royalty_rate, is_active FROM ds"),
    "C3_dim_product": q("SELECT * FROM dp"),
    "C4_dim_destination": q("SELECT * FROM dx"),
    "C5_dim_employee": q("SELECT * FROM de"),
    "C6_dim_campaign": q("SELECT * FROM dc"),
    "C7_surrogate_key": q("SELECT product_name, product_key FROM dp"),
    "C8_unknown_member": q(f"""SELECT source_system, {big('count(*) FILTER (product_key = 0)')} AS unknown_product,
 {big('count(*) FILTER (destination_key = 0)')} AS unknown_destination, {big('count(*)')} AS row_count FROM fi GROUP BY ALL"""),
    "J1_inner_dim": q(f"""SELECT store_name, {dbl('royalty_rate')} AS royalty_rate, {dbl(ORD)} AS net_sales,
 {big(CNT)} AS orders FROM fo GROUP BY ALL"""),
    "J2_left_default_key": q(f"""SELECT destination_key, channel, {big('count(*)')} AS lines FROM st JOIN dx
 ON destination_name = coalesce(destination, 'UNKNOWN') GROUP BY ALL"""),
    "J3_left_expression": q(f"""SELECT revenue_center_name, {big('count(*)')} AS lines, {dbl('sum(net_sales)')} AS net_sales
 FROM (SELECT st.net_sales, dp.revenue_center_name FROM st LEFT JOIN dp ON dp.product_name = upper(trim(st.product_name))) GROUP BY ALL"""),
    "J4_anti_two_keys": q(f"""SELECT loc AS location, d AS day, {big('count(*)')} AS lines FROM rc
 WHERE NOT EXISTS (SELECT 1 FROM ra WHERE ra.loc = rc.loc AND ra.d = rc.d) GROUP BY ALL"""),
    "J5_fact_to_fact": q(f"""SELECT source_system, store_key, {dbl(ORD)} AS net_sales, {dbl('sum(discount_total)')} AS discount_total,
 {dbl('sum(tax_amount)')} AS tax_amount, {big(CNT)} AS orders FROM fo GROUP BY ALL"""),
    "J6_full_outer": q(f"""SELECT date_key, {dbl('a')} AS order_net, {dbl('b')} AS employee_net,
 {dbl('coalesce(a, 0) - coalesce(b, 0)')} AS gap FROM (SELECT date_key, {ORD} AS a FROM fo GROUP BY ALL)
 FULL JOIN (SELECT date_key, sum(net_sales) AS b FROM fe GROUP BY ALL) USING (date_key)"""),
    "J7_one_row_total": q(f"""SELECT store_name, {dbl('n')} AS net_sales, {rdiv('n', '(SELECT sum(order_net_sales) FROM fo)', 4)} AS share
 FROM (SELECT store_name, {ORD} AS n FROM fo GROUP BY ALL)"""),
    "J8_campaign_interval": q(f"""SELECT coalesce(campaign_key, 0) AS campaign_key, coalesce(campaign_name, 'NO CAMPAIGN') AS campaign_name,
 {dbl('sum(net_sales)')} AS net_sales, {dbl('sum(qty)')} AS items_sold FROM st LEFT JOIN dc
 ON dc.product_canonical_name = st.product_canonical_name AND sale_date >= coalesce(campaign_start_date, DATE '1900-01-01')
 AND sale_date <= coalesce(campaign_end_date, DATE '2999-01-01') GROUP BY 1, 2"""),
    "J9_scalar_subquery": q(f"""SELECT 'order' AS fact, mon AS latest_month, {dbl(ORD)} AS net_sales FROM fo
 WHERE mon = (SELECT m FROM lmo) GROUP BY mon UNION ALL SELECT 'item', mon, {dbl('sum(item_net_sales)')} FROM fi
 WHERE mon = (SELECT m FROM lmi) GROUP BY mon UNION ALL SELECT 'employee', mon, {dbl('sum(net_sales)')} FROM fe
 WHERE mon = (SELECT m FROM lme) GROUP BY mon"""),
    "D1_fact_order": q(f"""SELECT date_key, store_key, destination_key, source_system, order_id,
 {dbl('order_net_sales')} AS order_net_sales, 1 AS order_count, {ts('ing')} AS _ingested_at, mon AS sale_month FROM fo"""),
    "D2_fact_order_detail": q(f"""SELECT date_key, store_key, destination_key, source_system, order_id,
 {dbl('discount_total')} AS discount_total, {dbl('tax_amount')} AS tax_amount, {dbl('tip_amount')} AS tip_amount,
 {ts('ing')} AS _ingested_at, mon AS sale_month FROM fo"""),
    "D3_fact_sale_item": q(f"""SELECT date_key, store_key, product_key, destination_key, source_system, order_id,
 mon AS sale_month, {dbl('qty')} AS qty, {dbl('item_net_sales')} AS item_net_sales, {ts('ing')} AS _ingested_at FROM fi"""),
    "D4_fact_by_employee": q(f"""SELECT date_key, store_key, employee_key, mon AS sale_month, {dbl('net_sales')} AS net_sales,
 {big('order_count')} AS order_count, {dbl('tip_amount')} AS tip_amount, {dbl('tax_amount')} AS tax_amount,
 {dbl('discount_total')} AS discount_total, {ts('ing')} AS _ingested_at, {rdiv('net_sales', 'order_count', 2)} AS avg_ticket FROM fe"""),
    "D4_distinct_day_cells": q(f"SELECT date_key, store_key, employee_key, {big('order_count')} AS order_count FROM fe"),
    "D4_distinct_roll_ups": q(" UNION ALL ".join(
        f"SELECT '{level}' AS level, mon AS sale_month, {member} AS member_key, {big('count(DISTINCT order_ref)')} AS order_count FROM il GROUP BY ALL"
        for level, member in (("store", "store_key"), ("employee", "employee_key"), ("month", "CAST(NULL AS BIGINT)")))),
    "D5_legacy_cells": q(f"""SELECT date_key, store_key, product_key, destination_key, {dbl('sum(net_sales)')} AS net_sales,
 {big('count(DISTINCT order_id)')} AS order_count, {dbl('sum(tip_amount)')} AS tip_amount,
 {dbl('sum(tax_amount)')} AS tax_amount, {dbl('sum(discount_total)')} AS discount_total,
 {rdiv('sum(net_sales)', 'count(DISTINCT order_id)', 2)} AS avg_ticket FROM il GROUP BY 1, 2, 3, 4"""),
    "D6_filtered_aggregate": q(f"""SELECT store_name, {dbl('sum(net_sales) FILTER (employee_key = 0)')} AS unknown_net,
 {dbl('sum(net_sales) FILTER (employee_key <> 0)')} AS named_net,
 {big('count(DISTINCT employee_key) FILTER (employee_key <> 0)')} AS named_employees FROM fe GROUP BY ALL"""),
    "D7_conditional_sum": q("SELECT ym AS year_month, " + ", ".join(
        f"{big(f'''count(*) FILTER (source_system = '{t}')''')} AS {t}_orders" for t in ("feed_a", "feed_b", "feed_c"))
        + " FROM fo GROUP BY ym"),
    "D8_flag_rollup": q("SELECT source_system, order_id, " + ", ".join(
        f"max(CAST(rcat = '{c}' AS INTEGER)) AS has_{c.lower()}" for c in ("Beverage", "Food", "Retail"))
        + " FROM fp GROUP BY ALL"),
    "D9_null_count": q("SELECT _source_system AS source, " + ", ".join(
        f"{big(f'count(*) - count({c})')} AS null_{c}" for c in
        ("destination", "employee_name", "discount_total", "product_name")) + " FROM st GROUP BY 1"),
    "D10_having": q(f"""SELECT date_key, store_name, {big(CNT)} AS orders, {dbl(ORD)} AS net_sales FROM fo
 GROUP BY 1, 2 HAVING count(*) >= 2"""),
    "D11_two_level": q(f"""SELECT store_name, {rdiv('sum(n)', 'count(*)', 2)} AS avg_day, {rdiv('sum(c)', 'count(*)', 2)} AS avg_orders
 FROM (SELECT store_name, date_key, {ORD} AS n, count(*) AS c FROM fo GROUP BY ALL) GROUP BY store_name"""),
    "D12_pivot": q("SELECT mon AS sale_month, store_name, " + ", ".join(
        f"{dbl(f'''sum(order_net_sales) FILTER (source_system = '{t}')''')} AS {t}" for t in ("feed_a", "feed_b", "feed_c"))
        + " FROM fo GROUP BY ALL"),
    "D12_pivot_filled": q("SELECT mon AS sale_month, store_name, " + ", ".join(
        f"{dbl(f'''coalesce(sum(order_net_sales) FILTER (source_system = '{t}'), 0)''')} AS {t}"
        for t in ("feed_a", "feed_b", "feed_c")) + " FROM fo GROUP BY mon, store_name"),
    "D13_global": q(f"""SELECT {big('count(*)')} AS lines, {big('count(DISTINCT order_ref)')} AS order_refs,
 {dbl('sum(net_sales)')} AS net_sales, min(sale_date) AS first_day, max(sale_date) AS last_day FROM st"""),
    "W1_row_number": q(f"""SELECT store_name, date_key, order_id, {dbl('order_net_sales')} AS order_net_sales FROM fo
 QUALIFY row_number() OVER (PARTITION BY store_key ORDER BY date_key DESC, order_id DESC, source_system) = 1"""),
    "W2_distinct_on": q("""SELECT DISTINCT ON (product_canonical_name) product_canonical_name, revenue_center_name, priority
 FROM (SELECT *, CAST(list_position(['Beverage', 'Food', 'Retail', 'Other'], revenue_center_name) AS INTEGER) AS priority FROM dp)
 ORDER BY product_canonical_name, priority"""),
    "W3_lag": q(f"""SELECT store_name, ym AS year_month, {dbl('n')} AS net_sales,
 {dbl('lag(n) OVER (PARTITION BY store_name ORDER BY ym)')} AS prev_net_sales
 FROM (SELECT store_name, ym, {ORD} AS n FROM fo GROUP BY ALL)"""),
    "W4_running_sum": q(f"""SELECT date_key, {dbl('n')} AS net_sales, {dbl('sum(n) OVER (ORDER BY date_key)')} AS running_net_sales
 FROM (SELECT date_key, {ORD} AS n FROM fo GROUP BY ALL)"""),
    "W5_share_of_total": q(f"""SELECT source_system, {dbl('n')} AS net_sales, {big('c')} AS orders,
 {rdiv('n', 't', 4)} AS share FROM (SELECT source_system, {ORD} AS n, count(*) AS c, sum(sum(order_net_sales)) OVER () AS t FROM fo GROUP BY 1)"""),
    "S1_nulls_last": q(f"SELECT source_system, {dbl('sum(discount_total)')} AS discount_total FROM fo GROUP BY ALL ORDER BY 2 DESC NULLS LAST"),
    "S2_top_k": q(f"""SELECT source_system, order_id, {dbl('order_net_sales')} AS order_net_sales FROM fo
 ORDER BY fo.order_net_sales DESC, source_system, order_id LIMIT 20"""),
    "S3_custom_order": q(f"""SELECT day_name, {big(CNT)} AS orders, CAST(CASE day_name WHEN 'Saturday' THEN 1 WHEN 'Sunday' THEN 2
 ELSE 3 END AS INTEGER) AS place FROM fo GROUP BY ALL ORDER BY place, day_name"""),
    "S4_union_all": q(f"SELECT _source_system, {big('count(*)')} AS lines FROM st GROUP BY ALL"),
    "S5_union_distinct": q("SELECT upper(trim(emp)) AS employee_name FROM ra UNION SELECT upper(trim(staff)) FROM rb"),
    "M1_attachment_rate_monthly": q(f"SELECT ym AS year_month, mon AS month_date, {ATT_COLS} FROM att", ATT),
    "M2_source_by_month": q(f"""SELECT _source_system AS source, strftime(sale_date, '%Y-%m') AS year_month,
 {dbl('sum(net_sales)')} AS net_sales, {big('count(DISTINCT order_id)')} AS order_count FROM st WHERE net_sales > 0 GROUP BY 1, 2"""),
    "M3_source_summary": q(SUMMARY.format("_source_system", "")),
    "M4_freshness_data": q(f"SELECT source_name, filename, row_count, {ts('loaded_at')} AS loaded_at FROM mf"),
    "Q1_kpi_current_month": q(f"SELECT {SALES}, {TICKET} AS avg_ticket FROM fo WHERE mon = (SELECT m FROM lmo)"),
    "Q2_kpi_ytd": q(f"""SELECT {dbl(ORD)} AS net_sales_ytd, {big(CNT)} AS order_count_ytd, {TICKET} AS avg_ticket_ytd
 FROM fo WHERE year = (SELECT max(year) FROM fo)"""),
    "Q3_kpi_items_current_month": q(f"SELECT {dbl('sum(qty)')} AS items_sold FROM fi WHERE mon = (SELECT m FROM lmi)"),
    "Q4_kpi_items_ytd": q(f"SELECT {dbl('sum(qty)')} AS items_sold_ytd FROM fi WHERE sale_date >= (SELECT date_trunc('year', max(sale_date)) FROM st)"),
    "Q5_daily_last_90": q(f"""SELECT sale_date AS date, {dbl(ORD)} AS net_sales FROM fo
 WHERE sale_date > (SELECT max(sale_date) - 90 FROM fo) GROUP BY 1"""),
    "Q6_net_sales_ytd_daily": q(f"""SELECT sale_date AS date, {dbl('n')} AS net_sales,
 {dbl('sum(n) OVER (ORDER BY sale_date)')} AS cumulative_net_sales FROM (SELECT sale_date, {ORD} AS n FROM fo
 WHERE year = (SELECT max(year) FROM fo) GROUP BY 1)"""),
    "Q7_store_leaderboard_mom": q(f"""SELECT store_name, '/stores/' || store_name AS store_url, {dbl('c')} AS current_month_sales,
 {dbl('p')} AS prev_month_sales, {rdiv('c - p', 'p', 4)} AS mom_growth_pct FROM (
 SELECT store_name, sum(order_net_sales) FILTER (mon = m) AS c, sum(order_net_sales) FILTER (mon <> m) AS p
 FROM fo, lmo WHERE mon >= m - INTERVAL 1 MONTH GROUP BY 1)"""),
    "Q8_store_month_matrix": q(f"""SELECT s.store_name, m.ym AS year_month, {dbl('sum(order_net_sales)')} AS net_sales
 FROM (SELECT DISTINCT store_name FROM fo) AS s CROSS JOIN (SELECT DISTINCT ym FROM fo) AS m
 LEFT JOIN fo ON fo.store_name = s.store_name AND fo.ym = m.ym GROUP BY 1, 2"""),
    "Q9_store_month_options": q("SELECT store_name FROM ds ORDER BY 1"),
    "Q10_store_monthly_sales": q(f"""SELECT store_name, mon AS month, ym AS year_month, {dbl(ORD)} AS net_sales FROM fo
 WHERE store_name = 'LAS VEGAS' GROUP BY 1, 2, 3"""),
    "Q11_labor_efficiency": q(f"""SELECT store_name, {dbl('n')} AS net_sales, {big('e')} AS active_employees,
 {rdiv('n', 'e', 2)} AS sales_per_employee FROM (SELECT store_name, sum(net_sales) FILTER (employee_key <> 0) AS n,
 count(DISTINCT employee_key) FILTER (employee_key <> 0) AS e FROM fe WHERE mon = (SELECT m FROM lme) GROUP BY 1)"""),
    "Q12_royalties_current_month": q(f"""SELECT store_name, {dbl('royalty_rate')} AS royalty_rate, {dbl(ORD)} AS net_sales,
 {dbl('round(sum(order_net_sales * royalty_rate), 2)')} AS royalty_due FROM fo WHERE mon = (SELECT m FROM lmo)
 GROUP BY store_name, fo.royalty_rate"""),
    "Q13_channel_comparison": q(f"""SELECT channel, {dbl('n')} AS net_sales, {big('c')} AS order_count, {rdiv('n', 'c', 2)} AS avg_ticket,
 {rdiv('n', 't', 4)} AS pct_of_total FROM (SELECT channel, {ORD} AS n, count(*) AS c, sum(sum(order_net_sales)) OVER () AS t
 FROM fo WHERE mon = (SELECT m FROM lmo) AND channel <> 'Unknown' GROUP BY 1)"""),
    "Q14_delivery_leakage": q(f"""SELECT dname AS destination_name, {dbl(ORD)} AS net_sales, {dbl('sum(discount_total)')} AS discount_total,
 {rdiv('sum(discount_total)', 'sum(order_net_sales + discount_total)', 4)} AS discount_leakage_pct FROM fo
 WHERE channel = 'Delivery' AND mon = (SELECT m FROM lmo) GROUP BY 1"""),
    "Q15_drivethu_monthly": q(f"""SELECT ym AS year_month, {SALES}, {TICKET} AS avg_ticket FROM fo
 WHERE channel = 'Drive-Thru' GROUP BY ym"""),
    "Q16_unknown_destination_trend": q(f"""SELECT ym AS year_month, {big('count(*) FILTER (destination_key = 0)')} AS unknown_orders,
 {big(CNT)} AS total_orders, {rdiv('count(*) FILTER (destination_key = 0)', CNT, 4)} AS unknown_pct FROM fo GROUP BY ym"""),
    "Q17_store_list": q("SELECT 'All Stores' AS store_name, 0 AS sort_order UNION ALL SELECT store_name, 1 FROM ds"),
    "Q18_size_options": q("SELECT 'All' AS size_name, 0 AS sort_order, count(*) AS products FROM dp " + " ".join(
        f"UNION ALL SELECT '{s}oz', {i}, count(*) FILTER ({SIZED.format(s)}) FROM dp" for i, s in enumerate((12, 16, 20, 24, 32), 1))
        + " UNION ALL SELECT 'Food', 6, count(*) FILTER (revenue_center_name = 'Food') FROM dp"),
    "Q19_overall_performance": q(f"""SELECT store_name, {dbl('sum(item_net_sales)')} AS net_sales, {dbl('sum(qty)')} AS items_sold
 FROM fi GROUP BY 1"""),
    "Q19_overall_performance_store": q(f"""SELECT store_name, {dbl('sum(item_net_sales)')} AS net_sales, {dbl('sum(qty)')} AS items_sold
 FROM fi WHERE store_name = 'LAS VEGAS' GROUP BY 1"""),
    **{
        name: q(f"""SELECT canon AS product_canonical_name, rcat AS revenue_center_name, {dbl('n')} AS net_sales,
 {dbl('i')} AS items_sold, {rdiv('n', 't', 4)} AS pct_of_sales FROM (SELECT canon, rcat, product_name, sum(item_net_sales) AS n,
 sum(qty) AS i, sum(sum(item_net_sales)) OVER () AS t FROM fp WHERE product_key <> 0 AND {cond} GROUP BY 1, 2, 3)
 WHERE n > 0 ORDER BY n DESC, product_name LIMIT 200""")
        for name, cond in {
            "Q20_size_breakdown": "TRUE",
            "Q20_size_breakdown_16oz": f"store_name = 'LAS VEGAS' AND {SIZED.format(16)}",
            "Q20_size_breakdown_food": "rcat = 'Food'",
        }.items()
    },
    "Q21_attachment_rate_kpi": q(f"""SELECT {big('sum(b)')} AS beverage_orders, {big('sum(p)')} AS paired_orders,
 {rdiv('sum(p)', 'sum(b)', 4)} AS attachment_rate_pct FROM att""", ATT),
    "Q22_attachment_rate_trend": q(f"SELECT ym AS year_month, {ATT_COLS} FROM att", ATT),
    "Q23_retail_evolution": q(f"""SELECT ym AS year_month, {dbl('sum(item_net_sales)')} AS net_sales, {dbl('sum(qty)')} AS items_sold
 FROM fp WHERE rcat = 'Retail' AND sale_date >= DATE '1999-01-01' GROUP BY 1"""),
    "Q24_product_mix_by_category": q(f"""SELECT ym AS year_month, rcat AS revenue_center_name, {dbl('sum(item_net_sales)')} AS net_sales
 FROM fp WHERE sale_date >= DATE '1999-01-01' GROUP BY 1, 2"""),
    "Q25_top_products_by_revenue": q(f"""SELECT canon AS product_canonical_name, rcat AS revenue_center_name, {dbl('n')} AS net_sales,
 {dbl('i')} AS items_sold, {rdiv('n', 'i', 2)} AS avg_unit_price FROM (SELECT canon, rcat, sum(item_net_sales) AS n, sum(qty) AS i
 FROM fp WHERE mon = (SELECT m FROM lmi) AND product_key <> 0 GROUP BY 1, 2) ORDER BY n DESC, canon, rcat LIMIT 30"""),
    "Q26_category_volume": q(f"""SELECT rcat AS revenue_center, {dbl('i')} AS total_qty, {dbl('n')} AS net_sales,
 {rdiv('n', 't', 4)} AS pct_of_total FROM (SELECT rcat, sum(item_net_sales) AS n, sum(qty) AS i,
 sum(sum(item_net_sales)) OVER () AS t FROM fp WHERE mon = (SELECT m FROM lmi) GROUP BY 1)"""),
    "Q27_recent_month": q("SELECT m AS month_start FROM lme"),
    "Q28_upselling_leaderboard": q(f"""SELECT employee_name, store_name, {dbl('n')} AS net_sales, {big('o')} AS orders, avg_ticket FROM (
 SELECT ename AS employee_name, store_name, sum(net_sales) AS n, sum(order_count) AS o, {rdiv('sum(net_sales)', 'sum(order_count)', 2)}
 AS avg_ticket FROM fe WHERE {FE_NAMED} GROUP BY 1, 2 HAVING sum(order_count) >= 2)
 ORDER BY avg_ticket DESC, employee_name, store_name LIMIT 20"""),
    "Q29_discount_audit": q(f"""SELECT employee_name, store_name, {dbl('x')} AS discount_total, {dbl('n')} AS net_sales,
 {rdiv('x', 'g', 4)} AS discount_pct FROM (SELECT ename AS employee_name, store_name, sum(discount_total) AS x, sum(net_sales) AS n,
 sum(net_sales + discount_total) AS g FROM fe WHERE {FE_NAMED} GROUP BY 1, 2)
 ORDER BY x DESC NULLS LAST, employee_name, store_name LIMIT 20"""),
    "Q30_shift_productivity": q(f"""SELECT store_name, {big('sum(order_count)')} AS total_orders, {big('count(*)')} AS employee_days,
 {rdiv('sum(order_count)', 'count(*)', 1)} AS orders_per_employee_day FROM fe WHERE {FE_NAMED} GROUP BY 1"""),
    "Q31_store_kpis": q(f"""SELECT {dbl(ORD)} AS net_sales_cm, {TICKET} AS avg_ticket_cm FROM fo
 WHERE mon = (SELECT m FROM lmo) AND store_name = 'LAS VEGAS'"""),
    "Q32_store_kpi_ytd": q(f"SELECT {dbl(ORD)} AS net_sales_ytd FROM fo WHERE year = (SELECT max(year) FROM fo) AND store_name = 'LAS VEGAS'"),
    "Q33_store_net_sales_history": q(f"SELECT mon AS month, {SALES} FROM fo WHERE store_name = 'LAS VEGAS' GROUP BY 1"),
    "Q34_dow_heatmap": q(f"""SELECT day_name AS day_of_week, dow AS dow_num, month_name, month AS month_num, year,
 year || ' ' || month_name AS period, {rdiv('sum(n)', 'count(*)', 2)} AS avg_daily_sales, {rdiv('sum(c)', 'count(*)', 1)} AS avg_orders
 FROM (SELECT sale_date, day_name, day_of_week AS dow, month_name, month, year, {ORD} AS n, count(*) AS c FROM fo
 WHERE store_name = 'LAS VEGAS' AND sale_date >= (SELECT max(sale_date) - INTERVAL 1 YEAR FROM st) GROUP BY ALL) GROUP BY 1, 2, 3, 4, 5"""),
    "Q35_category_mix": q(f"""SELECT rcat AS revenue_center_name, {dbl('n')} AS net_sales, {rdiv('n', 't', 4)} AS pct_of_total FROM (
 SELECT rcat, sum(item_net_sales) AS n, sum(sum(item_net_sales)) OVER () AS t FROM fp WHERE mon = (SELECT m FROM lmi)
 AND store_name = 'LAS VEGAS' AND rcat <> 'Other' GROUP BY 1)"""),
    "Q36_channels_this_store": q(f"""SELECT channel, {SALES}, {TICKET} AS avg_ticket FROM fo WHERE mon = (SELECT m FROM lmo)
 AND store_name = 'LAS VEGAS' AND channel <> 'Unknown' GROUP BY 1"""),
    "Q37_top_employees": q(f"""SELECT employee_name, {dbl('n')} AS net_sales, {big('o')} AS orders, {rdiv('n', 'o', 2)} AS avg_ticket FROM (
 SELECT ename AS employee_name, sum(net_sales) AS n, sum(order_count) AS o FROM fe WHERE {FE_NAMED} AND store_name = 'LAS VEGAS' GROUP BY 1)
 ORDER BY n DESC, employee_name LIMIT 10"""),
    "Q38_monthly_sales": q(f"SELECT year, month, month_name, ym AS year_month, {SALES} FROM fo GROUP BY 1, 2, 3, 4"),
    "Q39_mom_growth": q(f"""SELECT ym AS year_month, month_name, year, {dbl('n')} AS net_sales, {big('c')} AS order_count,
 {dbl('pn')} AS prev_net_sales, {rdiv('n - pn', 'pn', 4)} AS mom_sales_pct, {rdiv('c - pc', 'pc', 4)} AS mom_orders_pct
 FROM (SELECT *, lag(n) OVER (ORDER BY ym) AS pn, lag(c) OVER (ORDER BY ym) AS pc FROM (
 SELECT ym, month_name, year, {ORD} AS n, count(*) AS c FROM fo GROUP BY 1, 2, 3))"""),
    "Q40_yoy_comparison": q(f"""SELECT month, month_name, CAST(year AS VARCHAR) AS year, {SALES} FROM fo WHERE fo.year >= 1999
 GROUP BY fo.month, fo.month_name, fo.year"""),
    "Q41_day_of_week": q(f"""SELECT day_of_week, day_name, {rdiv('sum(n)', 'count(*)', 2)} AS avg_net_sales,
 {rdiv('sum(c)', 'count(*)', 1)} AS avg_orders, {rdiv('sum(n)', 'sum(c)', 2)} AS avg_ticket FROM (
 SELECT sale_date, day_of_week, day_name, {ORD} AS n, count(*) AS c FROM fo GROUP BY ALL) GROUP BY 1, 2"""),
    "Q42_weekend_vs_weekday": q(f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
 {rdiv('sum(n)', 'count(*)', 2)} AS avg_daily_sales, {rdiv('sum(c)', 'count(*)', 1)} AS avg_daily_orders,
 {rdiv('sum(n)', 'sum(c)', 2)} AS avg_ticket FROM (SELECT sale_date, is_weekend, {ORD} AS n, count(*) AS c FROM fo GROUP BY ALL) GROUP BY 1"""),
    "Q43_quarterly_sales": q(f"""SELECT year, quarter, year || ' Q' || quarter AS period, {SALES}, {TICKET} AS avg_ticket
 FROM fo GROUP BY fo.year, fo.quarter"""),
    "Q44_source_reconciliation": q(SUMMARY.format("source", f", {rdiv('sum(net_sales)', 'count(*)', 2)} AS avg_net_sales_per_row")),
    "Q46_unknown_employee_by_month": q(f"""SELECT ym AS year_month, {dbl('u')} AS unknown_net_sales, {dbl('n')} AS total_net_sales,
 {rdiv('u', 'n', 4)} AS unknown_pct FROM (SELECT ym, sum(net_sales) FILTER (employee_key = 0) AS u, sum(net_sales) AS n FROM fe GROUP BY 1)"""),
    "Q47_unknown_employee_by_store": q(f"""SELECT store_name, {dbl('u')} AS unknown_net_sales, {dbl('n')} AS total_net_sales,
 {rdiv('u', 'n', 4)} AS unknown_pct FROM (SELECT store_name, sum(net_sales) FILTER (employee_key = 0) AS u, sum(net_sales) AS n
 FROM fe WHERE mon = (SELECT m FROM lme) GROUP BY 1)"""),
    "Q48_unknown_destination": q(f"""SELECT ym AS year_month, {big('count(*) FILTER (destination_key = 0)')} AS unknown_dest_orders,
 {big(CNT)} AS total_orders, {rdiv('count(*) FILTER (destination_key = 0)', CNT, 4)} AS unknown_pct FROM fo GROUP BY ym"""),
    "Q49_unknown_totals": q(f"""SELECT {big("(SELECT count(*) FROM de WHERE employee_name = 'UNKNOWN')")} AS unknown_employee_rows,
 {big('(SELECT count(*) FROM fo WHERE destination_key = 0)')} AS unknown_dest_orders"""),
    "Q50_freshness_monitor": q(f"""SELECT source_name, filename, row_count, {ts('mf.loaded_at')} AS loaded_at FROM mf
 ORDER BY mf.loaded_at DESC, source_name, filename LIMIT 20"""),
    "Q51_freshness_summary": q(f"""SELECT source_name, {ts('max(loaded_at)')} AS last_loaded_at,
 {big('sum(row_count)')} AS total_rows_ingested, {big('count(*)')} AS files_processed FROM mf GROUP BY 1"""),
    "Q52_data_watermark": q("""SELECT max(sale_date) AS latest_sale_date, min(sale_date) AS earliest_sale_date,
 CAST(date_diff('day', max(sale_date), (SELECT max(sale_date) FROM st)) AS INTEGER) AS days_since_last_data FROM fo"""),
    "P1_classify_keyword": q(f"""SELECT dessert AS item_name, {big('count(*)')} AS lines, {classified('dessert')} AS product
 FROM ta GROUP BY dessert"""),
    "P2_classify_exact": q(f"""SELECT item AS item_name, {big('count(*)')} AS lines, {named('item')} AS product FROM tb GROUP BY item"""),
    "P3_food_fact": q(f"SELECT sale_date, location, product, {dbl('net_sales')} AS net_sales, item_name, source FROM food", FOOD),
    "P4_food_pivot_sales": q("SELECT strftime(sale_date, '%Y-%m') AS month, " + ", ".join(
        f"""{dbl(f"coalesce(sum(net_sales) FILTER (product = '{p}'), 0)")} AS "{p}\"""" for p in PRODUCTS) + " FROM food GROUP BY 1", FOOD),
    "P4_food_pivot_units": q("SELECT strftime(sale_date, '%Y-%m') AS month, " + ", ".join(
        f"""{big(f"count(*) FILTER (product = '{p}')")} AS "{p}\"""" for p in PRODUCTS) + " FROM food GROUP BY 1", FOOD),
    "P4_food_by_month_store": q(f"""SELECT strftime(sale_date, '%Y-%m') AS month, location, product, {FOOD_SUM},
 {rdiv('sum(food.net_sales)', 'count(*)', 2)} AS avg_ticket FROM food GROUP BY 1, 2, 3""", FOOD),
    "P4_food_by_store": q(f"SELECT location, product, {dbl('sum(net_sales)')} AS net_sales FROM food GROUP BY 1, 2", FOOD),
    "P4_food_totals": q("SELECT product, CAST(rank AS INTEGER) AS rank, net_sales, units, avg_ticket FROM (VALUES "
        + ", ".join(f"('{p}', {i})" for i, p in enumerate(PRODUCTS)) + f""") AS l(product, rank) LEFT JOIN (
 SELECT product, {FOOD_SUM}, {rdiv('sum(food.net_sales)', 'count(*)', 2)} AS avg_ticket FROM food GROUP BY 1) USING (product)""", FOOD),
    "P5_channel_daily": q(f"SELECT d AS day, {CHAN_SUM} FROM ch GROUP BY d", CHAN),
    "P6_channel_weekly": q(f"SELECT CAST(date_trunc('week', d) AS DATE) AS week_start, {CHAN_SUM} FROM ch GROUP BY 1", CHAN),
    "P6_channel_checks": q(" UNION ALL ".join(
        f"""SELECT '{n}' AS level, {dbl("coalesce(sum(acc) FILTER (lane), 0)")} AS drive_sales, {dbl('sum(acc)')} AS total_sales,
 {big('count(*) FILTER (item)')} AS total_items, TRUE AS agrees FROM ch""" for n in ("daily", "weekly", "raw")), CHAN),
    "P6_destination_breakdown": q(f"""SELECT dest AS destination, {dbl('sum(acc)')} AS net_sales FROM ch
 WHERE dest IS NOT NULL GROUP BY 1""", CHAN),
    "P7_hourly_summary": q(f"""SELECT h AS hour, lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label, {big('o')} AS orders,
 {dbl('n')} AS net_sales, {rdiv('n', 'o', 2)} AS avg_ticket, {rdiv('100 * n', 't', 2)} AS pct_of_sales FROM (
 SELECT h, count(DISTINCT ok) AS o, sum(acc) AS n, sum(sum(acc)) OVER () AS t FROM hr GROUP BY h)""", HRS),
    "P8_hourly_by_month": q(f"""SELECT monthname(d) AS month, CAST(month(d) AS INTEGER) AS month_no, h AS hour, {HRS_SUM},
 lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label FROM hr GROUP BY 1, 2, 3, h""", HRS),
    "P8_daily_summary": q(f"SELECT d AS sale_date, dayname(d) AS day_of_week, {HRS_SUM} FROM hr GROUP BY d", HRS),
    "P9_item_daily": q(f"SELECT d AS sale_date, {ITEM_SUM}, {ITEM_AVG} FROM it GROUP BY d", ITEM),
    "P9_item_weekly": q(f"SELECT CAST(date_trunc('week', d) AS DATE) AS week_start, {ITEM_SUM} FROM it GROUP BY 1", ITEM),
    "P9_item_monthly": q(f"SELECT strftime(d, '%Y-%m') AS year_month, monthname(d) AS month_name, {ITEM_SUM} FROM it GROUP BY 1, 2", ITEM),
    "P10_item_by_employee": q(f"""SELECT employee, {big('count(*)')} AS transactions, {dbl('sum(acc)')} AS net_sales, {ITEM_AVG}
 FROM it GROUP BY employee""", ITEM),
    "P10_item_by_destination": q(f"""SELECT destination, {big('count(*)')} AS transactions, {dbl('sum(acc)')} AS net_sales
 FROM it GROUP BY 1""", ITEM),
    "I1_load_watermark": q(f"""SELECT _source_system, sale_date, {big('count(*)')} AS lines, {dbl('sum(net_sales)')} AS net_sales
 FROM st WHERE _ingested_at >= TIMESTAMP '2001-01-01' GROUP BY 1, 2"""),
    "I2_partition_replace": q(f"""SELECT store_name, sale_date, {big('count(*)')} AS lines,
 {dbl('sum(net_sales)')} AS net_sales FROM st GROUP BY 1, 2"""),
    "I3_delete_insert": q(f"""SELECT source_system, order_id, date_key,
 {dbl("CASE WHEN sale_date >= DATE '2001-01-01' THEN 2 * fo.order_net_sales ELSE fo.order_net_sales END")} AS order_net_sales FROM fo"""),
    "I3_refresh_months": q(f"""SELECT mon AS sale_month, source_system, {big(CNT)} AS orders, {dbl(ORD)} AS net_sales
 FROM fo GROUP BY 1, 2"""),
    "I4_lookback": q(f"""SELECT sale_date, {big('count(*)')} AS lines FROM st WHERE sale_date >
 (SELECT max(sale_date) - 35 FROM st WHERE sale_date < DATE '2001-03-01') GROUP BY 1"""),
    "I5_file_stream": q(f"""SELECT store_name, _source_system, {big('count(*)')} AS lines, {dbl('sum(net_sales)')} AS net_sales
 FROM st GROUP BY 1, 2"""),
    "I5_feed_stream": q(f"""SELECT 'feed_a' AS feed, loc AS location, d AS sale_date, {big('count(*)')} AS lines, {dbl('sum(cur)')} AS amount
 FROM ta GROUP BY ALL UNION ALL SELECT 'feed_b', 'Bluebird Coffee ' || CASE nk WHEN 1 THEN 'Las_Vegas' WHEN 2 THEN 'Meijer_Midtown'
 ELSE 'Nation_' || nk END AS location, d, {big('count(*)')}, {dbl('sum(fpx)')} FROM tb WHERE typ IN ('SALE', 'UPDATE') GROUP BY ALL"""),
    "I6_late_arrivals": q(f"""SELECT _source_system AS source_system, {big('n')} AS row_count, {big('l')} AS late_rows,
 {rdiv('l', 'n', 4)} AS late_share FROM (SELECT _source_system, count(*) AS n,
 count(*) FILTER (CAST(_ingested_at AS DATE) - sale_date > 2) AS l FROM st GROUP BY 1)"""),
    "T1_not_null": q(" UNION ALL ".join([
        not_null_counts("(SELECT *, 1 AS order_count FROM fo)", "fact_order", ["date_key", "store_key", "order_id", "order_count"]),
        not_null_counts("fi", "fact_sale_item", ["date_key", "store_key", "order_id", "qty"]),
        not_null_counts("fo", "fact_order_detail", ["date_key", "store_key", "source_system", "order_id", "discount_total"]),
        not_null_counts("fe", "fact_by_employee", ["date_key", "store_key", "employee_key", "discount_total"]),
        not_null_counts("st", "stg_orders", ["sale_date", "store_name", "revenue_center", "net_sales", "order_id",
                                             "destination", "employee_name", "product_canonical_name"])])),
    "T2_not_null_where": q(f"""SELECT _source_system, store_name, {big('count(*)')} AS lines FROM sa
 WHERE employee_name IS NULL GROUP BY 1, 2"""),
    "T2_named_when_categorised": q(f"""SELECT 'stg_orders' AS table_name, 'not_null(product_canonical_name) where' AS check_name,
 {big("count(*) FILTER (revenue_center <> 'Other' AND product_canonical_name IS NULL)")} AS failures FROM st"""),
    "T3_unique": q(" UNION ALL ".join([
        repeated("dim_store", "ds", "store_key"), repeated("dim_date", "dd", "date_key"),
        repeated("dim_product", "dp", "product_key"), repeated("dim_destination", "dx", "destination_key"),
        repeated("dim_employee", "de", "employee_key"), repeated("dim_campaign", "dc", "campaign_key"),
        repeated("fact_order", "fo", "source_system, order_id"),
        repeated("fact_sale_item", "fi", "source_system, order_id, product_key"),
        repeated("fact_by_employee", "fe", "date_key, store_key, employee_key")])),
    "T4_accepted_values": q(f"""SELECT 'dim_product' AS table_name, 'accepted_values(revenue_center_name)' AS check_name,
 {big("count(*) FILTER (revenue_center_name NOT IN ('Beverage', 'Food', 'Retail', 'Other'))")} AS failures FROM dp
 UNION ALL SELECT 'stg_orders', 'accepted_values(revenue_center)', {big("count(*) FILTER (revenue_center = 'Other')")} FROM st"""),
    "T5_non_negative": q(f"SELECT source_system, order_id, product_key, {dbl('qty')} AS qty FROM fi WHERE fi.qty < 0"),
    "T6_order_count_additive": q("""SELECT date_key, CAST(0 AS BIGINT) AS summed_orders, CAST(0 AS BIGINT) AS distinct_orders
 FROM fo WHERE FALSE"""),
    "T6_legacy_count_not_additive": q(f"""SELECT date_key, {big('s')} AS summed_orders, {big('t')} AS distinct_orders FROM (
 SELECT date_key, sum(c) AS s FROM (SELECT date_key, count(DISTINCT order_id) AS c FROM il
  GROUP BY date_key, store_key, product_key, destination_key) GROUP BY 1)
 FULL JOIN (SELECT date_key, count(*) AS t FROM fo GROUP BY 1) USING (date_key) WHERE coalesce(s, 0) <> coalesce(t, 0)"""),
    "T7_qty_additive": q("""SELECT source_system, order_id, CAST(0 AS DOUBLE) AS fact_qty, CAST(0 AS DOUBLE) AS truth_qty
 FROM fo WHERE FALSE"""),
    "T7_qty_without_returns": q(f"""SELECT source_system, order_id, {dbl('f')} AS fact_qty, {dbl('t')} AS truth_qty FROM (
 SELECT source_system, order_id, sum(qty) FILTER (qty > 0) AS f, sum(qty) AS t FROM fi GROUP BY 1, 2)
 WHERE coalesce(f, 0) <> t"""),
    "T8_items_have_orders": q("SELECT source_system, order_id FROM fo WHERE FALSE"),
    "T8_items_of_small_orders": q("SELECT source_system, order_id FROM fo WHERE order_net_sales <= 100000"),
    "T9_coverage_a": q("SELECT src AS source_system, d AS sale_date FROM bac WHERE FALSE"),
    "T9_coverage_a_before_precedence": q("""SELECT DISTINCT 'feed_c' AS source_system, d AS sale_date FROM rc
 WHERE NOT void AND d NOT IN (SELECT sale_date FROM sa WHERE _source_system = 'feed_c')"""),
    "T9_coverage_b": q("SELECT 'feed_b' AS source_system, d AS sale_date FROM rb WHERE FALSE"),
    "T10_lost_slices": q(f"""SELECT loc AS store_name, d AS business_date, {big('count(*)')} AS entry_rows FROM rc
 WHERE EXISTS (SELECT 1 FROM ra WHERE ra.loc = rc.loc AND ra.d = rc.d) GROUP BY 1, 2"""),
    "T11_source_profile": q(f"""SELECT src AS source_system, {big('count(*)')} AS row_count, min(d) AS first_day, max(d) AS last_day
 FROM bac GROUP BY 1"""),
    "T11_two_source_days": q(f"""SELECT loc AS location, d AS sale_date, {big('count(DISTINCT src)')} AS sources,
 {big('count(*)')} AS row_count FROM (SELECT loc, d, src FROM ra UNION ALL SELECT loc, d, src FROM rc)
 GROUP BY 1, 2 HAVING count(DISTINCT src) > 1"""),
    "T12_duplicate_items": q(f"""SELECT oid AS order_id, pk AS item_id, {big('count(*)')} AS lines FROM bac
 GROUP BY 1, 2 HAVING count(*) > 1"""),
    "T12_missing_order_ids": q(f"SELECT src AS source_system, {big('count(*) - count(oid)')} AS rows_without_order FROM bac GROUP BY 1"),
    "T12_line_sequence": q(f"""SELECT oid AS order_id, pk AS item_id, {dbl('net')} AS net_sales, {dbl('bac.price')} AS price,
 row_number() OVER (PARTITION BY oid, pk ORDER BY md5(CAST(net AS VARCHAR) || '|' || CAST(bac.price AS VARCHAR))) AS line_seq FROM bac"""),
    "T13_catalog_coverage": q(f"""SELECT {big('count(*)')} AS items, {big('count(*) FILTER (n > 0)')} AS named_items,
 {big('count(*) FILTER (n > 1)')} AS ambiguous_items, {rdiv('count(*) FILTER (n > 0)', 'count(*)', 4)} AS named_share
 FROM (SELECT pk, count(DISTINCT upper(trim(iname))) AS n FROM ra GROUP BY 1)"""),
    "T14_named_against_unknown": q(f"""SELECT bucket, {big('r')} AS row_count, {big('e')} AS employees, {dbl('n')} AS net_sales,
 {rdiv('r', 'tr', 4)} AS row_share, {rdiv('n', 'tn', 4)} AS net_share FROM (SELECT bucket, r, e, n, sum(r) OVER () AS tr,
 sum(n) OVER () AS tn FROM (SELECT CASE WHEN employee_key = 0 THEN 'UNKNOWN' ELSE 'named' END AS bucket, count(*) AS r,
 count(DISTINCT employee_key) AS e, sum(net_sales) AS n FROM fe GROUP BY 1))"""),
    "T15_key_cardinality": q(" UNION ALL ".join(
        f"""SELECT '{n}' AS candidate, {big('count(*)')} AS distinct_values, {big('sum(c)')} AS row_count,
 {rdiv('sum(c)', 'count(*)', 2)} AS lines_per_value, {big('max(c)')} AS largest_group FROM (SELECT {c} AS k, count(*) AS c FROM rb GROUP BY 1)"""
        for n, c in (("Identifier", "ident"), ("Reference", "ref"), ("Account", "account")))),
}
TWINS["A17_mark_processed"] = q(f"""SELECT source_name, filename,
 {big("row_count + CASE WHEN mf.loaded_at >= TIMESTAMP '2001-01-01' THEN 1 ELSE 0 END")} AS row_count,
 CASE WHEN mf.loaded_at >= TIMESTAMP '2001-01-01' THEN '2001-08-10 06:00:00' ELSE {ts('mf.loaded_at')} END AS loaded_at FROM mf""")
TWINS["A10_entries_to_bronze_direct"] = TWINS["A10_entries_to_bronze"]
TWINS["Q45_source_by_month_data"] = TWINS["M2_source_by_month"]
