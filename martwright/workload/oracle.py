"""The same results in plain SQL, written from the definitions and not from the DataFrame
code. Shared parts are CTEs."""

# One row per line with the roles of the marts.
SALES = """
sales AS (
  SELECT n_name AS county, p_type AS category_name, l_shipdate AS sale_date,
         l_quantity AS liters, l_extendedprice AS dollars
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

PEOPLE = """
people AS (
  SELECT CAST(n_nationkey AS BIGINT) AS fips, n_name AS county,
         CAST(year(o_orderdate) AS BIGINT) AS year,
         count(DISTINCT o_custkey) AS population
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL
)"""

REGION_PEOPLE = """
region_people AS (
  SELECT county, fips, round(avg(population)) AS avg_population,
         round(CAST(sum(population) AS DOUBLE)) AS sum_population
  FROM people WHERE year BETWEEN 1996 AND 1999 GROUP BY county, fips
)"""

REGION_TOTALS = """
region_totals AS (
  SELECT county, round(sum(liters)) AS total_sold_liters, round(sum(dollars)) AS total_sale_dollars
  FROM sales WHERE year(sale_date) BETWEEN 1996 AND 1999 GROUP BY county
)"""

TOP = """
top AS (
  SELECT county, category_name, sum(liters) AS liters,
         row_number() OVER (PARTITION BY county
                            ORDER BY sum(liters) DESC NULLS LAST, category_name) AS row_order
  FROM sales GROUP BY county, category_name
)"""

REGION_MART = """
region_mart AS (
  SELECT t.county, p.avg_population, p.fips, t.total_sold_liters, t.total_sale_dollars,
         round(t.total_sold_liters / p.sum_population, 2) AS liters_per_person, top.category_name
  FROM region_totals t
  JOIN region_people p ON t.county = p.county
  JOIN top ON top.county = t.county AND top.row_order = 1
)"""

_BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def title(value: str) -> str:
    """The title-casing rules over lists of words and of hyphen pieces.

    Title case of the sharp s is ``Ss``. SQL has no title case and its upper case is another
    letter, so this one letter of the test texts is spelled out.
    """

    def capital(word: str) -> str:
        first = f"CASE {word}[1:1] WHEN 'ß' THEN 'Ss' ELSE upper({word}[1:1]) END"
        return f"({first}) || lower({word}[2:])"

    words = (
        f"array_to_string(list_transform(list_filter(regexp_split_to_array({value}, '{_BLANKS}'), "
        f"lambda w: w <> ''), lambda w: {capital('w')}), ' ')"
    )
    pieces = (
        "list_transform([words], lambda a: CASE WHEN contains(a, '-') THEN "
        f"array_to_string(list_transform(string_split(a, '-'), lambda w: {capital('w')}), '-') "
        "ELSE a END)[1]"
    ).replace("words", words)
    return (
        "list_transform([pieces], lambda b: CASE WHEN b[2:2] = '''' OR b[1:2] = 'Mc' "
        "THEN b[1:2] || upper(b[3:3]) || b[4:] ELSE b END)[1]"
    ).replace("pieces", pieces)


# All 24 columns, raw spelling.
FULL_SALES = """
full_sales AS (
  SELECT 'INV-' || l_orderkey || '-' || l_linenumber AS invoice_item_number,
         l_shipdate AS sale_date,
         l_suppkey AS store_number,
         'STORE-' || o_orderpriority AS store_name,
         upper(p_name) || '  ROAD' AS address,
         CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS city,
         lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip_code,
         'POINT (-' || n_nationkey || ' ' || p_size || ')' AS store_location,
         CAST(n_nationkey AS BIGINT) AS county_number,
         n_name AS county,
         CAST(p_size AS BIGINT) AS category,
         p_type AS category_name,
         l_suppkey AS vendor_number,
         'O''' || upper(p_brand) AS vendor_name,
         CAST(l_partkey AS VARCHAR) AS item_number,
         'MC' || upper(p_name) || ', "' || p_brand || '"' AS item_description,
         CAST(p_size AS BIGINT) AS pack,
         CASE WHEN p_size <= 45 THEN CAST(p_size AS BIGINT) * 25 END AS bottle_volume_ml,
         p_retailprice AS state_bottle_cost,
         l_tax AS state_bottle_retail,
         CAST(l_quantity AS BIGINT) AS bottles_sold,
         l_extendedprice AS sale_dollars,
         l_quantity AS volume_sold_liters,
         l_discount AS volume_sold_gallons
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

CLEANSED = f"""
valid AS (
  SELECT * FROM full_sales WHERE city <> '' AND county <> '' AND county <> 'NATION_5'
),
replaced AS (
  SELECT * REPLACE (
    CASE county WHEN 'NATION_1' THEN 'Nation One' WHEN 'NATION_2' THEN 'O''NATION'
                ELSE county END AS county,
    CASE city WHEN 'HOUSEHOLD' THEN 'HOUSE-HOLD' WHEN 'MACHINERY' THEN 'MACHINE  TOWN'
              ELSE city END AS city)
  FROM valid
),
overridden AS (
  SELECT * REPLACE (
    CASE WHEN city = 'FURNITURE' AND county = 'NATION_3' THEN 'NATION_9'
         WHEN city = 'BUILDING' AND county = 'O''NATION' THEN 'MCNATION'
         WHEN city = 'MACHINE  TOWN' AND county = 'NATION_4' THEN 'NATION_8'
         ELSE county END AS county)
  FROM replaced
),
cleansed AS (
  SELECT * REPLACE (
    {title("county")} AS county,
    {title("city")} AS city,
    {title("store_name")} AS store_name,
    {title("address")} AS address,
    {title("category_name")} AS category_name,
    {title("vendor_name")} AS vendor_name,
    {title("item_description")} AS item_description)
  FROM overridden
)"""

RAW_PEOPLE = """
raw_people AS (
  SELECT fips, county, year, CASE WHEN year = 1997 THEN 0 ELSE population END AS population,
         CAST(-(fips + 0.5) AS DOUBLE) AS lon, CAST(year AS DOUBLE) AS lat
  FROM (SELECT * REPLACE (upper(county[1:1]) || lower(county[2:]) AS county) FROM people)
)"""

LOCATIONS = """
locations AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 9000 THEN c_mktsegment END AS city,
         CASE WHEN n_name = 'NATION_7' THEN '' WHEN n_name = 'NATION_8' THEN 'nation_8'
              WHEN n_name <> 'NATION_9' THEN n_name END AS county
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_REGION_PARTS = (SALES, PEOPLE, REGION_PEOPLE, REGION_TOTALS, TOP, REGION_MART)

ORACLES = {
    "mart_year_totals": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS sale_year, round(sum(l_quantity)) AS total_sold_liters
FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1999 GROUP BY ALL""",
    "mart_category_totals": """
SELECT p_type AS category_name, round(sum(l_quantity)) AS total_sold_liters
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE year(l_shipdate) BETWEEN 1996 AND 1999 GROUP BY ALL""",
    "mart_region_totals": f"{_with(*_REGION_PARTS)} SELECT * FROM region_mart",
    "population_by_region": f"{_with(PEOPLE, REGION_PEOPLE)} SELECT * FROM region_people",
    "region_totals_enriched": f"""{_with(SALES, PEOPLE, REGION_PEOPLE, REGION_TOTALS)}
SELECT county, total_sold_liters, total_sale_dollars, fips, avg_population, sum_population
FROM region_totals JOIN region_people USING (county)""",
    "top_category_per_region": f"""{_with(SALES, TOP)}
SELECT county, category_name, round(liters) AS total_sold_liters,
       CAST(row_order AS INTEGER) AS row_order
FROM top WHERE row_order = 1""",
    "region_totals_with_top_category": f"""{_with(SALES, REGION_TOTALS, TOP)}
SELECT t.county, t.total_sold_liters, t.total_sale_dollars, top.category_name
FROM region_totals t JOIN top ON top.county = t.county AND top.row_order = 1""",
    "filter_invalid_locations": f"""{_with(LOCATIONS)}
SELECT * FROM locations WHERE city <> '' AND county <> '' AND county <> 'NATION_8'""",
    "repair_values": """
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Promotion' ELSE p_type END AS p_type,
       CASE p_brand WHEN 'Brand#1' THEN 'Brand#25' WHEN 'Brand#25' THEN 'O''Brand'
                    ELSE p_brand END AS p_brand
FROM part""",
    "repair_pairs": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '1-Late'
            WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED'
            ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
    "repair_from_rule_tables": f"""{_with(LOCATIONS)},
replaced AS (
  SELECT c_custkey, city, coalesce(r_name, county) AS county
  FROM locations LEFT JOIN nation ON county = n_name
                 LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <= 1
),
rich AS (
  SELECT c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL HAVING max(c_acctbal) > 9500
)
SELECT c_custkey, city, CASE WHEN rich.n_name IS NULL THEN county
                             ELSE 'RICH ' || rich.n_name END AS county
FROM replaced LEFT JOIN rich ON city = rich.c_mktsegment AND county = rich.n_name""",
    "title_case_names": f"""
SELECT source, id, {title("raw")} AS name FROM (
  SELECT 'orders' AS source, o_orderkey AS id, o_orderpriority AS raw FROM orders
  UNION ALL SELECT 'customer', c_custkey, c_mktsegment || '  ' || c_name FROM customer
  UNION ALL SELECT 'part', p_partkey, p_type || '  ' || p_name || '  ' || p_brand FROM part
)""",
    "title_case_documents": f"SELECT doc_id, {title('text')} AS text FROM documents",
    "title_case_conversations": f"""
SELECT conv_id, turn, {title("role")} AS role, {title("text")} AS text FROM conversations""",
    "cleansed_sales": f"""{_with(FULL_SALES, CLEANSED)}
SELECT * REPLACE (strftime(sale_date, '%Y-%m-%d') AS sale_date) FROM cleansed""",
    "prepare_population": f"""{_with(PEOPLE, RAW_PEOPLE)}
SELECT fips, county, year, population, lon, lat FROM raw_people
UNION ALL SELECT 106, county, year, population, lon, lat FROM raw_people WHERE fips = 6""",
    "csv_landing_roundtrip": f"""{_with(FULL_SALES)}
SELECT * REPLACE (strftime(sale_date, '%Y-%m-%d') AS sale_date) FROM full_sales""",
    "typed_columns": """
SELECT o_orderkey AS key, 
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')
            THEN o_custkey END AS number,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
       CASE o_orderpriority WHEN '3-MEDIUM' THEN 'NA' WHEN '5-LOW' THEN ''
                            ELSE o_orderpriority END AS note
FROM orders""",
    "parsed_dates": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS at,
       CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%Y-%m-01') AS month
FROM orders""",
    "parse_point": """
SELECT c_custkey, CASE WHEN c_nationkey NOT IN (3, 4) THEN c_acctbal END AS lon,
       CASE WHEN c_nationkey NOT IN (3, 4) THEN CAST(c_nationkey AS DOUBLE) END AS lat
FROM customer""",
    "partitioned_table_roundtrip": f"""{_with(SALES)}
SELECT strftime(sale_date, '%Y-%m-01') AS sale_month, county,
       round(sum(liters), 2) AS total_sold_liters, round(sum(dollars), 2) AS total_sale_dollars
FROM sales WHERE year(sale_date) BETWEEN 1996 AND 1999 GROUP BY ALL""",
    "loaded_dimension": f"{_with(PEOPLE)} SELECT fips, county, year, population FROM people",
    "full_refresh": f"""{_with(
        PEOPLE, FULL_SALES, CLEANSED, RAW_PEOPLE,
        '''
sales AS (
  SELECT county, category_name, sale_date, volume_sold_liters AS liters, sale_dollars AS dollars
  FROM cleansed
)''',
        '''
region_people AS (
  SELECT county, fips, round(avg(population)) AS avg_population,
         round(CAST(sum(population) AS DOUBLE)) AS sum_population
  FROM (SELECT fips, county, year, population FROM raw_people
        UNION ALL SELECT 106, county, year, population FROM raw_people WHERE fips = 6)
  WHERE year BETWEEN 1996 AND 1999 GROUP BY county, fips
)''',
        REGION_TOTALS, TOP, REGION_MART)}
SELECT 'dm_total_county_sale' AS mart, county, avg_population, fips, total_sold_liters,
       total_sale_dollars, liters_per_person, category_name, CAST(NULL AS INTEGER) AS sale_year
FROM region_mart
UNION ALL BY NAME
SELECT 'dm_total_year_sale' AS mart, CAST(year(sale_date) AS INTEGER) AS sale_year,
       round(sum(liters)) AS total_sold_liters
FROM sales WHERE year(sale_date) BETWEEN 1996 AND 1999 GROUP BY sale_year
UNION ALL BY NAME
SELECT 'dm_total_category_sale' AS mart, category_name, round(sum(liters)) AS total_sold_liters
FROM sales WHERE year(sale_date) BETWEEN 1996 AND 1999 GROUP BY category_name""",
}
