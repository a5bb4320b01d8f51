"""The registered queries as plain SQL for another engine, for cross-checking.

Written from the definition of each result, without the rewrites the Spark jobs use:
all joins, window functions without keys, joins before the distinct.
"""

from __future__ import annotations

from .. import schemas as s
from ..operators.census import AGE_SHARES

_OWN = """
  l_orderkey * 8 + l_linenumber AS id,
  l_returnflag AS room_type,
  CASE WHEN l_linestatus = 'O' THEN 't' ELSE 'f' END AS has_availability,
  CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS year_month,
  CAST(CAST(l_quantity AS INTEGER) % 31 AS INTEGER) AS availability_30,
  CAST(floor(l_extendedprice / 10000) * 50 + 50 AS DECIMAL(12,2)) AS price,
  CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) * 10 AS DOUBLE) END
    AS review_scores_rating
"""

_LISTINGS = f"""
f AS (
SELECT {_OWN},
  CAST(c_custkey AS VARCHAR) AS host_id, c_name AS host_name,
  CASE WHEN c_acctbal > 5000 THEN 't' ELSE 'f' END AS host_is_superhost,
  n_name AS neighbourhood_cleansed,
  p_type AS property_type, CAST(p_size % 8 + 1 AS INTEGER) AS accommodates
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
)"""

_HOST_LISTINGS = f"""
f AS (
SELECT {_OWN}, CAST(o_orderkey AS VARCHAR) AS host_id, n_name AS neighbourhood_cleansed
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
)"""

_LGA = """
lga AS (
SELECT n_name AS neighbourhood_cleansed,
  CASE WHEN n_nationkey % 5 = 2 THEN n_name ELSE r_name END AS lga_name,
  CAST(n_nationkey + 20000 AS VARCHAR) AS code_2016
FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def _census_columns() -> str:
    topics = len(s.CENSUS_FACT_TOPICS)
    counts = []
    for position, topic in enumerate(s.CENSUS_FACT_TOPICS):
        mine = f"c_custkey % {topics} = {position}"
        counts += [
            f"count(CASE WHEN {mine} AND c_acctbal < 5000 THEN 1 END) AS {topic}_M",
            f"count(CASE WHEN {mine} AND NOT c_acctbal < 5000 THEN 1 END) AS {topic}_F",
            f"count(CASE WHEN {mine} THEN 1 END) AS {topic}_P",
        ]
    medians = [
        f"CAST(100 + (count(*) * {position + 7}) % 400 AS DECIMAL(12,4)) + 0.5 AS {name}"
        for position, name in enumerate(s.CENSUS_MEDIANS)
    ]
    return ",\n  ".join(counts + medians)


_CENSUS = f"""
census AS (
SELECT c.*, lga.lga_name FROM (
SELECT CAST(c_nationkey + 20000 AS VARCHAR) AS LGA_CODE_2016,
  {_census_columns()}
FROM customer GROUP BY 1) c
JOIN lga ON c.LGA_CODE_2016 = lga.code_2016
)"""

_DELIVERED = """
d AS (
SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS id,
  CAST(o_custkey AS VARCHAR) AS host_id,
  CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE c_name END AS host_name,
  CASE WHEN c_acctbal > 5000 THEN 't' ELSE 'f' END AS host_is_superhost,
  CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE c_mktsegment END AS host_neighbourhood,
  n_name AS neighbourhood_cleansed, p_type AS property_type, l_returnflag AS room_type,
  CASE WHEN l_linestatus = 'O' THEN 't' ELSE 'f' END AS has_availability,
  CAST(p_size % 8 + 1 AS INTEGER) AS accommodates,
  CAST(CAST(l_quantity AS INTEGER) % 31 AS INTEGER) AS availability_30,
  CAST(l_linenumber AS INTEGER) AS number_of_reviews,
  CASE WHEN l_discount = 0 THEN NULL
       ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) * 10 AS DOUBLE) END
    AS review_scores_rating,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
  CAST(p_size AS VARCHAR) AS bedrooms, p_name AS amenities,
  CAST(monthname(l_shipdate) AS VARCHAR) AS month,
  CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS year_month,
  CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
)"""

_RAW = (
    _DELIVERED
    + """,
lookup AS (
SELECT DISTINCT c_mktsegment AS suburb, 'LGA_' || c_mktsegment AS area FROM customer
WHERE c_mktsegment NOT IN ('FURNITURE', 'MACHINERY')
UNION ALL SELECT DISTINCT c_mktsegment, a.area FROM customer,
  (VALUES ('LGA_NORTH'), ('LGA_SOUTH')) a(area) WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT NULL, 'LGA_UNKNOWN'
),
r AS (
SELECT d.*, lookup.area AS host_neighbourhood_cleansed
FROM d LEFT JOIN lookup ON d.host_neighbourhood IS NOT DISTINCT FROM lookup.suburb
)"""
)

_HOST = ", ".join(s.HOST_KEY)
_PROPERTY = ", ".join(s.PROPERTY_KEY)


def _half_up(numerator: str, denominator: str) -> str:
    """Two digits, half up, in integers; both arguments are non-negative integers."""
    return (
        f"CAST((200 * ({numerator}) + ({denominator})) // (2 * ({denominator})) AS DOUBLE) / 100"
    )


def _with(*parts_and_select: str) -> str:
    *parts, select = parts_and_select
    return "WITH " + ",".join(parts) + select


def _family(number: int, keys: list[str]) -> dict[str, str]:
    k = ", ".join(keys)
    groups = [c for c in keys if c != "year_month"]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in [*groups, "year_month"])

    def change(flag: str, name: str, condition: str, over: str = "") -> str:
        return _with(
            _LISTINGS,
            f"""
, c AS (SELECT {k}, count(CASE WHEN has_availability = '{flag}' THEN 1 END) AS {name}
FROM f GROUP BY {k})
SELECT {k}, {name},
  CAST({name} AS DOUBLE) / CAST(nullif(lag({name}) OVER ({over} ORDER BY {order}), 0) AS DOUBLE)
    - 1.0 AS running_diff_per
FROM c {condition}""",
        )

    label = "area" if number == 1 else "property"
    partition = "PARTITION BY " + ", ".join(groups)
    positive = "WHERE {0} > 0".format
    return {
        f"q{number}_1_active_rate": _with(
            _LISTINGS,
            f"""
, c AS (SELECT {k}, count(CASE WHEN has_availability = 't' THEN 1 END) AS active_listings,
  count(*) AS total_listings FROM f GROUP BY {k})
SELECT *, {_half_up("active_listings", "total_listings")} AS active_listings_rate FROM c""",
        ),
        f"q{number}_2_price_stats": _with(
            _LISTINGS,
            f"""
SELECT {k}, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
  CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY price) AS DOUBLE) AS median_price,
  CAST((2 * sum(CAST(price * 100 AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
    AS average_price
FROM f GROUP BY {k}""",
        ),
        f"q{number}_3_distinct_hosts": _with(
            _LISTINGS,
            f" SELECT {k}, count(DISTINCT host_id) AS distinct_host_count FROM f GROUP BY {k}",
        ),
        f"q{number}_4_superhost_rate": _with(
            _LISTINGS,
            f"""
, c AS (SELECT {k},
  count(DISTINCT CASE WHEN host_is_superhost = 't' THEN host_id END) AS supers,
  count(DISTINCT host_id) AS hosts FROM f GROUP BY {k})
SELECT {k}, {_half_up("supers", "hosts")} AS superhost_rate FROM c""",
        ),
        f"q{number}_5_avg_rating_active": _with(
            _LISTINGS,
            f"""
, c AS (SELECT {k}, CAST(sum(review_scores_rating) AS BIGINT) AS total, count(*) AS n FROM f
WHERE has_availability = 't' AND NOT isnan(review_scores_rating) GROUP BY {k})
SELECT {k}, {_half_up("total", "n")} AS average_review_scores_rating FROM c""",
        ),
        f"q{number}_6_pct_change_active": change(
            "t", "active_listings", positive("active_listings") if number == 2 else ""
        ),
        f"q{number}_7_pct_change_inactive": change(
            "f", "inactive_listings", positive("inactive_listings")
        ),
        f"pct_change_by_group_{label}_active": change("t", "active_listings", "", partition),
        f"pct_change_by_group_{label}_inactive": change(
            "f", "inactive_listings", positive("inactive_listings"), partition
        ),
        f"q{number}_8_stays": _with(
            _LISTINGS,
            f" SELECT {k}, CAST(sum(30 - availability_30) AS BIGINT) AS number_of_stays "
            f"FROM f GROUP BY {k}",
        ),
        f"q{number}_9_revenue": _with(
            _LISTINGS,
            f"""
, c AS (SELECT {k}, 30 - availability_30 AS number_of_stays, price FROM f
GROUP BY {k}, number_of_stays, price)
SELECT {k}, CAST(sum(number_of_stays * price) AS DOUBLE) AS estimated_revenue_per_active_listings
FROM c GROUP BY {k}""",
        ),
    }


def _lga_views() -> dict[str, str]:
    joined = "FROM f JOIN lga ON lga.neighbourhood_cleansed = f.neighbourhood_cleansed"
    money = (
        "CAST(sum((30 - availability_30) * price) AS DOUBLE) "
        "AS estimated_revenue_per_active_listings"
    )
    return {
        "q3_1_distinct_hosts_lga": _with(
            _LISTINGS, _LGA,
            f" SELECT lga_name AS host_lga_cleansed, year_month, "
            f"count(DISTINCT host_id) AS distinct_host_count {joined} GROUP BY 1, 2",
        ),
        "q3_2_revenue_lga": _with(
            _LISTINGS, _LGA,
            f" SELECT lga_name AS host_lga_cleansed, year_month, {money} {joined} GROUP BY 1, 2",
        ),
        "q3_3_revenue_host_lga": _with(
            _LISTINGS, _LGA,
            f" SELECT host_id, lga_name AS host_lga_cleansed, year_month, {money} {joined} "
            f"GROUP BY 1, 2, 3",
        ),
    }


def _age_views() -> dict[str, str]:
    """Shares carry 19 digits and averages four more, in integers, as decimals would."""
    unit19, unit4 = "CAST(10000000000000000000 AS HUGEINT)", "CAST(10000 AS HUGEINT)"
    total = " + ".join(AGE_SHARES)
    parts = ", ".join(
        f"CASE WHEN total > 0 THEN (2 * {count} * {unit19} + total) // (2 * total) END AS {share}"
        for count, share in AGE_SHARES.items()
    )
    averages = ", ".join(
        f"(2 * sum({p}) * {unit4} + count({p})) // (2 * count({p})) AS {p}" for p in AGE_SHARES.values()
    )
    base = f"""
, rev AS (SELECT lga_name, code_2016,
  CAST(sum((30 - availability_30) * CAST(price * 100 AS BIGINT)) AS HUGEINT) AS cents
FROM f JOIN lga ON lga.neighbourhood_cleansed = f.neighbourhood_cleansed GROUP BY 1, 2),
people AS (SELECT *, CAST({total} AS HUGEINT) AS total FROM census),
shares AS (SELECT rev.lga_name, cents, {parts}
FROM rev JOIN people ON people.LGA_CODE_2016 = rev.code_2016),
by_lga AS (SELECT lga_name,
  (2 * sum(cents) * {unit4} + count(*)) // (2 * count(*)) AS micro, {averages}
FROM shares GROUP BY lga_name)"""
    d12 = "CAST(100000000000 AS HUGEINT)"  # 23 digits down to 12

    def digits12(value: str, n: str) -> str:
        return f"CAST((2 * {value} + {n} * {d12}) // (2 * {n} * {d12}) AS DOUBLE) / 1e12"

    rows = ", ".join(f"{digits12(p, '1')} AS {p}" for p in AGE_SHARES.values())
    overall = ", ".join(
        f"{digits12(f'sum({p})', f'count({p})')} AS {p}" for p in AGE_SHARES.values()
    )
    first = f" SELECT lga_name, CAST(micro AS DOUBLE) / 1e6 AS agg_revenue, {rows} FROM by_lga"
    mean = " + ".join(f"CAST({p} AS DOUBLE)" for p in AGE_SHARES.values())
    ctes = (_LISTINGS, _LGA, _CENSUS)
    return {
        "q4_a_1_revenue_age_shares": _with(*ctes, base + first),
        "q4_a_2_revenue_age_shares_view": _with(*ctes, base + first),
        "q4_a_3_overall_age_shares": _with(
            *ctes,
            base + f" SELECT CAST((2 * sum(micro) + count(*)) // (2 * count(*)) AS DOUBLE) / 1e6 "
            f"AS avg_revenue, {overall} FROM by_lga",
        ),
        "q4_a_4_average_age_share": _with(
            *ctes,
            base + f" SELECT round(({mean}) / 1e23 / {len(AGE_SHARES)}, 2) AS average "
            f"FROM by_lga ORDER BY micro DESC NULLS FIRST, lga_name ASC NULLS LAST LIMIT 1",
        ),
    }


def _host_views() -> dict[str, str]:
    singles = "SELECT host_id FROM f GROUP BY host_id HAVING count(id) = 1"
    cover = """
, earned AS (SELECT host_id, (30 - availability_30) * price AS estimated_revenue FROM f),
pairs AS (SELECT e.host_id, f.neighbourhood_cleansed, lga.code_2016, e.estimated_revenue,
  census.Median_mortgage_repay_monthly * 12 AS annualised_median_mortgage_repay
FROM f JOIN earned e ON e.host_id = f.host_id
JOIN lga ON lga.neighbourhood_cleansed = f.neighbourhood_cleansed
JOIN census ON census.LGA_CODE_2016 = lga.code_2016
GROUP BY ALL),
cover AS (SELECT host_id, neighbourhood_cleansed, code_2016,
  CAST(estimated_revenue AS DOUBLE) AS estimated_revenue,
  CAST(annualised_median_mortgage_repay AS DOUBLE) AS annualised_median_mortgage_repay,
  CASE WHEN estimated_revenue >= annualised_median_mortgage_repay THEN 1 ELSE 0 END AS covered
FROM pairs)"""
    one = f"""
, one AS (SELECT c.host_id, neighbourhood_cleansed, estimated_revenue,
  annualised_median_mortgage_repay, covered
FROM cover c JOIN ({singles}) h ON h.host_id = c.host_id)"""
    ctes = (_HOST_LISTINGS, _LGA, _CENSUS)
    return {
        "q4_c_host_area_match": _with(
            _HOST_LISTINGS, _LGA,
            """
, totals AS (SELECT host_id, count(*) AS total_listings FROM f GROUP BY host_id)
SELECT DISTINCT totals.host_id, total_listings, f.neighbourhood_cleansed AS property_lga,
  lga_name AS host_lga, CASE WHEN f.neighbourhood_cleansed = lga_name THEN 1 END AS match
FROM totals JOIN f ON f.host_id = totals.host_id
JOIN lga ON lga.neighbourhood_cleansed = f.neighbourhood_cleansed""",
        ),
        "q4_d_1_one_listing_hosts": _with(_HOST_LISTINGS, " " + singles),
        "q4_d_2_mortgage_cover": _with(*ctes, cover + " SELECT * FROM cover"),
        "ordered_cover": _with(
            *ctes, cover + " SELECT * FROM cover ORDER BY estimated_revenue DESC NULLS FIRST"
        ),
        "q4_d_3_mortgage_cover_one_listing": _with(*ctes, cover + one + " SELECT * FROM one"),
        "cover_count_all_hosts": _with(
            *ctes, cover + " SELECT covered, count(covered) AS count FROM cover GROUP BY covered"
        ),
        "q4_d_4_cover_count": _with(
            *ctes, cover + one + " SELECT covered, count(covered) AS count FROM one GROUP BY covered"
        ),
    }


def _kind_views() -> dict[str, str]:
    kind = "neighbourhood_cleansed, property_type, room_type, accommodates"
    revenue = f"""
, pairs AS (SELECT {kind}, 30 - availability_30 AS number_of_stays, price FROM f
GROUP BY {kind}, number_of_stays, price),
kinds AS (SELECT {kind}, number_of_stays * price AS revenue FROM pairs)"""
    return {
        "q4_b_1_revenue_per_kind": _with(
            _LISTINGS,
            revenue + f" SELECT {kind}, CAST(revenue AS DOUBLE) AS revenue FROM kinds",
        ),
        "q4_b_2_best_listing_type": _with(
            _LISTINGS,
            revenue
            + f"""
, summary AS (SELECT {kind}, CAST(sum(revenue) AS DOUBLE) AS revenue_agg,
  CAST(row_number() OVER (PARTITION BY neighbourhood_cleansed ORDER BY sum(revenue) DESC NULLS FIRST,
    property_type NULLS LAST, room_type NULLS LAST, accommodates NULLS LAST) AS INTEGER) AS rank
FROM kinds GROUP BY {kind})
SELECT * FROM summary WHERE rank = 1
ORDER BY revenue_agg DESC NULLS FIRST, {kind} LIMIT 5""",
        ),
    }


def _load_and_warehouse() -> dict[str, str]:
    typed_raw = _with(_RAW, " SELECT * FROM r")
    amount = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE)"
    digits = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
    csv = _with(
        _DELIVERED,
        """ SELECT id, {0} AS host_name, amenities || ', "wifi"' || chr(10) || 'heating' AS amenities,
  '$' || format('{{:,.2f}}', price) AS price FROM d""",
    )
    host_match = " AND ".join(f"r.{c} IS NOT DISTINCT FROM h.{c}" for c in s.HOST_KEY[:-1])
    counts = ", ".join(s.CENSUS_FACT_COUNTS)
    medians = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in s.CENSUS_MEDIANS)
    rate = _half_up("active_listings", "total_listings")
    return {
        **dict.fromkeys(
            ["lookup_left_join", "lookup_csv", "snapshot_load", "month_load_incremental"],
            _with(
                _RAW,
                " SELECT id, CAST(year_month AS VARCHAR) AS year_month, host_id, host_neighbourhood, "
                "host_neighbourhood_cleansed FROM r",
            ),
        ),
        "snapshot_load_layouts": _with(
            _RAW,
            """ SELECT id, CAST(year_month AS VARCHAR) AS year_month, host_id, host_neighbourhood,
  host_neighbourhood_cleansed, CASE WHEN year_month < 199507 THEN '' ELSE bedrooms END AS bedrooms, amenities FROM r""",
        ),
        "month_load_ledger": _with(
            _RAW,
            " SELECT id, CAST(year_month AS VARCHAR) AS year_month, host_id, host_neighbourhood, "
            "host_neighbourhood_cleansed FROM r WHERE year_month NOT IN (199504, 199505) "
            "AND (year_month <> 199503 OR CAST(id AS BIGINT) % 2 = 0)",
        ),
        "star_rejects": _with(
            _RAW,
            """ SELECT year_month, CASE WHEN max(year) < 1998 THEN count(*) END AS kept, count(*) AS rows,
  count(CASE WHEN year < 1997 OR room_type <> 'R' THEN 1 END) AS with_guests,
  count(CASE WHEN year < 1997 OR number_of_reviews <> 1 THEN 1 END) AS with_price, TRUE AS refused
FROM r GROUP BY year_month""",
        ),
        "star_host_parts": _with(
            _RAW,
            f"""
, h AS (SELECT DISTINCT {_HOST} FROM r UNION
  SELECT DISTINCT {_HOST.replace("host_name", "'Renamed' AS host_name")} FROM r
  WHERE year_month = 199806 AND CAST(host_id AS INTEGER) =
    (SELECT min(CAST(host_id AS INTEGER)) FROM r WHERE year_month = 199806))
SELECT *, TRUE AS own_parts_only FROM h""",
        ),
        "month_conform": _with(
            _DELIVERED,
            """ SELECT id, host_name,
  CASE WHEN year_month IN (199605, 199606) THEN '' END AS bathrooms_text,
  CASE WHEN year_month = 199605 THEN '' ELSE bedrooms END AS bedrooms,
  CASE WHEN year_month = 199605 THEN '' ELSE amenities END AS amenities,
  month, CAST(year_month AS VARCHAR) AS year_month, CAST(year AS VARCHAR) AS year FROM d""",
        ),
        "money_parse": f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber <= 2 THEN -{amount} WHEN l_linenumber = 4 THEN CAST(CAST(concat('98765432', {digits}) AS DECIMAL(19,2)) AS DOUBLE)
    WHEN l_linenumber > 4 THEN {amount} END AS amount
FROM lineitem""",
        "year_month_from_names": _with(
            _DELIVERED,
            " SELECT id, month, CAST(year AS VARCHAR) AS year, "
            "CAST(year_month AS VARCHAR) AS year_month FROM d",
        ),
        "star_add_months": _with(
            _RAW,
            " SELECT neighbourhood_cleansed, year_month, month, host_neighbourhood_cleansed, "
            "count(*) AS rows, CAST(sum(CAST(price AS DECIMAL(12,2))) AS DOUBLE) AS prices "
            "FROM r GROUP BY 1, 2, 3, 4",
        ),
        "csv_scan": csv.format("host_name"),
        "csv_split_scan": csv.format("coalesce(host_name, 'null')"),
        "dim_host": _with(_RAW, f" SELECT DISTINCT {_HOST} FROM r"),
        "dim_property": _with(_RAW, f" SELECT DISTINCT {_PROPERTY} FROM r"),
        "dim_time": _with(_RAW, " SELECT DISTINCT month, year_month, year FROM r"),
        "dim_lga": _with(_LGA, " SELECT * FROM lga"),
        "stored_dim_lga": _with(_LGA, " SELECT *, TRUE AS wrong_schema_refused FROM lga"),
        "listing_fact": typed_raw.replace(
            "SELECT * FROM r",
            f"SELECT CAST(id AS BIGINT) AS id, {_HOST}, {_PROPERTY}, month, year_month, year, "
            "accommodates, availability_30, number_of_reviews, review_scores_rating, price FROM r",
        ),
        "listing_fact_by_join": _with(
            _RAW,
            f"""
, h AS (SELECT DISTINCT {_HOST} FROM r)
SELECT CAST(r.id AS BIGINT) AS id, r.year_month, h.host_id, h.host_neighbourhood_cleansed, r.price
FROM r JOIN h ON {host_match}""",
        ),
        "span_price_stats": _with(
            _LISTINGS,
            f""", g AS (SELECT neighbourhood_cleansed, min(price) AS lo, max(price) AS hi,
  quantile_disc(price, 0.5) AS mid, CAST(sum(price) * 100 AS BIGINT) AS total, count(price) AS known
FROM f WHERE year_month BETWEEN 199601 AND 199812 GROUP BY 1)
SELECT neighbourhood_cleansed, CAST(lo AS DOUBLE) AS min_price, CAST(hi AS DOUBLE) AS max_price,
  CAST(mid AS DOUBLE) AS median_price, {_half_up("total", "known * 100")} AS average_price FROM g""",
        ),
        "span_distinct_hosts": _with(
            _LISTINGS,
            f""", g AS (SELECT neighbourhood_cleansed, count(DISTINCT host_id) AS distinct_host_count,
  count(DISTINCT CASE WHEN host_is_superhost = 't' THEN host_id END) AS supers
FROM f WHERE year_month BETWEEN 199601 AND 199812 GROUP BY 1)
SELECT neighbourhood_cleansed, distinct_host_count, {_half_up("supers", "distinct_host_count")} AS superhost_rate FROM g""",
        ),
        **dict.fromkeys(["star_active_rate", "star_bucketed_rate"], _with(
            _RAW,
            f"""
, c AS (SELECT neighbourhood_cleansed, year_month,
  count(CASE WHEN has_availability = 't' THEN 1 END) AS active_listings,
  count(*) AS total_listings FROM r GROUP BY 1, 2)
SELECT *, {rate} AS active_listings_rate FROM c""",
        )),
        "census_fact": _with(
            _LGA, _CENSUS, f" SELECT LGA_CODE_2016, {counts}, {medians}, lga_name FROM census"
        ),
    }


def _audits() -> dict[str, str]:
    required = ["id", "host_id", "host_name", "host_neighbourhood", "review_scores_rating", "price"]
    null_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM r" for c in required
    )
    rules = [
        "host_key_unique", "property_key_unique", "fact_host_exists", "fact_property_exists",
        "census_code_unique", "time_key_unique", "fact_key_unique", "fact_time_exists", "fact_keys_not_null",
        "census_code_not_null", "spoiled_time_key_unique", "spoiled_fact_key_unique", "spoiled_fact_time_exists",
        "spoiled_fact_keys_not_null",
    ]
    return {
        "audit_unique": _with(
            _LISTINGS,
            " SELECT id, year_month, count(*) AS rows FROM f GROUP BY 1, 2 HAVING count(*) > 1",
        ),
        "audit_fk": _with(
            _RAW,
            " SELECT CAST(id AS BIGINT) AS id, year_month, price FROM r WHERE host_is_superhost <> 't'",
        ),
        "audit_not_null": _with(_RAW, " " + null_rows),
        "audit_casts": _with(
            _RAW,
            """ SELECT id, CAST(year_month AS VARCHAR) AS year_month, host_neighbourhood_cleansed,
  concat_ws(',', CASE WHEN room_type = 'R' THEN 'accommodates' END,
    CASE WHEN number_of_reviews = 1 THEN 'price' END) AS rejected_columns
FROM r WHERE room_type = 'R' OR number_of_reviews = 1""",
        ),
        # each rule counted on the natural keys
        "audit_summary": _with(
            _RAW,
            _LGA,
            _CENSUS,
            f"""
, h AS (SELECT DISTINCT {_HOST} FROM r), p AS (SELECT DISTINCT {_PROPERTY} FROM r)
SELECT rule, CAST(CASE rule
  WHEN 'host_key_unique' THEN (SELECT count(*) FROM (SELECT 1 FROM h GROUP BY {_HOST} HAVING count(*) > 1))
  WHEN 'property_key_unique' THEN
    (SELECT count(*) FROM (SELECT 1 FROM p GROUP BY {_PROPERTY} HAVING count(*) > 1))
  WHEN 'fact_host_exists' THEN (SELECT count(*) FROM r WHERE NOT EXISTS (SELECT 1 FROM h WHERE
    {" AND ".join(f"h.{c} IS NOT DISTINCT FROM r.{c}" for c in s.HOST_KEY)}))
  WHEN 'fact_property_exists' THEN (SELECT count(*) FROM r WHERE NOT EXISTS (SELECT 1 FROM p WHERE
    {" AND ".join(f"p.{c} IS NOT DISTINCT FROM r.{c}" for c in s.PROPERTY_KEY)}))
  WHEN 'census_code_unique' THEN (SELECT count(*) FROM (SELECT 1 FROM census GROUP BY LGA_CODE_2016 HAVING count(*) > 1))
  WHEN 'census_code_not_null' THEN (SELECT count(*) FROM census WHERE LGA_CODE_2016 IS NULL)
  WHEN 'spoiled_time_key_unique' THEN (SELECT count(*) FROM (SELECT DISTINCT month, year_month, year FROM r))
  WHEN 'spoiled_fact_key_unique' THEN (SELECT count(*) FROM r WHERE CAST(accommodates AS DOUBLE) = 1)
  WHEN 'spoiled_fact_time_exists' THEN (SELECT count(*) FROM r WHERE year = 1996)
  WHEN 'spoiled_fact_keys_not_null' THEN (SELECT count(*) FROM r WHERE NOT CAST(accommodates AS DOUBLE) > 2)
  ELSE 0
  END AS BIGINT) AS violations
FROM (VALUES {", ".join(f"('{r}')" for r in rules)}) rules(rule)""",
        ),
    }


def _stores() -> dict[str, str]:
    stays = "CAST(sum(30 - availability_30) AS BIGINT)"
    active = "sum(CASE WHEN has_availability = 't' THEN 30 - availability_30 END)"
    area = "neighbourhood_cleansed, year_month"
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region")
    )
    return {
        "upsert_dim": """
SELECT CAST(c_custkey AS VARCHAR) AS host_id,
  CASE WHEN c_acctbal > 5000 THEN 'New ' || c_name ELSE c_name END AS host_name,
  CASE WHEN c_acctbal > 5000 THEN 't' ELSE 'f' END AS host_is_superhost FROM customer
UNION ALL SELECT 'S' || s_suppkey, s_name, 'f' FROM supplier""",
        "stored_view": _with(
            _LISTINGS,
            f" SELECT {area}, {stays} AS number_of_stays, CAST({active} AS BIGINT) AS kept_stays "
            f"FROM f GROUP BY {area}",
        ),
        "month_refresh_rate": _with(
            _LISTINGS,
            f" SELECT {area}, count(*) FILTER (WHERE has_availability = 't') AS active_listings, "
            "count(*) AS total_listings FROM f "
            f"WHERE has_availability = 't' OR year_month IN (199701, 199902) GROUP BY {area}",
        ),
        "month_refresh": _with(
            _LISTINGS,
            f" SELECT {area}, {stays} AS number_of_stays FROM f "
            f"WHERE has_availability = 't' OR year_month IN (199701, 199902) GROUP BY {area}",
        ),
        "raw_append": _with(
            _LISTINGS,
            " SELECT year_month, 2 * count(*) AS appended_rows, count(*) AS replaced_rows "
            "FROM f GROUP BY year_month",
        ),
        "view_in_sql": _with(
            _LISTINGS,
            " SELECT year_month, count(CASE WHEN has_availability = 't' THEN 1 END) AS active, "
            "count(*) AS total FROM f GROUP BY year_month",
        ),
        "table_counts": counts,
        "table_preview": _with(
            _LISTINGS,
            " SELECT host_id, neighbourhood_cleansed, year_month, id, CAST(price AS DOUBLE) AS price "
            "FROM f ORDER BY id, year_month, price, host_id LIMIT 20",
        ),
        "ordered_stays": _with(
            _LISTINGS,
            f" SELECT {area}, {stays} AS number_of_stays FROM f GROUP BY {area} "
            "ORDER BY neighbourhood_cleansed NULLS LAST, year_month NULLS LAST",
        ),
    }


def all_oracles() -> dict[str, str]:
    return (
        _family(1, ["neighbourhood_cleansed", "year_month"])
        | _family(2, ["property_type", "room_type", "accommodates", "year_month"])
        | _lga_views()
        | _age_views()
        | _kind_views()
        | _host_views()
        | _load_and_warehouse()
        | _audits()
        | _stores()
    )
