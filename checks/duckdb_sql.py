"""The SQL each Spark query must agree with, for DuckDB over the same tables."""

from __future__ import annotations

from checks.spark_queries import DAMAGED_AMOUNT, DAMAGED_LINE, RATES
from sievemart.sources.catalog import WITH_TEST, WITHOUT_TEST
from checks.postings import ORDER_POSTINGS_SQL, POSTINGS_SQL

_TABLES = {"orders": "orders", "customer": "customer", "nation": "nation"}
ORDER_POSTINGS = f"op AS ({ORDER_POSTINGS_SQL.format(**_TABLES)})"
POSTINGS = f"p AS ({POSTINGS_SQL.format(**_TABLES)})"
CUSTOMER_POSTINGS = """c AS (
  SELECT n_name AS area_name,
         CASE WHEN c_custkey % 7 NOT IN (0, 3, 5) THEN floor(c_acctbal * 4) / 4 END AS salary_from
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _bare(column: str) -> str:
    return f"replace(regexp_replace({column}, '[^0-9,.\\-]', '', 'g'), ',', '.')"


def strict(column: str) -> str:
    text = _bare(column)
    return (
        f"CASE WHEN regexp_full_match({text}, '-?\\d+(\\.\\d+)?') THEN TRY_CAST({text} AS DOUBLE) END"
    )


def lenient(column: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({_bare(column)}, '(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE)"


def mid(low: str = "salary_from", high: str = "salary_to") -> str:
    lo, hi = lenient(low), lenient(high)
    return (
        f"CASE WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL THEN ({lo} + {hi}) / 2.0"
        f" WHEN {lo} IS NOT NULL THEN {lo} ELSE {hi} END"
    )


def true_word(column: str) -> str:
    return f"CASE WHEN lower({column}) = 'true' THEN 1 ELSE 0 END"


def many_words(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '\\s*\\d+\\s*')"
        f" THEN CASE WHEN CAST(trim({column}) AS HUGEINT) <> 0 THEN 1 ELSE 0 END"
        f" WHEN lower(trim({column})) IN ('true', 'yes', 'да', 'y', '1') THEN 1 ELSE 0 END"
    )


def three_states(column: str) -> str:
    return (
        f"CASE WHEN {column} IN ('1', 'true', 'True', 'TRUE') THEN 1.0::DOUBLE"
        f" WHEN {column} IN ('0', 'false', 'False', 'FALSE') THEN 0.0::DOUBLE END"
    )


def code(column: str) -> str:
    return f"CASE WHEN upper(trim({column})) = '' THEN 'NA' ELSE upper(trim({column})) END"


def label(column: str) -> str:
    return f"CASE WHEN lower({column}) = 'true' THEN '{WITH_TEST}' ELSE '{WITHOUT_TEST}' END"


def guarded(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '\\s*\\d+\\s*') THEN CAST({column} AS DOUBLE) ELSE 0.0::DOUBLE END"


GROSS = "CASE WHEN lower(trim(salary_gross)) IN ('true', '1', 'yes', 'да') THEN 1 ELSE 0 END"
MID_ROWS = f"{POSTINGS}, d AS (SELECT *, {mid()} AS salary_mid FROM p)"

_STAGE_TEXT = (
    "id, area_name, name, salary_from, salary_to, salary_currency, experience, employment,"
    " schedule, has_test, premium, archived, count_key_skills, published_at,"
    " test_required, salary_gross, area_id, address_lat"
)
STAGED = f"""{POSTINGS}, cleaned AS (
  SELECT id, area_name, name, {strict('salary_from')} AS salary_from,
    {strict('salary_to')} AS salary_to, salary_currency, experience, employment, schedule,
    {true_word('has_test')} AS has_test, {true_word('premium')} AS premium,
    {true_word('archived')} AS archived, {strict('count_key_skills')} AS count_key_skills,
    published_at, test_required, salary_gross, area_id, address_lat
  FROM p),
s AS (
  SELECT {_STAGE_TEXT} FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY
      {', '.join(f'{c.strip()} ASC NULLS FIRST' for c in _STAGE_TEXT.split(',')[1:])}) AS rn
    FROM cleaned)
  WHERE rn = 1)"""

_RATE = " ".join(f"WHEN '{c}' THEN {r}" for c, r in RATES.items())


def mart(amount: str) -> str:
    return f"""{MID_ROWS}, m AS (
  SELECT area_name, count(*) AS vacancies_with_salary, count({amount}) AS converted,
    avg({amount}) AS avg_rub
  FROM d WHERE salary_mid IS NOT NULL GROUP BY area_name)"""


ROUBLE_MART = mart(f"CASE WHEN {code('salary_currency')} = 'RUR' THEN salary_mid END")
RATED_MART = mart(f"salary_mid * CASE {code('salary_currency')} {_RATE} END")

_DISTINCT = "count(*) AS vac_count, count(DISTINCT id) AS vac_distinct"


def profile(rows: str, distinct: str = "count(DISTINCT id)", share: str | None = None) -> str:
    share = share or f"avg({three_states('test_required')})"
    return f"""
  SELECT area_name, avg(salary_mid) AS avg_salary,
    quantile_disc(salary_mid, 0.5) AS median_salary, count(*) AS vac_count,
    {distinct} AS vac_distinct, {share} AS test_share
  FROM {rows} WHERE salary_mid IS NOT NULL AND area_name IS NOT NULL
  GROUP BY area_name ORDER BY vac_count DESC, area_name"""


_HAVING = f"""
  SELECT area_name, count(*) AS with_salary, avg(salary_from) AS avg_salary_from
  FROM c WHERE salary_from IS NOT NULL GROUP BY area_name HAVING count(*) >= 30"""

_CITY_COUNT = """
  SELECT area_name AS city, count(*) AS vacancies FROM s
  GROUP BY area_name ORDER BY vacancies DESC, city NULLS FIRST LIMIT 30"""

_CITY_SALARY = """
  SELECT area_name AS city, vacancies_with_salary, avg_rub FROM m WHERE avg_rub IS NOT NULL
  ORDER BY vacancies_with_salary DESC, city NULLS FIRST LIMIT 30"""

_LINES_BY_PRICE = """
  SELECT o_orderkey, o_totalprice FROM orders"""


_RUN_SUMMARY = """(
  SELECT l_linenumber AS multiplier, max(l_orderkey) AS rows, min(l_quantity) AS min_time_s,
    max(l_quantity) AS max_time_s, avg(l_quantity) AS avg_time_s
  FROM lineitem GROUP BY l_linenumber)"""


def auc(rows: str, label_column: str, score: str) -> str:
    """Rank-sum form: mean ranks of the positives against all."""
    return f"""
  WITH r AS (
    SELECT {label_column} AS y,
      rank() OVER (ORDER BY {score})
        + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS midrank
    FROM {rows})
  SELECT (sum(midrank) FILTER (WHERE y = 1) - sum(y)::DOUBLE * (sum(y) + 1) / 2)
      / (sum(y)::DOUBLE * (count(*) - sum(y))) AS auc
  FROM r"""


def category(rows: str, column: str) -> str:
    return f"""
  SELECT {column}, count(*) AS rows,
    CAST(row_number() OVER (ORDER BY {column} IS NULL, count(*) DESC, {column}) - 1 AS DOUBLE) AS idx
  FROM {rows} GROUP BY {column}"""


def all_sql() -> dict[str, str]:
    op, p, c = f"WITH {ORDER_POSTINGS}", f"WITH {POSTINGS}", f"WITH {CUSTOMER_POSTINGS}"
    d, s = f"WITH {MID_ROWS}", f"WITH {STAGED}"
    sql = {
        "keep_columns": f"{p} SELECT {_STAGE_TEXT} FROM p",
        "default_columns": f"{op} SELECT posting_no, premium, 0.0::DOUBLE AS address_lat,"
        " 0 AS test_flag, NULL::BIGINT AS vac_distinct FROM op",
        "alias_columns": "SELECT c_custkey AS id, c_name AS city, c_mktsegment AS label FROM customer",
        "derive_drop": f"{op} SELECT posting_no, salary_from IS NOT NULL AS has_from,"
        " salary_from || salary_to AS \"both\" FROM op",
        "cast_forms": "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS as_text,"
        " o_totalprice AS as_double, CAST(floor(o_totalprice) AS INTEGER) AS as_int,"
        " CAST(floor(o_totalprice) AS BIGINT) AS as_long,"
        " TRY_CAST(o_orderpriority AS DOUBLE) AS not_a_number FROM orders",
        "ratio_share": "SELECT l_orderkey, returned, open_lines,"
        " CASE WHEN open_lines <> 0 THEN returned::DOUBLE / open_lines END AS share FROM ("
        " SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,"
        " count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines FROM lineitem GROUP BY l_orderkey)",
        "strict_number": f"{op} SELECT posting_no, {strict('salary_from')} AS salary_from,"
        f" {strict('salary_to')} AS salary_to, {strict('count_key_skills')} AS count_key_skills FROM op",
        "lenient_number": f"{op} SELECT posting_no, {lenient('salary_from')} AS salary_from,"
        f" {lenient('salary_to')} AS salary_to, {lenient('count_key_skills')} AS count_key_skills FROM op",
        "lenient_number_of_numeric": "SELECT l_orderkey, max(l_extendedprice * 1000) AS amount,"
        " max(l_linenumber)::DOUBLE AS line FROM lineitem GROUP BY l_orderkey",
        "true_flag": f"{op} SELECT posting_no, {true_word('has_test')} AS has_test,"
        f" {true_word('premium')} AS premium, {true_word('archived')} AS archived FROM op",
        "multi_flag": f"{op} SELECT posting_no, {many_words('test_required')} AS first_source,"
        f" {many_words('has_test')} AS second_source, 0 AS no_source FROM op",
        "gross_flag": f"{op} SELECT posting_no, {GROSS} AS salary_gross_bin FROM op",
        "guarded_id": f"{p} SELECT posting_no, {guarded('area_id')} AS area_id_num FROM p",
        "fill_zero": f"{p} SELECT posting_no, coalesce({lenient('salary_from')}, 0.0) AS salary_from,"
        f" coalesce({lenient('salary_to')}, 0.0) AS salary_to,"
        f" coalesce({lenient('address_lat')}, 0.0) AS address_lat FROM p",
        "norm_code": f"{op} SELECT posting_no, {code('salary_currency')} AS salary_currency_norm FROM op",
        "salary_mid": f"{op} SELECT posting_no, {mid()} AS salary_mid,"
        f" {lenient('salary_from')} AS only_from FROM op",
        "tri_flag": f"{op} SELECT posting_no, {three_states('test_required')} AS test_required,"
        f" {three_states('has_test')} AS has_test, {three_states('premium')} AS premium FROM op",
        "label_case": f"{op} SELECT posting_no, {label('test_required')} AS test_flag FROM op",
        "coerce_number": f"{op} SELECT posting_no, TRY_CAST(salary_from AS DOUBLE) AS salary_from,"
        " TRY_CAST(salary_to AS DOUBLE) AS salary_to FROM op",
        "filter_not_null": f"{d} SELECT posting_no, salary_mid FROM d WHERE salary_mid IS NOT NULL",
        "dropna_subset": f"{p} SELECT posting_no, area_name, {lenient('salary_from')} AS salary_from,"
        f" {lenient('address_lat')} AS address_lat FROM p"
        f" WHERE area_name IS NOT NULL AND {lenient('salary_from')} IS NOT NULL",
        "predicate_forms": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"
        " WHERE o_totalprice >= 1000 AND o_custkey > 0 AND o_orderdate IS NOT NULL"
        " AND o_orderstatus IN ('O', 'F') AND regexp_matches(o_orderpriority, '^[12]-')"
        " AND NOT o_orderstatus = 'P'",
        "dedup_by_key": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey"
        " ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,"
        " l_returnflag, l_linestatus, l_shipdate) AS rn FROM (SELECT * REPLACE"
        " (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem)) WHERE rn = 1",
        "dedup_null_keys": f"{op} SELECT posting_no, id, salary_from FROM (SELECT *, row_number() OVER"
        " (PARTITION BY id ORDER BY posting_no, salary_from NULLS FIRST) AS rn FROM op) WHERE rn = 1",
        "drop_duplicates_any": "SELECT DISTINCT l_orderkey FROM lineitem",
        "row_count": "SELECT count(*) AS rows FROM lineitem",
        "group_count": f"{p} SELECT area_name, count(*) AS vacancies FROM p GROUP BY area_name",
        "top_groups": f"{p} SELECT area_name, count(*) AS vacancies FROM p GROUP BY area_name"
        " ORDER BY vacancies DESC, area_name NULLS FIRST LIMIT 20",
        "salary_by_group": f"{c} {_HAVING} ORDER BY avg(salary_from) DESC, area_name NULLS FIRST LIMIT 30",
        "having_rows": f"{c} {_HAVING}",
        "global_share": f"{op} SELECT count(*) AS total, sum(f)::BIGINT AS with_test,"
        f" sum(f)::DOUBLE / count(*) AS share FROM (SELECT {many_words('test_required')} AS f FROM op)",
        "avg_median": f"{d} SELECT area_name, avg(salary_mid) AS avg_salary,"
        " count(salary_mid) > 0 AS median_in_bound FROM d GROUP BY area_name",
        "median_exact": f"{d} SELECT area_name, quantile_disc(salary_mid, 0.5) AS median_salary"
        " FROM d WHERE salary_mid IS NOT NULL GROUP BY area_name",
        "median_exact_many_groups": "SELECT l_partkey, quantile_disc(l_extendedprice, 0.5) AS median_price"
        " FROM lineitem GROUP BY l_partkey",
        "count_distinct": f"{p} SELECT area_name, {_DISTINCT} FROM p GROUP BY area_name",
        "group_share": f"{p} SELECT area_name, avg({three_states('test_required')}) AS test_share"
        " FROM p GROUP BY area_name",
        "group_by_case": f"{op} SELECT {label('test_required')} AS test_flag, count(*) AS cnt FROM op GROUP BY 1",
        "const_per_group": f"{p} SELECT area_name, NULL::DOUBLE AS test_share FROM p GROUP BY area_name",
        "salary_mart": f"WITH {ROUBLE_MART} SELECT * FROM m",
        "salary_mart_rates": f"WITH {RATED_MART} SELECT * FROM m",
        "join_inner": f"{d}, a AS (SELECT area_name, count(*) AS n, avg(salary_mid) AS avg_salary"
        f" FROM d WHERE salary_mid IS NOT NULL GROUP BY area_name), b AS (SELECT area_name, {_DISTINCT}"
        " FROM d GROUP BY area_name) SELECT * FROM a JOIN b USING (area_name)",
        "join_left": f"{c}, a AS (SELECT area_name, count(*) AS vacancies FROM c GROUP BY area_name),"
        f" b AS ({_HAVING}) SELECT * FROM a LEFT JOIN b USING (area_name)",
        "sorted_counts": f"{p} SELECT area_name, count(*) AS vac_count FROM p GROUP BY area_name"
        " ORDER BY vac_count DESC, area_name NULLS FIRST",
        "limit_rows": "SELECT least(count(*), 20000) AS kept FROM lineitem",
        "largest_asc": f"{p} SELECT * FROM (SELECT area_name, count(*) AS vacancies FROM p GROUP BY area_name"
        " ORDER BY vacancies DESC, area_name NULLS FIRST LIMIT 20) ORDER BY vacancies, area_name DESC",
        "running_total": "SELECT o_orderkey, o_custkey, (sum(o_orderkey) OVER (ORDER BY o_custkey, o_orderkey"
        " ROWS UNBOUNDED PRECEDING))::BIGINT AS keys_upto FROM orders",
        "replicate_rows_4": f"{_LINES_BY_PRICE}, range(4)",
        "replicate_rows_1": _LINES_BY_PRICE,
        "scaling_rows": f"{d} SELECT k AS multiplier, (SELECT count(*) FROM d) * k AS rows,"
        " (SELECT count(salary_mid) FROM d WHERE area_name IS NOT NULL) * k AS profiled"
        " FROM unnest([1, 2, 4, 8, 16]) AS t(k)",
        "group_profile": f"{d} {profile('d')}",
        "group_profile_exact": f"{d} {profile('d')}",
        "group_profile_scaled": f"{d} {profile('d, range(4)')}",
        "group_profile_bare": f"{d} {profile('d', 'NULL::BIGINT', 'NULL::DOUBLE')}",
        "profile_sweep": f"{d} "
        + " UNION ALL ".join(f"SELECT *, {m} AS multiplier FROM ({profile(f'd, range({m})')})" for m in (1, 2, 4, 8, 16)),
        "stage_rows": f"{s} SELECT * FROM s",
        "report_top_cities": f"{s} SELECT area_name, count(*) AS vacancies FROM s GROUP BY area_name"
        " ORDER BY vacancies DESC, area_name NULLS FIRST LIMIT 20",
        "report_salary_by_city": f"{s} SELECT area_name, count(*) AS with_salary,"
        " avg(salary_from) AS avg_salary_from FROM s WHERE salary_from IS NOT NULL"
        " GROUP BY area_name HAVING count(*) >= 30 ORDER BY avg(salary_from) DESC, area_name NULLS FIRST LIMIT 30",
        "report_test_share": f"{s} SELECT count(*) AS total, sum(f)::BIGINT AS with_test,"
        f" sum(f)::DOUBLE / count(*) AS share FROM (SELECT {many_words('test_required')} AS f FROM s)",
        "sql_table_scan": f"WITH {RATED_MART} SELECT * FROM m",
        "sql_top_areas": f"{s} SELECT area_name, count(*) AS vacancies FROM s GROUP BY area_name"
        " ORDER BY vacancies DESC, area_name NULLS FIRST LIMIT 20",
        "sql_top_cities": f"{s} {_CITY_COUNT}",
        "sql_salary_mart": f"WITH {RATED_MART} SELECT area_name, vacancies_with_salary, avg_rub FROM m"
        " ORDER BY vacancies_with_salary DESC, area_name NULLS FIRST LIMIT 30",
        "sql_city_salary": f"WITH {RATED_MART} {_CITY_SALARY}",
        "sql_test_share": f"{op} SELECT {label('test_required')} AS test_flag, count(*) AS cnt FROM op GROUP BY 1",
        "sql_bound_values": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000"
        " AND o_orderpriority <> '1-URGENT' GROUP BY o_orderstatus",
        "feed_top": f"{s} SELECT city, vacancies::DOUBLE AS vacancies FROM ({_CITY_COUNT})"
        " ORDER BY vacancies DESC, city NULLS FIRST LIMIT 20",
        "feed_salary": f"WITH {RATED_MART} SELECT city, avg_rub FROM ({_CITY_SALARY})"
        " ORDER BY avg_rub DESC, city NULLS FIRST LIMIT 20",
        "feed_flag": f"{op} SELECT {label('test_required')} AS flag, count(*)::DOUBLE AS cnt FROM op GROUP BY 1",
        "category_index": f"{op}, k AS (SELECT {code('salary_currency')} AS salary_currency_norm FROM op)"
        f" {category('k', 'salary_currency_norm')}",
        "category_index_many": category("lineitem", "l_partkey"),
        "split_rows": f"{op} SELECT posting_no, id, CASE WHEN CAST('0x' || substr(md5('42|' ||"
        " coalesce(id, posting_no::VARCHAR)), 1, 8) AS BIGINT) % 10000 < 8000 THEN 'train' ELSE 'test' END AS part FROM op",
        "ml_features": f"{p} SELECT posting_no, {many_words('test_required')} AS label,"
        f" coalesce({lenient('salary_from')}, 0.0) AS salary_from,"
        f" coalesce({lenient('salary_to')}, 0.0) AS salary_to, {GROSS} AS salary_gross_bin,"
        f" coalesce({lenient('address_lat')}, 0.0) AS address_lat, {guarded('area_id')} AS area_id_num,"
        f" {code('salary_currency')} AS salary_currency_norm FROM p",
        "run_summary": f"SELECT * FROM {_RUN_SUMMARY}",
        "scaling_curve": "SELECT multiplier::DOUBLE AS multiplier_m, avg_time_s AS time"
        f" FROM {_RUN_SUMMARY}",
        "feed_mixed_case": f"{p} SELECT area_name AS city, count(*)::DOUBLE AS vacancies FROM p"
        " GROUP BY area_name ORDER BY vacancies DESC, city NULLS FIRST LIMIT 20",
        "sql_saved_tables": f"SELECT c.area_name, count(*) AS vacancies, max(vacancies_with_salary) AS with_salary,"
        f" max(avg_rub) AS avg_rub FROM ({s} SELECT * FROM s) AS c LEFT JOIN (WITH {RATED_MART} SELECT * FROM m) AS m"
        " ON c.area_name = m.area_name GROUP BY c.area_name",
        "csv_quarantine": "SELECT CASE WHEN fits THEN o_orderkey END AS o_orderkey,"
        " CASE WHEN fits THEN o_orderstatus END AS status,"
        f" CASE WHEN fits THEN CAST({DAMAGED_AMOUNT} AS DOUBLE) END AS amount,"
        f" CASE WHEN NOT fits THEN {DAMAGED_LINE} END AS record"
        " FROM (SELECT *, o_orderkey % 25 NOT IN (7, 8, 9) AS fits FROM orders)",
        "csv_round_trip": f"{p} SELECT * REPLACE (posting_no::VARCHAR AS posting_no) FROM p",
        "logreg_scored_rows": f"{p} SELECT id, {many_words('test_required')} AS label FROM p"
        " WHERE CAST('0x' || substr(md5('42|' || id), 1, 8) AS BIGINT) % 10000 >= 8000",
        "distinct_bitmaps": f"{p} SELECT area_name, count(DISTINCT id) AS vac_distinct FROM p GROUP BY area_name",
        "onehot_features": f"{op}, c AS (SELECT posting_no, {code('salary_currency')} AS code FROM op),"
        " k AS (SELECT code, row_number() OVER (ORDER BY count(*) DESC, code) - 1 AS idx FROM c"
        " WHERE code IS NOT NULL GROUP BY code), n AS (SELECT count(*) AS size FROM k)"
        " SELECT posting_no, coalesce(idx, size)::DOUBLE AS code_index,"
        " repeat('0', coalesce(idx, size)::INT) || '1' || repeat('0', (size - coalesce(idx, size))::INT) AS onehot"
        " FROM c LEFT JOIN k USING (code), n",
        # Five numbers, a place for each code but the last to be left out, and the intercept.
        "fit_gradient": f"{op} SELECT 6 + count(DISTINCT {code('salary_currency')})"
        f" + max(CASE WHEN {code('salary_currency')} IS NULL THEN 1 ELSE 0 END) AS coefficients,"
        " TRUE AS settled FROM op",
        "rank_auc": auc("labels JOIN documents USING (doc_id)", "quality", "n_chars"),
        "rank_auc_ties": auc(
            "lineitem", "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END", "l_quantity"
        ),
    }
    return sql | {"job_outputs": _job_outputs(sql)}


def _job_outputs(sql: dict[str, str]) -> str:
    steps = ("stage", "reports", "reports/ml_results", "reports/scalability_results")
    parts = [
        f"SELECT 'stage' AS report, NULL AS k, count(*) AS n, sum(salary_from) AS value FROM ({sql['stage_rows']})",
        f"SELECT 'top_cities', area_name, vacancies, NULL FROM ({sql['report_top_cities']})",
        f"SELECT 'salary_by_city', area_name, with_salary, avg_salary_from FROM ({sql['report_salary_by_city']})",
        f"SELECT 'test_share', NULL, total, share FROM ({sql['report_test_share']})",
        *[f"SELECT 'scalability_results', '{m}', {m} * count(*), NULL FROM ({sql['stage_rows']})" for m in (1, 2)],
        "SELECT 'ml_results', 'predict test_required (test_flag)', 1, NULL",
        *[f"SELECT 'manifest', '{step}', 1, NULL" for step in steps],
    ]
    return " UNION ALL ".join(parts)
