"""One Spark query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievemart import functions as fx
from sievemart.operators import bitmaps, dedup, grouping, joins, ordering, projection, ranking, split
from sievemart.operators.replicate import replicate_rows
from sievemart.plans import code_index, feeds, job, model, reports, scaling, stage
from sievemart.session import cut_lineage, ensure_checkpoint_dir
from sievemart.sources import catalog, files, publish
from checks.postings import order_postings, postings, read_table

Query = Callable[[SparkSession, str], DataFrame]

# Roubles per unit, a parameter of the mart; 'NA' and NULL have no rate.
RATES = {"RUR": 1.0, "USD": 90.5}

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return reports.clean_leniently(postings(spark, sf))


def with_mid(spark: SparkSession, sf: str) -> DataFrame:
    return projection.with_midpoint(postings(spark, sf))


def stored_mid(spark: SparkSession, sf: str) -> DataFrame:
    """Profile input written once: the rollups scan it several times, and without
    this every scan would join and parse the whole postings again."""
    return cut_lineage(
        with_mid(spark, sf).select("id", "area_name", "salary_mid", "test_required")
    )


def customer_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as postings: small groups, some of fewer than 30 with a salary."""
    customer, nation = read_table(spark, sf, "customer"), read_table(spark, sf, "nation")
    balance = (F.floor(F.col("c_acctbal") * 4) / 4).cast("decimal(18,2)").cast("string")
    no_salary = (F.col("c_custkey") % 7).isin(0, 3, 5)
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("area_name"),
        F.when(no_salary, "n/a").otherwise(balance).alias("salary_from"),
    )


# Projections


@query
def keep_columns(spark, sf):
    return projection.keep_available(postings(spark, sf), [*stage.STAGE_COLUMNS, "no_such_column"])


@query
def default_columns(spark, sf):
    df = order_postings(spark, sf).select("posting_no", "premium")
    return projection.with_defaults(
        df,
        {
            "premium": F.lit("unused"),
            "address_lat": F.lit(0.0),
            "test_flag": F.lit(0),
            "vac_distinct": F.lit(None).cast("bigint"),
        },
    )


@query
def alias_columns(spark, sf):
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("city"),
        F.col("c_mktsegment").alias("label"),
    )


@query
def derive_drop(spark, sf):
    df = order_postings(spark, sf).select("posting_no", "salary_from", "salary_to")
    return df.withColumns(
        {"has_from": F.col("salary_from").isNotNull(), "both": F.concat("salary_from", "salary_to")}
    ).drop("salary_from", "salary_to")


@query
def cast_forms(spark, sf):
    text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return read_table(spark, sf, "orders").select(
        "o_orderkey",
        text.alias("as_text"),
        text.try_cast("double").alias("as_double"),
        F.floor("o_totalprice").cast("int").alias("as_int"),
        F.floor("o_totalprice").cast("long").alias("as_long"),
        F.col("o_orderpriority").try_cast("double").alias("not_a_number"),
    )


@query
def ratio_share(spark, sf):
    per_order = (
        read_table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        )
    )
    return projection.with_ratio(per_order, "returned", "open_lines", "share")


# Cleaning expressions, row by row


@query
def strict_number(spark, sf):
    df = order_postings(spark, sf)
    return df.select(
        "posting_no",
        *[fx.strict_number(df, c).alias(c) for c in stage.NUMBERS],
    )


@query
def lenient_number(spark, sf):
    df = order_postings(spark, sf)
    return df.select(
        "posting_no",
        *[fx.lenient_number(df, c).alias(c) for c in stage.NUMBERS],
    )


@query
def lenient_number_of_numeric(spark, sf):
    df = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 1000).alias("amount")
    )
    return df.groupBy("l_orderkey").agg(
        F.max(fx.lenient_number(df, "amount")).alias("amount"),
        F.max(fx.strict_number(df, "l_linenumber")).alias("line"),
    )


@query
def true_flag(spark, sf):
    return order_postings(spark, sf).select(
        "posting_no", *[fx.true_flag(c).alias(c) for c in stage.FLAGS]
    )


@query
def multi_flag(spark, sf):
    df = order_postings(spark, sf)
    second = df.drop("test_required")
    return df.select(
        "posting_no",
        fx.any_flag(df).alias("first_source"),
        fx.any_flag(second).alias("second_source"),
        fx.any_flag(df.select("posting_no")).alias("no_source"),
    )


@query
def gross_flag(spark, sf):
    return order_postings(spark, sf).select(
        "posting_no", fx.gross_flag("salary_gross").alias("salary_gross_bin")
    )


@query
def guarded_id(spark, sf):
    df = postings(spark, sf)
    return df.select("posting_no", fx.guarded_id(df, "area_id").alias("area_id_num"))


@query
def fill_zero(spark, sf):
    df = cleaned(spark, sf)
    return df.select("posting_no", *[fx.zero_if_null(F.col(c)).alias(c) for c in model.AMOUNTS])


@query
def norm_code(spark, sf):
    return order_postings(spark, sf).select(
        "posting_no", fx.norm_code("salary_currency").alias("salary_currency_norm")
    )


@query
def salary_mid(spark, sf):
    df = order_postings(spark, sf)
    both = projection.with_midpoint(df)
    one = projection.with_midpoint(both, high="no_such_column", name="only_from")
    return one.select("posting_no", "salary_mid", "only_from")


@query
def tri_flag(spark, sf):
    df = order_postings(spark, sf)
    return df.select(
        "posting_no",
        *[fx.three_state_flag(df, c).alias(c) for c in ("test_required", "has_test", "premium")],
    )


@query
def label_case(spark, sf):
    label = fx.two_way_label("test_required", catalog.WITH_TEST, catalog.WITHOUT_TEST)
    return order_postings(spark, sf).select("posting_no", label.alias("test_flag"))


@query
def coerce_number(spark, sf):
    df = order_postings(spark, sf)
    return df.select(
        "posting_no",
        fx.coerce_number(df, "salary_from").alias("salary_from"),
        fx.coerce_number(df, "salary_to").alias("salary_to"),
    )


# Filters


@query
def filter_not_null(spark, sf):
    return with_mid(spark, sf).filter(F.col("salary_mid").isNotNull()).select(
        "posting_no", "salary_mid"
    )


@query
def dropna_subset(spark, sf):
    df = cleaned(spark, sf).select("posting_no", "area_name", "salary_from", "address_lat")
    return df.dropna(subset=["area_name", "salary_from"])


@query
def predicate_forms(spark, sf):
    return (
        read_table(spark, sf, "orders")
        .filter(
            (F.col("o_totalprice") >= 1000)
            & (F.col("o_custkey") > 0)
            & F.col("o_orderdate").isNotNull()
            & F.col("o_orderstatus").isin("O", "F")
            & F.col("o_orderpriority").rlike("^[12]-")
            & ~(F.col("o_orderstatus") == "P")
        )
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
    )


# De-duplication


@query
def dedup_by_key(spark, sf):
    lines = read_table(spark, sf, "lineitem").withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return dedup.first_by_key(lines, "l_orderkey")


@query
def dedup_null_keys(spark, sf):
    return dedup.first_by_key(
        order_postings(spark, sf).select("posting_no", "id", "salary_from"), "id"
    )


@query
def drop_duplicates_any(spark, sf):
    return dedup.any_by_key(read_table(spark, sf, "lineitem"), "l_orderkey").select("l_orderkey")


# Rollups


@query
def row_count(spark, sf):
    return read_table(spark, sf, "lineitem").agg(F.count("*").alias("rows"))


@query
def group_count(spark, sf):
    return grouping.group_count(postings(spark, sf), "area_name", "vacancies")


@query
def top_groups(spark, sf):
    return reports.top_areas(postings(spark, sf))


@query
def salary_by_group(spark, sf):
    df = reports.clean_leniently(customer_postings(spark, sf))
    return reports.salary_by_area(df)


@query
def having_rows(spark, sf):
    df = reports.clean_leniently(customer_postings(spark, sf))
    means = grouping.group_mean(df, "area_name", "salary_from", "with_salary", "avg_salary_from")
    return grouping.having_at_least(means, "with_salary", 30)


@query
def global_share(spark, sf):
    df = order_postings(spark, sf)
    return reports.test_share(df.withColumn("test_flag", fx.any_flag(df)))


@query
def avg_median(spark, sf):
    """The mean, and whether the sketch's median lies within its rank bound."""
    df = stored_mid(spark, sf)
    found = cut_lineage(grouping.group_mean_median(df, "area_name", "salary_mid"))
    medians = found.select(F.col("area_name").alias("_area"), "avg_salary", "median_salary")
    rows, middle = F.count("salary_mid"), F.max("median_salary")
    slack = rows / grouping.MEDIAN_ACCURACY + 1
    below = F.count_if(F.col("salary_mid") < F.col("median_salary"))
    upto = F.count_if(F.col("salary_mid") <= F.col("median_salary"))
    bound = middle.isNotNull() & (below <= rows / 2 + slack) & (upto >= rows / 2 - slack)
    return (
        df.join(medians, F.col("area_name").eqNullSafe(F.col("_area")))
        .groupBy("area_name")
        .agg(F.max("avg_salary").alias("avg_salary"), bound.alias("median_in_bound"))
    )


@query
def median_exact(spark, sf):
    return grouping.exact_percentile(
        stored_mid(spark, sf), "area_name", "salary_mid", 0.5, "median_salary"
    )


@query
def median_exact_many_groups(spark, sf):
    return grouping.exact_percentile(
        read_table(spark, sf, "lineitem"), "l_partkey", "l_extendedprice", 0.5, "median_price"
    )


@query
def count_distinct(spark, sf):
    return grouping.group_distinct(postings(spark, sf), "area_name", "id")


@query
def distinct_bitmaps(spark, sf):
    """Distinct ids per area, from the bitmaps of two halves of the rows joined."""
    rows = cut_lineage(postings(spark, sf).select("posting_no", "id", "area_name"))
    numbered = rows.join(bitmaps.number_items(rows, "id"), "id", "left")
    halves = [numbered.filter(F.col("posting_no") % 2 == k) for k in (0, 1)]
    merged = bitmaps.merge_bitmaps(*[bitmaps.item_bitmaps(h, "area_name") for h in halves])
    return bitmaps.count_bitmaps(merged, "area_name", "vac_distinct")


@query
def group_share(spark, sf):
    return grouping.group_share(postings(spark, sf), "area_name", "test_required")


@query
def group_by_case(spark, sf):
    label = fx.two_way_label("test_required", catalog.WITH_TEST, catalog.WITHOUT_TEST)
    return grouping.count_by_expression(order_postings(spark, sf), label, "test_flag", "cnt")


@query
def const_per_group(spark, sf):
    return grouping.group_constant(
        postings(spark, sf), "area_name", F.lit(None).cast("double"), "test_share"
    )


@query
def salary_mart(spark, sf):
    return reports.salary_mart(postings(spark, sf))


@query
def salary_mart_rates(spark, sf):
    return reports.salary_mart(postings(spark, sf), RATES)


# Joins


@query
def join_inner(spark, sf):
    df = stored_mid(spark, sf)
    return joins.join_inner(
        grouping.group_mean(df, "area_name", "salary_mid", "n", "avg_salary"),
        grouping.group_distinct(df, "area_name", "id"),
        "area_name",
    )


@query
def join_left(spark, sf):
    counts = grouping.group_count(customer_postings(spark, sf), "area_name", "vacancies")
    return joins.join_left(counts, having_rows(spark, sf), "area_name")


# Sorting and limits


@query
def sorted_counts(spark, sf):
    counts = grouping.group_count(postings(spark, sf), "area_name", "vac_count")
    return counts.orderBy(F.desc("vac_count"), "area_name")


@query
def limit_rows(spark, sf):
    capped = read_table(spark, sf, "lineitem").limit(20_000)
    return capped.agg(F.count("*").alias("kept"))


@query
def largest_asc(spark, sf):
    counts = grouping.group_count(postings(spark, sf), "area_name", "vacancies")
    return ordering.largest_ascending(counts, 20, "vacancies", "area_name")


@query
def running_total(spark, sf):
    return ordering.running_totals(
        read_table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        [F.asc("o_custkey"), F.asc("o_orderkey")],
        {"keys_upto": "o_orderkey"},
    )


# Row generation


@query
def replicate_rows_4(spark, sf):
    return replicate_rows(read_table(spark, sf, "orders"), 4).select("o_orderkey", "o_totalprice")


@query
def replicate_rows_1(spark, sf):
    return replicate_rows(read_table(spark, sf, "orders"), 1).select("o_orderkey", "o_totalprice")


@query
def scaling_rows(spark, sf):
    return scaling.volume_shapes(
        cut_lineage(postings(spark, sf).select("area_name", "salary_from", "salary_to"))
    )


@query
def profile_sweep(spark, sf):
    return scaling.profile_sweep(stored_mid(spark, sf))


# Composite jobs


@query
def group_profile(spark, sf):
    return grouping.group_profile(stored_mid(spark, sf))


@query
def group_profile_exact(spark, sf):
    return grouping.group_profile(stored_mid(spark, sf), exact_median=True)


@query
def group_profile_scaled(spark, sf):
    scaled = replicate_rows(stored_mid(spark, sf), 4)
    return grouping.group_profile(scaled, exact_median=True)


@query
def group_profile_bare(spark, sf):
    bare = stored_mid(spark, sf).select("area_name", "salary_mid")
    return grouping.group_profile(bare, exact_median=True)


@query
def stage_rows(spark, sf):
    return stage.stage_rows(postings(spark, sf))


def _reports(spark, sf):
    staged = stage.stage_rows(postings(spark, sf))
    return reports.reports_of_rollup(reports.area_rollup(reports.clean_leniently(staged)))


@query
def report_top_cities(spark, sf):
    return _reports(spark, sf)["top_cities"]


@query
def report_salary_by_city(spark, sf):
    return _reports(spark, sf)["salary_by_city"]


@query
def report_test_share(spark, sf):
    return _reports(spark, sf)["test_share"]


@query
def job_outputs(spark, sf):
    """The whole job over all postings as CSV, and each of its results read back."""
    base = f"{ensure_checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
    raw, out = f"{base}/raw", f"{base}/out"
    files.write_csv(postings(spark, sf), raw)
    job.run_job(spark, raw, out, multipliers=(1, 2), repeats=1)

    def rows(report: str, df: DataFrame, key: str, n: str, value: str = "NULL") -> DataFrame:
        shown = [f"CAST({key} AS STRING) AS k", f"CAST({n} AS LONG) AS n", f"CAST({value} AS DOUBLE) AS value"]
        return df.select(F.lit(report).alias("report"), *map(F.expr, shown))

    def report(name: str) -> DataFrame:
        return files.read_report(spark, f"{out}/reports/{name}")

    staged = files.read_stage(spark, f"{out}/stage").agg(F.count("*").alias("n"), F.sum("salary_from").alias("total"))
    return (
        rows("stage", staged, "NULL", "n", "total")
        .union(rows("top_cities", report("top_cities"), "area_name", "vacancies"))
        .union(rows("salary_by_city", report("salary_by_city"), "area_name", "with_salary", "avg_salary_from"))
        .union(rows("test_share", report("test_share"), "NULL", "total", "share"))
        .union(rows("scalability_results", report("scalability_results"), "multiplier", "rows"))
        .union(rows("ml_results", spark.read.json(f"{out}/reports/ml_results"), "task", "1"))
        .union(rows("manifest", publish.Publisher(spark, out).manifest(), "step", "1"))
    )


# SQL over catalog names


def _register(spark, sf):
    raw = postings(spark, sf)
    catalog.register(
        spark,
        {
            catalog.RAW: raw,
            catalog.CLEAN: stage.stage_rows(raw),
            catalog.MART: reports.salary_mart(raw, RATES),
        },
    )


@query
def sql_table_scan(spark, sf):
    _register(spark, sf)
    return catalog.read_catalog(spark, catalog.MART)


@query
def sql_top_areas(spark, sf):
    _register(spark, sf)
    return catalog.top_areas(spark)


@query
def sql_top_cities(spark, sf):
    _register(spark, sf)
    return catalog.top_cities(spark)


@query
def sql_salary_mart(spark, sf):
    _register(spark, sf)
    return catalog.mart_rows(spark)


@query
def sql_city_salary(spark, sf):
    _register(spark, sf)
    return catalog.city_salaries(spark)


@query
def sql_test_share(spark, sf):
    _register(spark, sf)
    return catalog.flag_counts(spark)


@query
def sql_bound_values(spark, sf):
    catalog.register(spark, {"orders": read_table(spark, sf, "orders")})
    return catalog.run_sql(
        spark,
        "SELECT o_orderstatus, count(*) AS n FROM orders"
        " WHERE o_totalprice > :least AND o_orderpriority <> :urgency GROUP BY o_orderstatus",
        {"least": 100_000, "urgency": "1-URGENT"},
    )


@query
def sql_saved_tables(spark, sf):
    """A join of two saved tables, planned by the statistics in the catalog."""
    database = f"checked_{uuid.uuid4().hex}"
    raw = postings(spark, sf)
    job.publish_tables(raw, stage.stage_rows(raw), database, RATES)
    return catalog.run_sql(
        spark,
        f"SELECT c.area_name, count(*) AS vacancies, max(vacancies_with_salary) AS with_salary, max(avg_rub) AS avg_rub"
        f" FROM {catalog.CLEAN} c LEFT JOIN {catalog.MART} m ON c.area_name = m.area_name GROUP BY c.area_name",
        database=database,
    )


# Orders as CSV lines; of 25 one has too few fields, one too many, one a number that is none.
DAMAGED_AMOUNT = "CAST(CAST(floor(o_totalprice * 4) / 4 AS DECIMAL(18,2)) AS STRING)"
DAMAGED_LINE = f"""
  CASE o_orderkey % 25 WHEN 7 THEN CAST(o_orderkey AS STRING)
    WHEN 8 THEN CAST(o_orderkey AS STRING) || ',' || o_orderstatus || ',' || {DAMAGED_AMOUNT} || ',more'
    WHEN 9 THEN 'x' || CAST(o_orderkey AS STRING) || ',' || o_orderstatus || ',' || {DAMAGED_AMOUNT}
    ELSE CAST(o_orderkey AS STRING) || ',' || o_orderstatus || ',' || {DAMAGED_AMOUNT} END"""


@query
def csv_quarantine(spark, sf):
    """Typed records of a damaged CSV, and those that do not fit, as they stand in it."""
    folder = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    read_table(spark, sf, "orders").select(F.expr(DAMAGED_LINE).alias("value")).write.text(folder)
    typed = StructType.fromDDL("o_orderkey long, status string, amount double")
    good, bad = files.split_bad_records(spark, folder, typed, multi_line=False, header=False)
    return good.unionByName(bad.select("record"), allowMissingColumns=True)


@query
def csv_round_trip(spark, sf):
    """All postings written as CSV to the shared folder and read back as text."""
    folder = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(postings(spark, sf), folder)
    return files.read_csv(spark, folder, keep_empty=True)


# Chart feeds


@query
def feed_top(spark, sf):
    return feeds.top_city_feed(sql_top_cities(spark, sf))


@query
def feed_salary(spark, sf):
    return feeds.salary_feed(sql_city_salary(spark, sf))


@query
def feed_flag(spark, sf):
    return feeds.flag_feed(sql_test_share(spark, sf))


@query
def feed_mixed_case(spark, sf):
    counts = grouping.group_count(postings(spark, sf), "area_name", "Vacancies")
    return feeds.top_city_feed(counts.select("Vacancies", F.col("area_name").alias("City")))


@query
def run_summary(spark, sf):
    """The summary of timed runs, with order lines in the place of runs."""
    return scaling.summarise_runs(
        read_table(spark, sf, "lineitem").select(
            F.col("l_linenumber").alias("multiplier"),
            F.col("l_orderkey").alias("rows"),
            F.col("l_quantity").alias("seconds"),
        )
    )


@query
def scaling_curve(spark, sf):
    return feeds.scaling_feed(run_summary(spark, sf))


# Model


@query
def category_index(spark, sf):
    df = order_postings(spark, sf)
    return ranking.category_index(
        df.select(fx.norm_code("salary_currency").alias("salary_currency_norm")),
        "salary_currency_norm",
    )


@query
def category_index_many(spark, sf):
    return ranking.category_index(read_table(spark, sf, "lineitem"), "l_partkey")


@query
def split_rows(spark, sf):
    rows = order_postings(spark, sf).select("posting_no", "id")
    train, test = split.split_rows(rows, ["id"], instead=["posting_no"])
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def ml_features(spark, sf):
    return model.labelled_features(cleaned(spark, sf), "posting_no")


@query
def onehot_features(spark, sf):
    """The fitted code index, and its one-hot vector as text."""
    codes = order_postings(spark, sf).select("posting_no", fx.norm_code("salary_currency").alias("code"))
    fitted = code_index.CodeIndexer("code", "code_index").fit(codes)
    places = F.transform(vector_to_array(fitted.one_hot()), lambda x: x.cast("int").cast("string"))
    return fitted.transform(codes).select("posting_no", "code_index", F.array_join(places, "").alias("onehot"))


@query
def fit_gradient(spark, sf):
    """How many coefficients the fit has, and whether all gradients of its loss are small."""
    inputs = ["id", "test_flag", *model.AMOUNTS, "salary_gross", "area_id", "salary_currency"]
    train, _ = model.split_data(
        model.labelled_features(cut_lineage(cleaned(spark, sf).select(inputs)), "id")
    )
    fitted = model.classifier().fit(train)
    return model.loss_gradient(fitted, train).agg(
        F.count("*").alias("coefficients"), (F.max(F.abs("gradient")) < 1e-3).alias("settled")
    )


@query
def rank_auc(spark, sf):
    scored = read_table(spark, sf, "labels").join(read_table(spark, sf, "documents"), "doc_id")
    return ranking.rank_auc(scored, "quality", "n_chars")


@query
def rank_auc_ties(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), "l_quantity"
    )
    return ranking.rank_auc(lines, "label", "l_quantity")


def _scored(spark, sf):
    # Fitting passes over its input several times: parse the texts once.
    inputs = ["id", "test_flag", *model.AMOUNTS, "salary_gross", "area_id", "salary_currency"]
    _, scored = model.fit_and_score(cut_lineage(cleaned(spark, sf).select(inputs)))
    return scored


@query
def logreg_scored_rows(spark, sf):
    """Which rows with an id are scored, and their labels."""
    return _scored(spark, sf).filter(F.col("id").isNotNull()).select("id", "label")


@query
def logreg_predictions(spark, sf):
    scored = _scored(spark, sf)
    return scored.select("id", "label", F.round("score", 6).alias("score"), "prediction")
