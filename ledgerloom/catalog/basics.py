"""Single-operator queries over the shared test tables, each with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from .. import operators as O
from .. import plans
from ..learn.select import correlated_groups
from ..sources import free_files, read_csv, read_snapshot, row_cap, sample_rows, scratch_path, write_csv, write_snapshot
from .pipes import status_score_block
from .sqltext import settle
from .standins import CreditTables, load, with_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with its oracle."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE[key] = sql
        return f

    return register


def fl(expr: str) -> str:
    """The oracle's side of ``settle``."""
    return f"CASE WHEN abs({expr}) < 1e-9 THEN 0e0 ELSE CAST(CAST({expr} AS FLOAT) AS DOUBLE) END"


# ---- sources and sinks -------------------------------------------------------

_ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(f"SELECT {', '.join(_ORDER_COLUMNS)} FROM orders")
def scan_csv(spark, d):
    path = scratch_path(spark, "orders-csv")
    write_csv(load(spark, d, "orders").select(*_ORDER_COLUMNS), path)
    return read_csv(spark, path, _ORDER_SCHEMA, key="o_orderkey")


@query("SELECT * FROM (SELECT c_custkey, c_name, c_acctbal FROM customer) ORDER BY c_custkey LIMIT 100")
def scan_row_cap(spark, d):
    return row_cap(load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), 100, ["c_custkey"])


@query(
    "SELECT doc_id, n_chars, quality, CASE WHEN quality IS NULL THEN 'score' ELSE 'train' END AS split "
    "FROM documents LEFT JOIN labels USING (doc_id)"
)
def snapshot_roundtrip(spark, d):
    path = scratch_path(spark, "snapshot")
    labelled = load(spark, d, "documents").select("doc_id", "n_chars").join(load(spark, d, "labels"), "doc_id", "left")
    write_snapshot(labelled.select("doc_id", "n_chars", "quality"), path, label="quality")
    return read_snapshot(spark, path)


@query(f"SELECT o_custkey, count(*) AS n, {fl('sum(o_totalprice)')} AS total FROM orders GROUP BY o_custkey")
def sink_csv(spark, d):
    path = scratch_path(spark, "totals-csv")
    totals = load(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
    )
    write_csv(settle(totals, ["o_custkey", "n"]), path)
    return read_csv(spark, path, "o_custkey bigint, n bigint, total double")


@query("SELECT * FROM customer ORDER BY md5(c_custkey || '|1001'), c_custkey LIMIT 100")
def sample_n(spark, d):
    return sample_rows(load(spark, d, "customer"), 100, ["c_custkey"])


# ---- projections -------------------------------------------------------------


@query(with_tables("application_train") + " SELECT TARGET, SK_ID_CURR FROM application_train")
def proj_drop(spark, d):
    return plans.applicant_label(CreditTables(spark, d)["application_train"])


@query(
    "SELECT c_custkey, c_name AS APP_c_name, c_nationkey AS APP_c_nationkey, c_acctbal AS APP_c_acctbal, "
    "c_mktsegment AS APP_c_mktsegment FROM customer"
)
def proj_prefix(spark, d):
    return O.prefix_columns(load(spark, d, "customer"), "APP_", ["c_custkey"])


@query(
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS o_orderpriority_1URGENT, "
    "CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS o_orderpriority_2HIGH, "
    "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS o_orderpriority_3MEDIUM, "
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS o_orderpriority_4NOTSPECIFIED, "
    "CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS o_orderpriority_5LOW FROM orders"
)
def proj_sanitize(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return O.clean_names(O.one_hot_encoder(orders, ["o_orderpriority"], null_column=False)[0])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def proj_by_type(spark, d):
    lines = load(spark, d, "lineitem")
    return lines.groupBy(*O.columns_by_type(lines, "text")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus, o_orderdate FROM orders")
def proj_by_prefix(spark, d):
    orders = load(spark, d, "orders")
    return orders.select("o_custkey", *O.columns_by_prefix(orders, "o_order"))


@query(
    "SELECT o_custkey, n_orders, n_urgent FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) "
    "LEFT JOIN (SELECT o_custkey, count(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) "
    "USING (o_custkey)"
)
def join_align(spark, d):
    orders = load(spark, d, "orders")
    base = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey")
    return O.align(base, urgent.agg(F.count(F.lit(1)).alias("n_urgent")), ["o_custkey"], ["n_urgent"])


# ---- filters -----------------------------------------------------------------


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS DISTINCT FROM 0")
def filter_ne_keep_null(spark, d):
    df = load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left")
    return df.where(X.not_equal_keep_null("quality", 0)).select("doc_id", "quality")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, d):
    return load(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@query(
    "SELECT CASE WHEN quality IS NULL THEN 'score' ELSE 'train' END AS part, count(*) AS n, sum(n_chars)::BIGINT AS chars "
    "FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL"
)
def split_on_label(spark, d):
    df = load(spark, d, "documents").select("doc_id", "n_chars").join(load(spark, d, "labels"), "doc_id", "left")
    train, score = O.split_on_label(df, "quality")

    def count(part: DataFrame, label: str) -> DataFrame:
        named = part.groupBy(F.lit(label).alias("part"))
        return named.agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))

    return count(train, "train").unionByName(count(score, "score"))


@query(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice > 1e5) "
    "OR (o_orderpriority = '1-URGENT' AND NOT o_orderstatus = 'O')"
)
def filter_compound(spark, d):
    status, price, priority = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    kept = ((status == "F") & (price > 1e5)) | ((priority == "1-URGENT") & ~(status == "O"))
    return load(spark, d, "orders").where(kept).select("o_orderkey", "o_totalprice")


_NULL_PRIORITY = "nullif(o_orderpriority, '4-NOT SPECIFIED')"


@query(
    f"SELECT o_orderkey, CASE WHEN {_NULL_PRIORITY} IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_urgent, "
    f"CASE WHEN {_NULL_PRIORITY} IN ('1-URGENT', '2-HIGH') THEN 0 ELSE 1 END AS is_other FROM orders"
)
def filter_isin(spark, d):
    priority = X.null_when_in("o_orderpriority", ["4-NOT SPECIFIED"])
    urgent = X.is_member(priority, ["1-URGENT", "2-HIGH"])
    return load(spark, d, "orders").select(
        "o_orderkey", X.flag(urgent).alias("is_urgent"), X.flag(~urgent).alias("is_other")
    )


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def filter_dropna(spark, d):
    df = load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left")
    return df.na.drop(subset=["quality"])


@query(
    f"SELECT o_custkey, {fl('avg(o_totalprice)')} AS mean FROM orders GROUP BY o_custkey HAVING avg(o_totalprice) > 250000"
)
def agg_having(spark, d):
    means = load(spark, d, "orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("mean"))
    return settle(means.where(F.col("mean") > 250000), ["o_custkey"])


@query(
    "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders) WHERE nth = 1"
)
def dedup_first(spark, d):
    orders = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return O.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ---- nulls and sentinels -----------------------------------------------------


@query("SELECT p_partkey, nullif(p_size, 50) AS p_size, p_brand FROM part")
def null_sentinel(spark, d):
    return O.null_sentinels(load(spark, d, "part"), {"p_size": 50}).select("p_partkey", "p_size", "p_brand")


@query(
    "SELECT l_orderkey, nullif(l_linenumber, 1) AS l_linenumber, nullif(l_quantity, 1) AS l_quantity, "
    "nullif(l_returnflag, 'N') AS l_returnflag, nullif(l_linestatus, 'N') AS l_linestatus FROM lineitem"
)
def null_sentinel_all(spark, d):
    df = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    return O.null_sentinel_everywhere(O.null_sentinel_everywhere(df, 1, keep=["l_orderkey"]), "N")


@query("SELECT p_partkey, CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL') THEN p_type END AS p_type FROM part")
def null_values(spark, d):
    kind = X.null_when_in("p_type", ["ECONOMY", "SMALL"]).alias("p_type")
    return load(spark, d, "part").select("p_partkey", kind)


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def null_threshold(spark, d):
    return load(spark, d, "customer").select("c_custkey", X.null_below("c_acctbal", 0.0).alias("c_acctbal"))


@query("SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def fill_const(spark, d):
    df = load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left")
    return O.fill_null(df, 0, ["quality", "toxic"])


@query(f"SELECT o_orderkey, coalesce({_NULL_PRIORITY}, 'Missing') AS o_orderpriority FROM orders")
def fill_missing_label(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return O.fill_missing_label(O.null_sentinels(orders, {"o_orderpriority": "4-NOT SPECIFIED"}))


@query(
    f"SELECT l_orderkey, {fl('CASE WHEN l_discount <> 0 THEN l_tax / l_discount WHEN l_tax <> 0 THEN 0e0 END')} AS rate FROM lineitem"
)
def fill_inf(spark, d):
    rate = X.safe_div("l_tax", "l_discount", "ieee").alias("rate")
    return settle(O.infinite_to_zero(load(spark, d, "lineitem").select("l_orderkey", rate)), ["l_orderkey"])


@query(
    f"SELECT {fl('avg(CASE WHEN quality IS NULL THEN 1 ELSE 0 END)')} AS quality, 0e0 AS doc_id, "
    f"{fl('avg(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END)')} AS toxic FROM documents LEFT JOIN labels USING (doc_id)"
)
def profile_null_share(spark, d):
    df = load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left")
    return settle(O.null_shares(df), [])


# ---- scalar expressions ------------------------------------------------------


@query(f"SELECT l_orderkey, {fl('l_tax / nullif(l_discount, 0)')} AS rate FROM lineitem")
def expr_ratio(spark, d):
    rate = X.safe_div("l_tax", "l_discount").alias("rate")
    return settle(load(spark, d, "lineitem").select("l_orderkey", rate), ["l_orderkey"])


@query(
    "SELECT l_orderkey, CASE WHEN l_discount <> 0 THEN CAST(l_tax / l_discount AS FLOAT)::DOUBLE "
    "WHEN l_tax > 0 THEN 'inf'::DOUBLE WHEN l_tax < 0 THEN '-inf'::DOUBLE END + 0e0 AS rate FROM lineitem"
)
def expr_ratio_ieee(spark, d):
    rate = X.safe_div("l_tax", "l_discount", "ieee").cast("float").cast("double") + F.lit(0.0)
    return load(spark, d, "lineitem").select("l_orderkey", rate.alias("rate"))


@query(f"SELECT l_orderkey, {fl('(l_tax + 1) / (l_discount + 1)')} AS rate, {fl('l_tax / (l_discount + 0.01)')} AS offset_rate FROM lineitem")
def expr_ratio_smoothed(spark, d):
    return settle(
        load(spark, d, "lineitem").select(
            "l_orderkey",
            X.smoothed_ratio("l_tax", "l_discount", 1.0).alias("rate"),
            X.smoothed_ratio("l_tax", "l_discount", 0.0, 0.01).alias("offset_rate"),
        ),
        ["l_orderkey"],
    )


@query(
    f"SELECT l_orderkey, {fl('l_extendedprice - l_quantity')} AS diff, {fl('l_quantity + l_linenumber * 30')} AS total, "
    f"{fl('l_extendedprice * l_discount')} AS product, {fl('l_quantity / -365.25e0')} AS years, "
    f"{fl('l_discount * 100')} AS percent, 1 - l_linenumber AS turned FROM lineitem"
)
def expr_arith(spark, d):
    price, quantity, number = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_linenumber")
    df = load(spark, d, "lineitem").select(
        "l_orderkey",
        (price - quantity).alias("diff"),
        (quantity + number * 30).alias("total"),
        (price * F.col("l_discount")).alias("product"),
        (quantity / F.lit(-365.25)).alias("years"),
        (F.col("l_discount") * 100).alias("percent"),
        (-1 * number + 1).alias("turned"),
    )
    return settle(df, ["l_orderkey", "turned"])


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS positive FROM customer")
def expr_clip_zero(spark, d):
    return load(spark, d, "customer").select("c_custkey", X.clip_zero("c_acctbal").alias("positive"))


@query(
    "SELECT o_orderkey, CASE WHEN o_totalprice < 1e5 THEN 1 ELSE 0 END AS is_small, "
    "CASE WHEN o_orderstatus = 'O' AND o_totalprice < 1e5 THEN 1 ELSE 0 END AS is_small_open FROM orders"
)
def expr_flag(spark, d):
    small = F.col("o_totalprice") < 1e5
    return load(spark, d, "orders").select(
        "o_orderkey",
        X.flag(small).alias("is_small"),
        X.flag((F.col("o_orderstatus") == "O") & small).alias("is_small_open"),
    )


_GAP = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"


@query(
    f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'N' THEN 'No Payment' WHEN {_GAP} < 0 THEN 'Early' "
    f"WHEN {_GAP} = 0 THEN 'In Time' ELSE 'Late' END AS status FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
)
def expr_sign_label(spark, d):
    orders = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    gap = F.when(F.col("l_returnflag") != "N", F.datediff("l_shipdate", "o_orderdate"))
    status = X.sign_label(gap, "Early", "In Time", "Late", "No Payment").alias("status")
    return load(spark, d, "lineitem").join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", status)


@query(
    "SELECT p_partkey, CASE WHEN p_size > 10 AND p_size <= 20 THEN 'small' WHEN p_size > 20 AND p_size <= 35 THEN 'medium' "
    "WHEN p_size > 35 THEN 'large' END AS size_class FROM part"
)
def expr_bin(spark, d):
    size = X.bin_right_closed("p_size", [10, 20, 35], ["small", "medium", "large"])
    return load(spark, d, "part").select("p_partkey", size.alias("size_class"))


@query(
    "SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 3e5 THEN 2 WHEN o_orderstatus = 'F' THEN 1 "
    "WHEN o_orderpriority = '1-URGENT' THEN 3 END, 0) AS code FROM orders"
)
def expr_overwrite(spark, d):
    rules = [
        (F.col("o_orderpriority") == "1-URGENT", 3),
        (F.col("o_orderstatus") == "F", 1),
        (F.col("o_totalprice") > 3e5, 2),
    ]
    code = X.overwrite(F.lit(None).cast("int"), rules, default=0)
    return load(spark, d, "orders").select("o_orderkey", code.alias("code"))


@query("SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber > 3 THEN 4 ELSE l_linenumber END AS capped FROM lineitem")
def expr_cap(spark, d):
    return load(spark, d, "lineitem").select("l_orderkey", "l_partkey", X.cap_above("l_linenumber", 3, 4).alias("capped"))


@query("SELECT l_orderkey, l_partkey, round_even(l_quantity / 2, 0) AS halves FROM lineitem")
def expr_round_even(spark, d):
    return load(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", X.round_even(F.col("l_quantity") / F.lit(2.0)).alias("halves")
    )


@query(status_score_block().query("SK_ID_BUREAU"))
def expr_xor_score(spark, d):
    return settle(plans.credit_status_score(CreditTables(spark, d)["bureau_balance"]), ["SK_ID_BUREAU"])


@query(
    f"SELECT l_orderkey, l_partkey, {fl('(coalesce(nullif(l_discount, 0), 0) + coalesce(nullif(l_tax, 0), 0) + l_quantity) / (1 + (CASE WHEN l_discount <> 0 THEN 1 ELSE 0 END) + (CASE WHEN l_tax <> 0 THEN 1 ELSE 0 END))')} AS mean FROM lineitem"
)
def expr_row_mean(spark, d):
    mean = X.row_mean(X.null_when_in("l_discount", [0.0]), X.null_when_in("l_tax", [0.0]), "l_quantity")
    return settle(load(spark, d, "lineitem").select("l_orderkey", "l_partkey", mean.alias("mean")), ["l_orderkey", "l_partkey"])


@query(
    "SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS whole, CAST(c_nationkey AS DOUBLE) AS nation, "
    "CAST(c_custkey AS VARCHAR) AS text FROM customer"
)
def expr_cast(spark, d):
    return load(spark, d, "customer").select(
        "c_custkey",
        X.to_long("c_acctbal").alias("whole"),
        F.col("c_nationkey").cast("double").alias("nation"),
        F.col("c_custkey").cast("string").alias("text"),
    )


@query(
    with_tables("bureau_balance")
    + " SELECT SK_ID_BUREAU, MONTHS_BALANCE, CASE WHEN STATUS IN ('X', 'C') THEN 0 ELSE TRY_CAST(STATUS AS INTEGER) END AS level FROM bureau_balance"
)
def expr_parse_code(spark, d):
    level = X.code_to_int("STATUS", ["X", "C"]).alias("level")
    return CreditTables(spark, d)["bureau_balance"].select("SK_ID_BUREAU", "MONTHS_BALANCE", level)


@query("SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN 'Rare' ELSE p_type END AS p_type FROM part")
def expr_regroup(spark, d):
    return load(spark, d, "part").select(
        "p_partkey", X.regroup("p_type", ["ECONOMY", "SMALL", "PROMO"], "Rare").alias("p_type")
    )


@query("SELECT event_id, CASE WHEN extract(hour FROM ts) BETWEEN 8 AND 17 THEN 'working_hours' ELSE 'off_hours' END AS band FROM events")
def expr_band(spark, d):
    band = X.band_between(F.hour("ts"), 8, 17, "working_hours", "off_hours")
    return load(spark, d, "events").select("event_id", band.alias("band"))


# ---- encoders ----------------------------------------------------------------

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _dummies(values: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS c_mktsegment_{v}" for v in values
    )


@query(f"SELECT c_custkey, {_dummies(_SEGMENTS)} FROM customer")
def encode_onehot(spark, d):
    df = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return O.one_hot_encoder(df, ["c_mktsegment"], null_column=False)[0]


@query(
    f"SELECT c_custkey, {_dummies(_SEGMENTS[1:])}, CASE WHEN c_mktsegment IS NULL THEN 1 ELSE 0 END AS c_mktsegment_nan "
    "FROM (SELECT c_custkey, nullif(c_mktsegment, 'AUTOMOBILE') AS c_mktsegment FROM customer)"
)
def encode_onehot_null(spark, d):
    df = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return O.one_hot_encoder(O.null_sentinels(df, {"c_mktsegment": "AUTOMOBILE"}))[0]


@query(f"SELECT c_custkey, {_dummies(_SEGMENTS[1:])} FROM customer")
def encode_onehot_drop_first(spark, d):
    df = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return O.one_hot_encoder(df, null_column=False, drop_first=True)[0]


@query(
    "WITH first AS (SELECT o_orderpriority, min(o_orderkey) AS k FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders) "
    "WHERE o_orderpriority IS NOT NULL GROUP BY 1), codes AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS code FROM first) "
    "SELECT o_orderkey, coalesce(code, -1) AS o_orderpriority FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders) "
    "LEFT JOIN codes ON p = o_orderpriority"
)
def encode_factorize(spark, d):
    df = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    df = O.null_sentinels(df, {"o_orderpriority": "5-LOW"})
    return O.first_seen_encode(df, ["o_orderpriority"], F.col("o_orderkey"))


@query("SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand FROM part")
def encode_label(spark, d):
    return O.label_encode(load(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"])


@query("SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_totalprice) - 1 AS INTEGER) AS code FROM orders")
def encode_label_many(spark, d):
    """Too many values for a map: codes come from a distributed sort."""
    df = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    coded = O.label_codes(df, "o_totalprice").apply(df, "code")
    return coded.select("o_orderkey", "code")


@query(
    "SELECT l_orderkey, l_partkey, l_returnflag, CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS l_linestatus FROM lineitem"
)
def encode_label_binary(spark, d):
    df = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    return O.label_encode_binary(df)[0]


@query(
    "WITH counts AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) "
    "SELECT p_partkey, CASE WHEN n >= 0.04 * (SELECT count(*) FROM part) THEN p_brand ELSE 'Rare' END AS p_brand FROM part JOIN counts USING (p_brand)"
)
def encode_rare(spark, d):
    return O.rare_labels(load(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"], 0.04, 4)


@query(
    "WITH p AS (SELECT p_partkey, nullif(p_brand, 'Brand#1') AS p_brand FROM part), counts AS (SELECT p_brand, count(*) AS n FROM p GROUP BY p_brand) "
    "SELECT p_partkey, CASE WHEN n * 100.0 / (SELECT count(*) FROM p) <= 4.1 THEN 'Rare' ELSE p.p_brand END AS p_brand "
    "FROM p JOIN counts ON p.p_brand IS NOT DISTINCT FROM counts.p_brand"
)
def encode_rare_pct(spark, d):
    df = load(spark, d, "part").select("p_partkey", "p_brand")
    return O.rare_labels_percent(O.null_sentinels(df, {"p_brand": "Brand#1"}), {"p_brand": 4.1})


@query(
    "WITH l AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice * 100 AS BIGINT) AS VARCHAR) AS price, l_returnflag FROM lineitem), "
    "p AS (SELECT price, count(*) AS n FROM l GROUP BY price), f AS (SELECT l_returnflag, count(*) AS m FROM l GROUP BY l_returnflag) "
    "SELECT l_orderkey, l_linenumber, CASE WHEN n >= 0.0001 * (SELECT count(*) FROM l) THEN price ELSE 'Rare' END AS price, "
    "CASE WHEN (SELECT count(*) FROM f) <= 2 OR m >= 0.0001 * (SELECT count(*) FROM l) THEN l_returnflag ELSE 'Rare' END AS l_returnflag "
    "FROM l JOIN p USING (price) JOIN f USING (l_returnflag)"
)
def encode_rare_many(spark, d):
    """Rare values of a column with tens of thousands of them."""
    df = load(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CAST(CAST(l_extendedprice * 100 AS BIGINT) AS STRING) AS price", "l_returnflag"
    )
    return O.rare_labels(df, ["price", "l_returnflag"], 0.0001, 2)


@query(
    "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS l_linestatus FROM lineitem"
)
def encode_label_binary_many(spark, d):
    """A frame whose other text column has a value of its own in every row."""
    df = load(spark, d, "lineitem").selectExpr("concat(l_orderkey, '-', l_linenumber) AS id", "l_linestatus")
    return O.label_encode_binary(df)[0]


@query(
    "WITH long AS (SELECT o_custkey, 'o_orderpriority' AS \"column\", o_orderpriority AS value FROM orders UNION ALL SELECT o_custkey, 'o_orderstatus', o_orderstatus FROM orders), "
    "sizes AS (SELECT o_custkey, count(*) AS m FROM orders GROUP BY o_custkey) "
    "SELECT o_custkey, \"column\", value, count(*) AS n, CAST(count(*) AS DOUBLE) / any_value(m) AS share FROM long JOIN sizes USING (o_custkey) GROUP BY ALL"
)
def agg_category_share_long(spark, d):
    return O.category_share_rows(load(spark, d, "orders"), ["o_custkey"], ["o_orderpriority", "o_orderstatus"])


# ---- aggregates --------------------------------------------------------------


@query(
    "WITH o AS (SELECT o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price FROM orders) "
    f"SELECT o_custkey, {fl('min(price)')} AS price_MIN, {fl('max(price)')} AS price_MAX, {fl('avg(price)')} AS price_MEAN, {fl('coalesce(sum(price), 0)')} AS price_SUM, "
    f"{fl('count(price)')} AS price_COUNT, {fl('count(DISTINCT price)')} AS price_NUNIQUE, {fl('median(price)')} AS price_MEDIAN FROM o GROUP BY o_custkey"
)
def agg_nan(spark, d):
    """NaN counts as null in every aggregate."""
    orders = load(spark, d, "orders").selectExpr("o_custkey", "CASE WHEN o_orderstatus = 'F' THEN double('NaN') ELSE o_totalprice END AS price")
    return settle(O.summarize(orders, ["o_custkey"], {"price": ["min", "max", "mean", "sum", "count", "nunique", "median"]}), ["o_custkey"])


@query(
    "WITH o AS (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price, CAST(o_orderstatus = 'F' AS INTEGER) AS done FROM orders) "
    f"SELECT o_custkey, {fl('max(price)')} AS price_MAX, {fl('avg(price)')} AS price_MEAN, {fl('sum(price)')} AS price_SUM, "
    f"{fl('max(done)')} AS done_MAX, {fl('avg(done)')} AS done_MEAN, {fl('sum(done)')} AS done_SUM FROM o GROUP BY o_custkey"
)
def agg_decimal(spark, d):
    """Decimals and booleans are numbers to a spec over every column."""
    orders = load(spark, d, "orders").selectExpr("o_custkey", "CAST(o_totalprice AS DECIMAL(12,2)) AS price", "o_orderstatus = 'F' AS done")
    return settle(O.summarize(orders, ["o_custkey"], O.every_column(orders, ["o_custkey"], ["max", "mean", "sum"])), ["o_custkey"])


def _order_agg(**named: str) -> str:
    exprs = ", ".join(f"{fl(e)} AS {n}" for n, e in named.items())
    return f"SELECT o_custkey, {exprs} FROM orders GROUP BY o_custkey"


def _summary(table: str, key: str, spec: dict, prefix: str = "") -> Query:
    return lambda spark, d: settle(O.summarize(load(spark, d, table), [key], spec, prefix), [key])


def register_summary(name: str, table: str, key: str, spec: dict, sql: str, prefix: str = "") -> None:
    QUERIES[name] = _summary(table, key, spec, prefix)
    ORACLE[name] = sql


register_summary(
    "agg_spec",
    "orders",
    "o_custkey",
    {"o_totalprice": ["min", "mean", "sum"], "o_orderkey": ["size", "nunique"]},
    _order_agg(
        ORD_o_totalprice_MIN="min(o_totalprice)",
        ORD_o_totalprice_MEAN="avg(o_totalprice)",
        ORD_o_totalprice_SUM="sum(o_totalprice)",
        ORD_o_orderkey_SIZE="count(*)",
        ORD_o_orderkey_NUNIQUE="count(DISTINCT o_orderkey)",
    ),
    "ORD_",
)
register_summary(
    "agg_min_max",
    "orders",
    "o_custkey",
    {"o_totalprice": ["min", "max"]},
    _order_agg(o_totalprice_MIN="min(o_totalprice)", o_totalprice_MAX="max(o_totalprice)"),
)
register_summary(
    "agg_mean", "orders", "o_custkey", {"o_totalprice": ["mean"]}, _order_agg(o_totalprice_MEAN="avg(o_totalprice)")
)
register_summary(
    "agg_var_std",
    "orders",
    "o_custkey",
    {"o_totalprice": ["var", "std"]},
    _order_agg(o_totalprice_VAR="var_samp(o_totalprice)", o_totalprice_STD="stddev_samp(o_totalprice)"),
)
register_summary(
    "agg_median", "orders", "o_custkey", {"o_totalprice": ["median"]}, _order_agg(o_totalprice_MEDIAN="median(o_totalprice)")
)
register_summary(
    "agg_skew",
    "orders",
    "o_custkey",
    {"o_totalprice": ["skew"]},
    _order_agg(
        o_totalprice_SKEW="CASE WHEN count(*) >= 3 THEN coalesce(skewness(o_totalprice), 0) END"
    ),
)
register_summary(
    "agg_nunique",
    "lineitem",
    "l_orderkey",
    {"l_partkey": ["nunique"], "l_suppkey": ["nunique"]},
    "SELECT l_orderkey, CAST(count(DISTINCT l_partkey) AS DOUBLE) AS l_partkey_NUNIQUE, "
    "CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS l_suppkey_NUNIQUE FROM lineitem GROUP BY l_orderkey",
)


@query(
    f"SELECT l_orderkey, {fl('coalesce(sum(nullif(l_discount, 0)), 0)')} AS discount_SUM FROM lineitem GROUP BY l_orderkey"
)
def agg_sum(spark, d):
    df = load(spark, d, "lineitem").withColumn("discount", X.null_when_in("l_discount", [0.0]))
    return settle(O.summarize(df, ["l_orderkey"], {"discount": ["sum"]}), ["l_orderkey"])


@query(
    "SELECT l_orderkey, count(nullif(l_discount, 0)) AS discount_COUNT, count(*) AS discount_SIZE FROM lineitem GROUP BY l_orderkey"
)
def agg_count_size(spark, d):
    df = load(spark, d, "lineitem").withColumn("discount", X.null_when_in("l_discount", [0.0]))
    return O.summarize(df, ["l_orderkey"], {"discount": ["count", "size"]})


@query("SELECT l_orderkey, bool_and(l_discount <> 0) AS l_discount_ALL FROM lineitem GROUP BY l_orderkey")
def agg_all(spark, d):
    return O.summarize(load(spark, d, "lineitem"), ["l_orderkey"], {"l_discount": ["all"]})


_FIVE = ["min", "max", "mean", "sum", "var"]
_FIVE_SQL = {"MIN": "min", "MAX": "max", "MEAN": "avg", "SUM": "sum", "VAR": "var_samp"}


@query(
    "SELECT user_id, "
    + ", ".join(f"{fl(f'{f}({c})')} AS CC_{c}_{n}" for c in ("event_id", "value") for n, f in _FIVE_SQL.items())
    + " FROM events GROUP BY user_id"
)
def agg_all_columns(spark, d):
    events = load(spark, d, "events")
    return settle(O.summarize(events, ["user_id"], O.every_column(events, ["user_id"], _FIVE), "CC_"), ["user_id"])


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "SELECT user_id, "
    + ", ".join(
        f"{fl(f'avg(CASE WHEN event_type = {chr(39)}{v}{chr(39)} THEN 1 ELSE 0 END)')} AS event_type_{v}_MEAN, "
        f"CAST(count(*) FILTER (WHERE event_type = '{v}') AS DOUBLE) AS event_type_{v}_SUM"
        for v in _EVENT_TYPES
    )
    + ", 0e0 AS event_type_nan_MEAN, 0e0 AS event_type_nan_SUM FROM events GROUP BY user_id"
)
def agg_category_share(spark, d):
    events = load(spark, d, "events")
    shares = O.Shares(O.learn_categories(events, ["event_type"]), ["mean", "sum"])
    return settle(O.summarize(events, ["user_id"], {}, shares=shares), ["user_id"])


@query(
    "SELECT o_custkey, count(*)::DOUBLE AS o_totalprice_SIZE, "
    f"{fl('sum(o_totalprice)')} AS o_totalprice_SUM, "
    "CASE WHEN count(*) FILTER (WHERE o_totalprice > 480000) > 0 THEN (count(*) FILTER (WHERE o_totalprice > 480000))::DOUBLE END AS BIG_o_totalprice_SIZE, "
    f"{fl('sum(o_totalprice) FILTER (WHERE o_totalprice > 480000)')} AS BIG_o_totalprice_SUM, "
    f"{fl('var_samp(o_totalprice) FILTER (WHERE o_totalprice > 480000)')} AS BIG_o_totalprice_VAR "
    "FROM orders GROUP BY o_custkey"
)
def agg_subset(spark, d):
    big = O.Subset("BIG_", F.col("o_totalprice") > 480000, {"o_totalprice": ["size", "sum", "var"]})
    df = O.summarize(load(spark, d, "orders"), ["o_custkey"], {"o_totalprice": ["size", "sum"]}, subsets=[big])
    return settle(df, ["o_custkey"])


@query(
    "WITH per_order AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY l_orderkey) "
    f"SELECT o_custkey, {fl('avg(q)')} AS l_quantity_SUM_MEAN, {fl('max(q)')} AS l_quantity_SUM_MAX, "
    f"{fl('coalesce(sum(n), 0)')} AS l_quantity_SIZE_SUM FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey GROUP BY o_custkey"
)
def agg_two_level(spark, d):
    per_order = O.summarize(load(spark, d, "lineitem"), ["l_orderkey"], {"l_quantity": ["sum", "size"]})
    orders = load(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    spec = {"l_quantity_SUM": ["mean", "max"], "l_quantity_SIZE": ["sum"]}
    return settle(O.summarize(O.attach(orders, per_order, on="l_orderkey"), ["o_custkey"], spec), ["o_custkey"])


@query(f"SELECT user_id, event_type, {fl('max(value)')} AS value_MAX FROM events GROUP BY user_id, event_type")
def agg_composite_key(spark, d):
    df = O.summarize(load(spark, d, "events"), ["user_id", "event_type"], {"value": ["max"]})
    return settle(df, ["user_id"])


@query("SELECT l_orderkey, count(*) FILTER (WHERE l_discount IS DISTINCT FROM 0) AS nonzero FROM lineitem GROUP BY l_orderkey")
def agg_count_nonzero(spark, d):
    return O.summarize(load(spark, d, "lineitem"), ["l_orderkey"], {}, extra={"nonzero": O.count_nonzero("l_discount")})


@query(
    f"SELECT l_orderkey, {fl('100.0e0 * count(*) FILTER (WHERE l_discount < l_tax) / count(*)')} AS percent FROM lineitem GROUP BY l_orderkey"
)
def agg_pct_below(spark, d):
    extra = {"percent": O.percent_below("l_discount", "l_tax")}
    return settle(O.summarize(load(spark, d, "lineitem"), ["l_orderkey"], {}, extra=extra), ["l_orderkey"])


@query("SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final FROM orders GROUP BY o_custkey")
def agg_count_if(spark, d):
    extra = {"n_final": F.count_if(F.col("o_orderstatus") == "F")}
    return O.summarize(load(spark, d, "orders"), ["o_custkey"], {}, extra=extra)


@query(
    "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS nth FROM orders) WHERE nth = 1"
)
def agg_argmax_row(spark, d):
    orders = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return O.argmax_row(orders, ["o_custkey"], "o_totalprice", ["o_orderkey"])


@query(
    f"SELECT event_id, user_id, {fl('sum(value) OVER (PARTITION BY user_id) / count(value) OVER (PARTITION BY user_id)')} AS user_mean FROM events"
)
def win_group_stat(spark, d):
    events = load(spark, d, "events").select("event_id", "user_id", "value")
    mean = (F.sum("value") / F.count("value")).alias("user_mean")
    return settle(O.attach_group_stats(events, ["user_id"], [mean]).drop("value"), ["event_id", "user_id"])


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {fl(f'quantile_cont({c}, 0.01)')} AS q01, {fl(f'median({c})')} AS median, "
        f"{fl(f'quantile_cont({c}, 0.99)')} AS q99 FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    )
)
def agg_global_stats(spark, d):
    quantiles = {"q01": 0.01, "median": 0.5, "q99": 0.99}
    lines = load(spark, d, "lineitem")
    return settle(O.column_quantiles(lines, ["l_quantity", "l_extendedprice", "l_discount"], quantiles), [])


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def agg_value_counts(spark, d):
    return O.value_frequencies(load(spark, d, "part"), "p_brand")


@query(
    "SELECT o_custkey, "
    f"{fl('max(o_totalprice) - min(o_totalprice)')} AS price_range, {fl('avg(o_totalprice) / max(o_totalprice)')} AS price_ratio, "
    "CAST(CASE WHEN max(o_totalprice) > 400000 THEN 1 ELSE 0 END AS DOUBLE) AS has_big FROM orders GROUP BY o_custkey"
)
def agg_post_expr(spark, d):
    df = O.summarize(load(spark, d, "orders"), ["o_custkey"], {"o_totalprice": ["min", "max", "mean"]})
    high = F.col("o_totalprice_MAX")
    return settle(
        df.select(
            "o_custkey",
            (high - F.col("o_totalprice_MIN")).alias("price_range"),
            X.safe_div("o_totalprice_MEAN", high).alias("price_ratio"),
            X.flag(high > 400000).alias("has_big"),
        ),
        ["o_custkey"],
    )


# ---- joins and unions --------------------------------------------------------


@query(
    "SELECT c_custkey, c_acctbal, n FROM customer LEFT JOIN (SELECT user_id AS c_custkey, count(*) AS n FROM events GROUP BY user_id) USING (c_custkey)"
)
def join_left(spark, d):
    counts = load(spark, d, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return O.attach(load(spark, d, "customer").select("c_custkey", "c_acctbal"), counts, on="c_custkey")


@query(
    f"SELECT c_custkey, n_name, r_name, {fl('total')} AS total, n_events FROM customer JOIN nation ON n_nationkey = c_nationkey "
    "JOIN region ON r_regionkey = n_regionkey "
    "LEFT JOIN (SELECT o_custkey AS c_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) USING (c_custkey) "
    "LEFT JOIN (SELECT user_id AS c_custkey, count(*) AS n_events FROM events GROUP BY 1) USING (c_custkey)"
)
def join_star(spark, d):
    nation = load(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = load(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    base = load(spark, d, "customer").join(nation, "c_nationkey").join(region, "n_regionkey")
    totals = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("total"))
    events = load(spark, d, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_events"))
    wide = O.attach(base.select("c_custkey", "n_name", "r_name"), totals, events, on="c_custkey")
    return settle(wide, ["c_custkey", "n_events"])


@query("SELECT o_orderkey, c_name, c_acctbal FROM orders JOIN customer ON c_custkey = o_custkey")
def join_inner(spark, d):
    customer = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal")
    return load(spark, d, "orders").join(customer, "o_custkey", "inner").select("o_orderkey", "c_name", "c_acctbal")


@query("SELECT doc_id, n_chars, quality FROM labels RIGHT JOIN documents USING (doc_id)")
def join_right(spark, d):
    documents = load(spark, d, "documents").select("doc_id", "n_chars")
    return load(spark, d, "labels").join(documents, "doc_id", "right").select("doc_id", "n_chars", "quality")


@query(
    "SELECT a.o_custkey, a.n AS n_x, b.n AS n_y FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a "
    "JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b USING (o_custkey)"
)
def join_suffix(spark, d):
    def count(status: str) -> DataFrame:
        orders = load(spark, d, "orders").where(F.col("o_orderstatus") == status)
        return orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))

    return O.join_suffixed(count("F"), count("O"), ["o_custkey"])


@query("SELECT c_custkey, CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 1 ELSE 0 END AS has_events FROM customer")
def join_exists_flag(spark, d):
    events = load(spark, d, "events").withColumnRenamed("user_id", "c_custkey")
    return O.exists_flag(load(spark, d, "customer").select("c_custkey"), events, ["c_custkey"], "has_events")


@query(
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey "
    "ORDER BY avg(o_totalprice) DESC, o_custkey LIMIT 40)"
)
def join_semi_topk(spark, d):
    return O.semi_join_top(load(spark, d, "orders"), "o_custkey", "o_totalprice", 40).select("o_orderkey", "o_custkey")


@query(
    "SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal FROM customer"
)
def union_by_name(spark, d):
    customer = load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    known = customer.where(F.col("c_mktsegment") != "BUILDING").drop("c_mktsegment")
    unknown = customer.where(F.col("c_mktsegment") == "BUILDING").select("c_name", "c_custkey")
    return O.union_all_by_name(known, unknown)


# ---- ranks and order ---------------------------------------------------------


@query(
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, rank() OVER (ORDER BY l_quantity) "
    "+ (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0e0 AS rank FROM lineitem"
)
def win_rank_avg(spark, d):
    lines = load(spark, d, "lineitem")
    lines = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return O.average_rank(lines, "l_quantity", "rank").drop("l_quantity")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def sort_topk(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return O.top_rows(orders, 100, [F.desc("o_totalprice"), "o_orderkey"])


# ---- column profiles and selection -------------------------------------------


def _wide_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines beside derived copies, constants and scaled columns."""
    return load(spark, d, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_quantity AS quantity_copy",
        "l_quantity * 2 + 1 AS quantity_scaled",
        "-l_extendedprice + l_quantity AS price_negative",
        "1 AS one",
        "CASE WHEN l_extendedprice > 100000 THEN 2 ELSE 1 END AS nearly_one",
        "nullif(l_tax, 0D) AS tax_known",
        "CASE WHEN l_quantity > 49 THEN 0D ELSE l_quantity END AS quantity_changed",
    )


_WIDE_SQL = (
    "(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_quantity AS quantity_copy, l_quantity * 2 + 1 AS quantity_scaled, -l_extendedprice + l_quantity AS price_negative, "
    "1 AS one, CASE WHEN l_extendedprice > 100000 THEN 2 ELSE 1 END AS nearly_one, nullif(l_tax, 0) AS tax_known, "
    "CASE WHEN l_quantity > 49 THEN 0 ELSE l_quantity END AS quantity_changed FROM lineitem)"
)
_WIDE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax quantity_copy quantity_scaled "
    "price_negative one nearly_one tax_known quantity_changed"
).split()


def _named(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "column_name string")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name WHERE (SELECT max(n) FROM (SELECT count({c}) AS n FROM {_WIDE_SQL} GROUP BY {c})) "
        "/ (SELECT count(*) FROM lineitem) >= 0.98"
        for c in _WIDE_COLUMNS
    )
)
def select_quasi_constant(spark, d):
    return _named(spark, O.quasi_constant_columns(_wide_lines(spark, d), 0.98))


@query(
    " UNION ".join(
        f"SELECT '{b}' AS column_name WHERE NOT EXISTS (SELECT 1 FROM {_WIDE_SQL} WHERE {a} IS DISTINCT FROM {b})"
        for i, a in enumerate(_WIDE_COLUMNS)
        for b in _WIDE_COLUMNS[i + 1 :]
        if a.startswith(("l_q", "l_t", "one", "quantity")) and b.startswith(("quantity", "tax", "nearly"))
    )
)
def select_duplicate(spark, d):
    return _named(spark, O.duplicate_columns(_wide_lines(spark, d), ["l_orderkey", "l_linenumber"]))


_CORRELATED = [c for c in _WIDE_COLUMNS if c not in ("one",)]


_CORRELATION_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(CASE WHEN var_pop({a}) > 0 AND var_pop({b}) > 0 "
    f"THEN corr({a}, {b}) END, 6) AS corr FROM {_WIDE_SQL}"
    for i, a in enumerate(_CORRELATED)
    for b in _CORRELATED[i + 1 :]
)


@query(_CORRELATION_SQL)
def profile_correlation(spark, d):
    pairs = O.column_correlations(_wide_lines(spark, d), _CORRELATED)
    return pairs.withColumn("corr", F.round("corr", 6).cast("double"))


@query(
    "SELECT DISTINCT column_b AS column_name FROM (" + _CORRELATION_SQL + ") WHERE abs(corr) > 0.9"
)
def select_correlated(spark, d):
    return _named(spark, O.correlated_columns(_wide_lines(spark, d), 0.9, _CORRELATED))


@query(
    f"WITH RECURSIVE pair AS ({_CORRELATION_SQL}), name AS (SELECT unnest({_CORRELATED!r}) AS c, generate_subscripts({_CORRELATED!r}, 1) AS i), "
    "link AS (SELECT column_a AS a, column_b AS b FROM pair WHERE abs(corr) > 0.75 UNION ALL SELECT column_b, column_a FROM pair WHERE abs(corr) > 0.75), "
    "reach AS (SELECT c, c AS other FROM name UNION SELECT reach.c, link.b FROM reach JOIN link ON reach.other = link.a) "
    "SELECT reach.c AS column_name, arg_min(other, i) AS first_member FROM reach JOIN name ON name.c = other GROUP BY reach.c"
)
def select_correlated_groups(spark, d):
    pairs = O.column_correlations(_wide_lines(spark, d), _CORRELATED)
    groups = correlated_groups(pairs.withColumn("corr", F.round("corr", 6)), _CORRELATED)
    return spark.createDataFrame(list(groups.items()), "column_name string, first_member string")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name WHERE (SELECT stddev_samp({c}) FROM {_WIDE_SQL}) < 0.1" for c in _WIDE_COLUMNS
    )
)
def select_low_variance(spark, d):
    return _named(spark, O.low_variance_columns(_wide_lines(spark, d), 0.1))


_CAP = "quantile_cont(value, 0.99) + 1.5 * (quantile_cont(value, 0.99) - quantile_cont(value, 0.01))"


@query(
    f"WITH cap AS (SELECT {_CAP} AS high FROM events) SELECT event_id, {fl('CASE WHEN value > high THEN high ELSE value END')} AS value FROM events, cap"
)
def outlier_cap(spark, d):
    events = load(spark, d, "events").select("event_id", "value")
    return settle(O.cap_outliers(events, ["value"]), ["event_id"])


@query(
    "SELECT CAST(p_partkey AS SMALLINT) AS p_partkey, CAST(p_size AS TINYINT) AS p_size, p_brand, "
    "CAST(p_retailprice AS FLOAT) AS p_retailprice FROM part"
)
def type_downcast(spark, d):
    return O.narrow_types(load(spark, d, "part").select("p_partkey", "p_size", "p_brand", "p_retailprice"))


def wide_snapshot(spark: SparkSession, d: str, path: str | None = None) -> DataFrame:
    """The whole wide table, rows with and without a label, as one written snapshot, at ``path`` where that is given."""
    wide = plans.wide_rare(CreditTables(spark, d), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = path or scratch_path(spark, "wide")
    free_files(spark)
    write_snapshot(wide, path)
    O.drop_bucketed(wide)
    return read_snapshot(spark, path)


@query()
def pipe_prune(spark, d):
    """The wide table less the columns that an earlier one stands for."""
    return plans.prune(wide_snapshot(spark, d))


# ---- exact AUC ---------------------------------------------------------------


@query(
    "WITH s AS (SELECT n_chars, quality FROM documents JOIN labels USING (doc_id)), "
    "r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0e0 AS rank FROM s) "
    f"SELECT {fl('(sum(rank) FILTER (WHERE quality = 1) - sum(quality) * (sum(quality) + 1) / 2.0e0) / (sum(quality) * sum(1 - quality))')} AS auc FROM r"
)
def metric_auc(spark, d):
    scored = load(spark, d, "documents").select("doc_id", "n_chars").join(load(spark, d, "labels"), "doc_id")
    return settle(O.roc_auc(scored, "quality", "n_chars"), [])
