"""Registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronlens.operators import (
    attribution,
    buytilldie,
    churn,
    cleaning,
    clustering,
    cohorts,
    dashboard,
    density,
    estimators,
    features,
    importance,
    ltv,
    metrics,
    ranking,
    rfm,
    segments,
    splits,
)
from patronlens.operators.silhouette import euclidean_silhouette
from patronlens.plans import lifetime, retention
from patronlens.schema import CUSTOMER, RFM
from patronlens.session import materialize, scratch_path
from patronlens.sources import runlog, transactions
from patronlens.sources.star import event_transactions, star_transactions, table
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[name] = query
        return query

    return add


def rounded(df: DataFrame, digits: dict[int, str]) -> DataFrame:
    """Round the named double columns to 2, 4 or 6 digits, whichever their size allows."""
    return df.withColumns({c: F.round(c, d) for d, names in digits.items() for c in names.split()})


LINE_COLUMNS = [CUSTOMER, "InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice", "Country"]
LARGE_FEATURES = "total_revenue avg_order_value std_order_value avg_unit_price max_unit_price revenue_per_item"
SMALL_FEATURES = (
    "avg_days_between_orders purchase_frequency_per_month product_diversity_ratio log_total_revenue "
    "log_avg_order_value log_total_items"
)


def _lines(df: DataFrame, *extra: str) -> DataFrame:
    money = [F.col(c).cast("double").alias(c) for c in ("UnitPrice", *extra) if c in ("UnitPrice", "Revenue")]
    plain = [c for c in (*LINE_COLUMNS, *extra) if c not in ("UnitPrice", "Revenue")]
    return df.select(*plain, *money)


# --- sources and sinks ------------------------------------------------------


@register("S1_load_transactions")
def load_transactions(spark, folder):
    path = scratch_path(spark, "transactions-csv")
    transactions.write_transactions(star_transactions(spark, folder), path)
    return _lines(transactions.load_transactions(spark, path), "Description")


def _messy_file(spark, folder) -> str:
    """A CSV as exports have them: numbers, ids and dates in several spellings, some unreadable."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    rows = lines.selectExpr(
        "concat(o_custkey, CASE o_custkey % 4 WHEN 0 THEN '.0' WHEN 1 THEN 'E2' WHEN 2 THEN '.99' ELSE 'C' END) AS CustomerID",
        "CAST(o_orderkey AS STRING) AS InvoiceNo",
        "CAST(l_linenumber AS STRING) AS StockCode",
        "CASE l_linenumber % 4 WHEN 0 THEN concat(CAST(l_quantity AS INT), '.0') WHEN 1 THEN concat(CAST(l_quantity AS INT))"
        " WHEN 2 THEN concat(CAST(l_quantity AS INT), '000000000') ELSE 'n/a' END AS Quantity",
        "CASE l_linenumber % 3 WHEN 0 THEN date_format(o_orderdate, 'M/d/yyyy H:mm')"
        " WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') ELSE '31/12/2010 10:00' END AS InvoiceDate",
        "concat(CAST(l_extendedprice AS BIGINT), '.00', l_linenumber) AS UnitPrice",
    )
    path = scratch_path(spark, "messy-csv")
    rows.write.option("header", True).option("encoding", transactions.ENCODING).csv(path)
    return path


@register("S1_load_messy")
def load_messy(spark, folder):
    loaded = transactions.load_transactions(spark, _messy_file(spark, folder), format="csv")
    return cleaning.normalize_customer_id(loaded).select(
        CUSTOMER, "InvoiceNo", "StockCode", "Quantity", "InvoiceDate", F.col("UnitPrice").cast("double").alias("UnitPrice")
    )


@register("S1_load_quoted")
def load_quoted(spark, folder):
    """Cells with separators, quotes and line breaks, written and read back."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS InvoiceNo",
        "CAST(l_linenumber AS STRING) AS StockCode",
        "CASE l_partkey % 5 WHEN 0 THEN concat('SET OF ', l_linenumber, ' \"PINK\", HEARTS') WHEN 1 THEN concat('two', char(10), 'lines, \"', char(10))"
        " WHEN 2 THEN concat('5\" PIPE ', l_suppkey) WHEN 3 THEN concat(' ', char(92), '\" ') ELSE concat('\"', l_returnflag, '\"') END AS Description",
        "CAST(l_quantity AS BIGINT) AS Quantity",
        "CASE l_suppkey % 2 WHEN 0 THEN concat('Korea, \"South\"', char(10)) ELSE 'Peru' END AS Country",
    )
    path = scratch_path(spark, "quoted-csv")
    transactions.write_transactions(lines, path)
    read = transactions.load_transactions(spark, path)
    return read.select("InvoiceNo", "StockCode", "Description", "Quantity", "Country")


@register("S1_unreadable_cells")
def unreadable_cells(spark, folder):
    return transactions.unreadable_cells(spark, _messy_file(spark, folder))


@register("S2_write_transactions")
def write_transactions(spark, folder):
    path = scratch_path(spark, "transactions-csv")
    transactions.write_transactions(star_transactions(spark, folder), path)
    amount = F.col("Quantity") * F.col("UnitPrice")
    return (
        transactions.load_transactions(spark, path)
        .groupBy("Country")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count(CUSTOMER).alias("known"),
            F.sum("Quantity").alias("items"),
            F.sum(amount).cast("double").alias("amount"),
        )
    )


@register("S3_dataset_profile")
def dataset_profile(spark, folder):
    return transactions.dataset_profile(star_transactions(spark, folder))


# --- row rules --------------------------------------------------------------


@register("F1_drop_cancellations")
def drop_cancellations(spark, folder):
    return _lines(cleaning.drop_cancellations(star_transactions(spark, folder)))


@register("F2_drop_null_customers")
def drop_null_customers(spark, folder):
    return _lines(cleaning.drop_null_customers(star_transactions(spark, folder)))


@register("F3_normalize_customer_id")
def normalize_customer_id(spark, folder):
    numeric = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").cast("string").alias(CUSTOMER)
    )
    named = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias(CUSTOMER))
    return cleaning.normalize_customer_id(numeric.union(named))


@register("F4_positive_lines")
def positive_lines(spark, folder):
    return _lines(cleaning.positive_lines(star_transactions(spark, folder)))


@register("F5_drop_non_product")
def drop_non_product(spark, folder):
    return _lines(cleaning.drop_non_product(star_transactions(spark, folder)))


@register("F6_line_revenue")
def line_revenue(spark, folder):
    lines = cleaning.line_revenue(star_transactions(spark, folder))
    return lines.select("InvoiceNo", "StockCode", "Quantity", F.col("Revenue").cast("double").alias("Revenue"))


@register("F7_clean_transactions")
def clean_transactions(spark, folder):
    return _lines(inputs.clean(spark, folder), "Revenue")


@register("F8_cleaning_audit")
def cleaning_audit(spark, folder):
    return cleaning.cleaning_audit(star_transactions(spark, folder))


@register("F9_segment_country_filter")
def segment_country_filter(spark, folder):
    lines = inputs.clean(spark, folder)
    customers = rfm.assign_segments(rfm.score_rfm(rfm.compute_rfm(lines))).join(
        dashboard.home_country(lines), CUSTOMER
    )
    kept = dashboard.segment_country_filter(
        customers, ["Champions", "At Risk", "Lost"], ["NATION_0", "NATION_7", "NATION_12", "NATION_23"]
    )
    return kept.select(CUSTOMER, "Segment", "Country")


@register("F10_feature_matrix")
def feature_matrix(spark, folder):
    wanted = ["total_orders", "unique_products", "customer_age_days", "product_diversity_ratio", "not_there"]
    matrix = features.feature_matrix(inputs.all_features(spark, folder), wanted)
    return rounded(matrix, {6: "total_orders unique_products customer_age_days product_diversity_ratio"})


@register("F11_label_segment")
def label_segment(spark, folder):
    return inputs.segmented(spark, folder).select(CUSTOMER, "R_Score", "F_Score", "Segment")


# --- joins ------------------------------------------------------------------


@register("J1_features_with_labels")
def features_with_labels(spark, folder):
    lines = inputs.clean(spark, folder)
    joined = churn.features_with_labels(rfm.compute_rfm(lines), churn.churn_labels(lines))
    return rounded(joined, {2: "Monetary"})


@register("J3_customer_features")
def customer_features(spark, folder):
    return rounded(inputs.all_features(spark, folder), {2: "Monetary", 4: LARGE_FEATURES, 6: SMALL_FEATURES})


@register("J5_customer_360")
def customer_360(spark, folder):
    return rounded(inputs.customer_360(spark, folder), {2: "Monetary"})


# --- aggregations -----------------------------------------------------------


@register("A1_compute_rfm")
def compute_rfm(spark, folder):
    return rounded(inputs.customer_rfm(spark, folder), {2: "Monetary"})


@register("A1_compute_rfm_hours")
def compute_rfm_hours(spark, folder):
    lines = cleaning.line_revenue(event_transactions(spark, folder))
    return rounded(rfm.compute_rfm(lines, datetime(2024, 2, 15)), {2: "Monetary"})


@register("A2_order_values")
def order_values(spark, folder):
    return rounded(features.order_values(inputs.clean(spark, folder)), {4: "avg_order_value std_order_value"})


@register("A3_behavioral_features")
def behavioral_features(spark, folder):
    made = features.behavioral_features(inputs.clean(spark, folder))
    return rounded(made, {4: LARGE_FEATURES, 6: SMALL_FEATURES})


@register("A4_summarize_segments")
def summarize_segments(spark, folder):
    return segments.summarize_segments(inputs.segmented(spark, folder))


@register("A5_dashboard_segment_table")
def dashboard_segment_table(spark, folder):
    return segments.dashboard_segment_table(inputs.segmented(spark, folder))


@register("A6_segment_counts")
def segment_counts(spark, folder):
    return segments.segment_counts(inputs.segmented(spark, folder))


@register("A7_segment_revenue")
def segment_revenue(spark, folder):
    return rounded(segments.segment_revenue(inputs.segmented(spark, folder)), {2: "Monetary"})


@register("A8_ltv_by_segment")
def ltv_by_segment(spark, folder):
    return segments.ltv_by_segment(inputs.with_rule_scores(inputs.segmented(spark, folder)))


@register("A9_ltv_tier_summary")
def ltv_tier_summary(spark, folder):
    return ltv.ltv_tier_summary(ltv.quantile_tiers(inputs.rule_scores(spark, folder)))


@register("A10_overview_kpis")
def overview_kpis(spark, folder):
    kpis = dashboard.overview_kpis(inputs.with_rule_scores(inputs.segmented(spark, folder)))
    return rounded(kpis, {2: "total_revenue", 4: "avg_ltv", 6: "avg_churn"})


@register("A11_rfm_heatmap")
def rfm_heatmap(spark, folder):
    scored = rfm.score_rfm(inputs.customer_rfm(spark, folder))
    return rounded(segments.rfm_heatmap(scored), {4: "F1 F2 F3 F4 F5"})


@register("A12_ltv_describe")
def ltv_describe(spark, folder):
    return ltv.ltv_describe(inputs.rule_scores(spark, folder), "Predicted_LTV")


@register("A13_churn_rate")
def churn_rate(spark, folder):
    return rounded(churn.churn_rate(churn.churn_labels(inputs.clean(spark, folder))), {6: "churn_rate"})


@register("A14_churn_labels")
def churn_labels(spark, folder):
    return churn.churn_labels(inputs.clean(spark, folder))


@register("A15_churn_tier_counts")
def churn_tier_counts(spark, folder):
    return churn.churn_tier_counts(churn.with_churn_scores(inputs.rule_scores(spark, folder)))


@register("A16_ltv_tier_counts")
def ltv_tier_counts(spark, folder):
    return ltv.ltv_tier_counts(ltv.quantile_tiers(inputs.rule_scores(spark, folder)))


def _given_clusters(spark, folder):
    frequency = F.col("Frequency")
    return inputs.customer_rfm(spark, folder).withColumns(
        {
            "KMeans_Cluster": (frequency % 5).cast("int"),
            "DBSCAN_Cluster": (frequency % 7 - 1).cast("int"),
        }
    )


@register("A17_cluster_summary")
def cluster_summary(spark, folder):
    return rounded(clustering.cluster_summary(_given_clusters(spark, folder)), {4: "Recency Frequency Monetary"})


@register("A18_dbscan_counts")
def dbscan_counts(spark, folder):
    return clustering.dbscan_counts(_given_clusters(spark, folder))


@register("A19_ltv_histogram")
def ltv_histogram(spark, folder):
    counts = dashboard.histogram(inputs.rule_scores(spark, folder), "Predicted_LTV", 40)
    return rounded(counts, {4: "bin_start"})


@register("A19_churn_histogram")
def churn_histogram(spark, folder):
    scores = churn.with_churn_scores(inputs.rule_scores(spark, folder))
    counts = dashboard.histogram(scores, "Churn_Probability", 50, ["Churn_Risk_Tier"])
    return rounded(counts, {6: "bin_start"})


# --- ranks and bins ---------------------------------------------------------


@register("W1_global_rank")
def global_rank(spark, folder):
    ranked = ranking.global_rank(inputs.customer_rfm(spark, folder), ["Frequency", CUSTOMER], "F_Rank")
    return ranking.global_rank(ranked, ["Monetary", CUSTOMER], "M_Rank").select(CUSTOMER, "F_Rank", "M_Rank")


@register("W2_quantile_bin_rank")
def quantile_bin_rank(spark, folder):
    binned = rfm.quantile_bin_rank(inputs.customer_rfm(spark, folder), "Frequency", "F_Score", 7)
    return binned.select(CUSTOMER, "Frequency", "F_Score")


@register("W3_quantile_bin_value")
def quantile_bin_value(spark, folder):
    binned = rfm.quantile_bin_value(inputs.customer_rfm(spark, folder), "Recency", "R_Score", reverse=True)
    return binned.select(CUSTOMER, "Recency", "R_Score")


@register("W4_score_rfm")
def score_rfm(spark, folder):
    return rounded(rfm.score_rfm(inputs.customer_rfm(spark, folder)), {2: "Monetary"})


@register("W5_cluster_rank")
def cluster_rank(spark, folder):
    summary = clustering.cluster_summary(_given_clusters(spark, folder))
    coarse = summary.withColumn("Monetary", F.floor(F.col("Monetary") / 20000.0))
    return clustering.cluster_rank(coarse)


@register("J2_cluster_rank_lookup")
def cluster_rank_lookup(spark, folder):
    """Ranks of all given clusters but one, looked up for every customer."""
    given = _given_clusters(spark, folder)
    ranks = clustering.cluster_rank(clustering.cluster_summary(given)).filter("KMeans_Cluster <> 3")
    return clustering.with_cluster_rank(given, ranks).select(CUSTOMER, "KMeans_Cluster", "Cluster_Rank")


@register("W8_fixed_bins")
def fixed_bins(spark, folder):
    scores = churn.with_churn_scores(inputs.rule_scores(spark, folder))
    return scores.select(CUSTOMER, "Churn_Probability", "Churn_Risk_Tier")


@register("W9_quantile_tiers")
def quantile_tiers(spark, folder):
    return ltv.quantile_tiers(inputs.rule_scores(spark, folder)).select(CUSTOMER, "Predicted_LTV", "LTV_Tier")


@register("W10_share_of_total")
def share_of_total(spark, folder):
    shares = segments.share_of_total(inputs.segmented(spark, folder), "Segment", "Monetary")
    return rounded(shares, {6: "share"})


@register("W11_threshold_flag")
def threshold_flag(spark, folder):
    scores = churn.with_churn_scores(inputs.rule_scores(spark, folder))
    return scores.select(CUSTOMER, "Churn_Probability", "Churn_Predicted")


@register("T1_top_at_risk")
def top_at_risk(spark, folder):
    customers = churn.with_churn_scores(inputs.with_rule_scores(inputs.segmented(spark, folder)))
    return rounded(churn.top_at_risk(customers), {2: "Monetary"})


@register("T5_best_model")
def best_model(spark, folder):
    """Churn rate by country as a leaderboard."""
    lines = inputs.clean(spark, folder)
    board = (
        dashboard.home_country(lines)
        .join(churn.churn_labels(lines), CUSTOMER)
        .groupBy(F.col("Country").alias("model"))
        .agg(F.avg("Churned").alias("auc_roc"))
        .withColumn("position", F.row_number().over(Window.orderBy("model")))
    )
    return rounded(metrics.best_model(board, "auc_roc", True).select("model", "auc_roc"), {6: "auc_roc"})


# --- scaling and cohorts ----------------------------------------------------


@register("C1_standardize")
def standardize(spark, folder):
    return rounded(clustering.standardize(inputs.customer_rfm(spark, folder)), {6: "Recency Frequency Monetary"})


@register("R1_cohort_assign")
def cohort_assign(spark, folder):
    return rounded(cohorts.cohort_assign(inputs.clean(spark, folder)), {2: "Revenue"})


@register("R2_cohort_retention")
def cohort_retention(spark, folder):
    return rounded(cohorts.cohort_retention(inputs.clean(spark, folder)), {6: "Retention"})


@register("R3_retention_matrix")
def retention_matrix(spark, folder):
    months = " ".join(f"Month_{p}" for p in range(cohorts.PERIODS))
    return rounded(cohorts.retention_matrix(inputs.clean(spark, folder)), {6: months})


@register("R4_cohort_revenue")
def cohort_revenue(spark, folder):
    revenue = cohorts.cohort_revenue(inputs.clean(spark, folder))
    return rounded(revenue, {2: "Revenue CumulativeRevenue", 4: "CumulativePerCustomer"})


@register("R5_engagement_curve")
def engagement_curve(spark, folder):
    return rounded(cohorts.engagement_curve(inputs.clean(spark, folder)), {6: "Retention OrdersPerActive"})


# --- model inputs, metrics and scores ---------------------------------------


@register("M1_ltv_dataset")
def ltv_dataset(spark, folder):
    data = ltv.ltv_dataset(inputs.all_features(spark, folder))
    large = "avg_order_value std_order_value avg_unit_price max_unit_price revenue_per_item"
    return rounded(data, {4: large, 6: "y " + SMALL_FEATURES})


@register("M2_churn_dataset")
def churn_dataset(spark, folder):
    lines = inputs.clean(spark, folder)
    data = churn.churn_dataset(features.customer_features(lines, 90))
    small = "avg_days_between_orders purchase_frequency_per_month product_diversity_ratio"
    return rounded(data, {4: "Monetary avg_order_value std_order_value", 6: small})


@register("M5_regression_metrics")
def regression_metrics(spark, folder):
    return rounded(metrics.regression_metrics(inputs.value_predictions(spark, folder)), {6: "rmse mae r2"})


@register("M7_classification_report")
def classification_report(spark, folder):
    report = metrics.classification_report(inputs.labelled_scores(spark, folder))
    return rounded(report, {6: "precision recall f1_score"})


@register("M8_roc_auc")
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(inputs.labelled_scores(spark, folder)), {6: "roc_auc"})


@register("M9_average_precision")
def average_precision(spark, folder):
    return rounded(metrics.average_precision(inputs.labelled_scores(spark, folder)), {6: "avg_precision"})


@register("M10_roc_points")
def roc_points(spark, folder):
    return rounded(metrics.roc_points(inputs.labelled_scores(spark, folder)), {6: "fpr tpr"})


@register("M11_pr_points")
def pr_points(spark, folder):
    return rounded(metrics.pr_points(inputs.labelled_scores(spark, folder)), {6: "precision recall"})


@register("M12_tune_threshold")
def tune_threshold(spark, folder):
    return rounded(metrics.tune_threshold(inputs.labelled_scores(spark, folder)), {6: "precision recall"})


@register("M13_score_churn")
def score_churn(spark, folder):
    scores = churn.with_churn_scores(inputs.rule_scores(spark, folder))
    return scores.select(CUSTOMER, "Churn_Probability", "Churn_Predicted", "Churn_Risk_Tier")


@register("M14_score_ltv")
def score_ltv(spark, folder):
    logs = inputs.rule_scores(spark, folder).select(CUSTOMER, F.log1p("Predicted_LTV").alias("Predicted_LTV_Log"))
    return rounded(ltv.with_ltv_scores(logs), {4: "Predicted_LTV", 6: "Predicted_LTV_Log"})


# --- documented extras ------------------------------------------------------


@register("B1_interpurchase_variance")
def interpurchase_variance(spark, folder):
    gaps = features.interpurchase_variance(inputs.clean(spark, folder))
    return rounded(gaps, {4: "var_gap_days", 6: "mean_gap_days cv_gap_days"})


@register("B2_basket_stats")
def basket_stats(spark, folder):
    return rounded(
        features.basket_stats(inputs.clean(spark, folder)), {6: "avg_items std_items avg_lines std_lines"}
    )


@register("B3_category_affinity")
def category_affinity(spark, folder):
    return rounded(features.category_affinity(inputs.clean(spark, folder)), {6: "top_share category_entropy"})


@register("B4_channel_mix")
def channel_mix(spark, folder):
    lines = inputs.clean(spark, folder, marketing=True)
    return rounded(features.channel_mix(lines, "Channel"), {6: "revenue_share order_share"})


@register("B5_promo_sensitivity")
def promo_sensitivity(spark, folder):
    lines = inputs.clean(spark, folder, marketing=True)
    return rounded(features.promo_sensitivity(lines, "Offer"), {6: "revenue_share order_share"})


# --- clusters ---------------------------------------------------------------


@register("C2_kmeans_segments")
def kmeans_segments(spark, folder):
    clustered, _ = clustering.kmeans_segments(inputs.customer_rfm(spark, folder))
    return clustered


@register("C3_optimal_k")
def optimal_k(spark, folder):
    return clustering.optimal_k(clustering.silhouette_by_k(inputs.customer_rfm(spark, folder)))


@register("C3_silhouette_given")
def silhouette_given(spark, folder):
    """Silhouette of given clusters, all pairs of customers."""
    z = [f"{c}_z" for c in RFM]
    scaled = clustering.standardize(_given_clusters(spark, folder), RFM, "_z")
    found = euclidean_silhouette(scaled, F.array(*z), "KMeans_Cluster", CUSTOMER)
    return spark.createDataFrame([(round(found.value, 6), found.error)], "silhouette double, error double")


@register("C5_gmm_soft")
def gmm_soft(spark, folder):
    scored, quality = clustering.gmm_soft(inputs.customer_rfm(spark, folder))
    return scored.select(
        CUSTOMER, "GMM_Cluster", "GMM_Max_Prob", F.lit(quality["bic"]).alias("BIC"), F.lit(quality["aic"]).alias("AIC")
    )


@register("C6_pca_projection")
def pca_projection(spark, folder):
    projected, shares = clustering.pca_projection(inputs.customer_rfm(spark, folder))
    return projected.select(
        CUSTOMER, "PC1", "PC2", *[F.lit(s).alias(f"variance_share_{i + 1}") for i, s in enumerate(shares)]
    )


# --- buy-till-you-die value -------------------------------------------------

BGNBD_SCALED = {"r": 1.2, "alpha": 0.2, "a": 0.8, "b": 3.0}
GAMMA_GAMMA_SCALED = {"p": 6.0, "q": 4.0, "v": 0.15}
BGNBD_FIXED = {"r": 1.2, "alpha": 200.0, "a": 0.8, "b": 3.0}
GAMMA_GAMMA_FIXED = {"p": 6.0, "q": 4.0, "v": 15000.0}


def _summary(spark, folder):
    return buytilldie.rfm_t_summary(inputs.clean(spark, folder))


@register("L1_rfm_t_summary")
def rfm_t_summary(spark, folder):
    return rounded(_summary(spark, folder), {4: "monetary_value"})


@register("L2_returning_customers")
def returning_customers(spark, folder):
    return rounded(buytilldie.returning_customers(_summary(spark, folder)), {4: "monetary_value"})


@register("L3_bgnbd_loglik")
def bgnbd_loglik(spark, folder):
    scored = buytilldie.bgnbd_loglik(buytilldie.bgnbd_input(_summary(spark, folder)), [BGNBD_FIXED])
    return scored.agg(F.round(F.sum("loglik"), 4).alias("loglik"), F.count(F.lit(1)).alias("customers"))


def _mean_gradient(each):
    """One row per first and second derivative of the mean log-likelihood by one parameter."""
    names = [c for c in each.columns if c[:2] == "g_" or (c[:2] == "h_" and len({*c.split("_")[1:]}) == 1)]
    means = each.agg(*[F.avg(c).alias(c) for c in names])
    return means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.round(c, 4).alias("value")) for c in names])))


@register("L4_bgnbd_derivatives")
def bgnbd_derivatives(spark, folder):
    return _mean_gradient(buytilldie.bgnbd_derivatives(buytilldie.bgnbd_input(_summary(spark, folder), 0.001), BGNBD_SCALED))


@register("L5_gamma_gamma_derivatives")
def gamma_gamma_derivatives(spark, folder):
    returning = buytilldie.gamma_gamma_input(_summary(spark, folder)).withColumn("m", F.col("m") / 100000)
    return _mean_gradient(buytilldie.gamma_gamma_derivatives(returning, GAMMA_GAMMA_SCALED))


@register("L4_fit_bgnbd")
def fit_bgnbd(spark, folder):
    return _fit_rows(spark, buytilldie.fit_bgnbd(_summary(spark, folder)))


@register("L5_gamma_gamma_loglik")
def gamma_gamma_loglik(spark, folder):
    returning = buytilldie.gamma_gamma_input(_summary(spark, folder))
    scored = buytilldie.gamma_gamma_loglik(returning, [GAMMA_GAMMA_FIXED])
    return scored.agg(F.round(F.sum("loglik"), 4).alias("loglik"), F.count(F.lit(1)).alias("customers"))


@register("L5_fit_gamma_gamma")
def fit_gamma_gamma(spark, folder):
    return _fit_rows(spark, buytilldie.fit_gamma_gamma(_summary(spark, folder)))


def _fit_rows(spark, fit):
    rows = [(k, float(v), fit.converged) for k, v in {**fit.params, "log_likelihood": fit.log_likelihood}.items()]
    return spark.createDataFrame(rows, "name string, value double, converged boolean")


@register("L6_expected_purchases")
def expected_purchases(spark, folder):
    scored = buytilldie.with_expected_purchases(_summary(spark, folder), BGNBD_FIXED)
    return rounded(scored.select(CUSTOMER, "predicted_purchases_12m"), {6: "predicted_purchases_12m"})


@register("L7_expected_avg_profit")
def expected_avg_profit(spark, folder):
    profit = buytilldie.expected_avg_profit(F.col("frequency"), F.col("monetary_value"), GAMMA_GAMMA_FIXED)
    return _summary(spark, folder).select(CUSTOMER, F.round(profit, 4).alias("expected_avg_profit"))


@register("L8_ltv_12m")
def ltv_12m(spark, folder):
    scored = buytilldie.with_lifetime_value(_summary(spark, folder), BGNBD_FIXED, GAMMA_GAMMA_FIXED)
    return rounded(scored.select(CUSTOMER, "LTV_12m"), {4: "LTV_12m"})


@register("A12_ltv_describe_12m")
def ltv_describe_12m(spark, folder):
    return ltv.ltv_describe(materialize(ltv_12m(spark, folder)))


@register("L8_lifetime_value_fitted")
def lifetime_value_fitted(spark, folder):
    return buytilldie.lifetime_value(inputs.clean(spark, folder))[0]


# --- models -----------------------------------------------------------------


def _split_sides(train, test):
    return train.select(CUSTOMER, F.lit(0).alias("is_test")).unionByName(test.select(CUSTOMER, F.lit(1).alias("is_test")))


@register("W6_random_split")
def random_split(spark, folder):
    return _split_sides(*splits.random_split(inputs.customer_rfm(spark, folder)))


@register("W7_stratified_split")
def stratified_split(spark, folder):
    return _split_sides(*splits.stratified_split(churn.churn_labels(inputs.clean(spark, folder)), "Churned"))


def _ltv_model(name):
    def query(spark, folder):
        return lifetime.fit_value_models(inputs.all_features(spark, folder), (name,)).predictions

    return query


def _churn_model(name):
    def query(spark, folder):
        return retention.fit_churn_models(inputs.clean(spark, folder), names=(name,)).predictions

    return query


register("M3a_ltv_ridge")(_ltv_model("Ridge"))
register("M3b_ltv_random_forest")(_ltv_model("RandomForest"))
register("M3c_ltv_gradient_boosting")(_ltv_model("GradientBoosting"))
register("M3d_ltv_boosted_sampled")(_ltv_model("SampledBoosting"))
register("M4a_churn_logistic")(_churn_model("LogisticRegression"))
register("M4b_churn_random_forest")(_churn_model("RandomForest"))
register("M4c_churn_boosted")(_churn_model("SampledBoosting"))


@register("M6_ltv_leaderboard")
def ltv_leaderboard(spark, folder):
    return lifetime.fit_value_models(inputs.all_features(spark, folder)).leaderboard


@register("M6_churn_leaderboard")
def churn_leaderboard(spark, folder):
    return retention.fit_churn_models(inputs.clean(spark, folder)).leaderboard


@register("M13_risk_tiers_fitted")
def risk_tiers_fitted(spark, folder):
    lines = inputs.clean(spark, folder)
    training = retention.fit_churn_models(lines)
    scored = retention.risk_tiers(features.customer_features(lines), training)
    return scored.select(CUSTOMER, "Churn_Probability", "Churn_Predicted", "Churn_Risk_Tier")


@register("M14_value_tiers_fitted")
def value_tiers_fitted(spark, folder):
    made = inputs.all_features(spark, folder)
    training = lifetime.fit_value_models(made)
    scored = lifetime.value_tiers(made, training)
    return scored.select(CUSTOMER, "Predicted_LTV_Log", "Predicted_LTV", "LTV_Tier")


@register("M15_feature_importance")
def feature_importance(spark, folder):
    training = lifetime.fit_value_models(inputs.all_features(spark, folder), ("RandomForest",))
    return importance.feature_importance(spark, training.models["RandomForest"])


@register("M16_feature_attribution")
def feature_attribution(spark, folder):
    lines = inputs.clean(spark, folder)
    training = retention.fit_churn_models(lines, names=("RandomForest",))
    data = churn.churn_dataset(features.customer_features(lines, 90))
    return importance.feature_attribution(data, training.models["RandomForest"])


#: Two trees on recency, frequency and monetary value, as (feature, threshold, left, right, value, training rows).
FIXED_TREES = (
    ((0, 60.0, 1, 4, 0.0, 100.0), (1, 3.0, 2, 3, 0.0, 40.0), (-1, 0.0, -1, -1, 0.3, 25.0), (-1, 0.0, -1, -1, 0.1, 15.0),
     (2, 500000.0, 5, 6, 0.0, 60.0), (-1, 0.0, -1, -1, 0.9, 45.0), (0, 200.0, 7, 8, 0.0, 15.0),
     (-1, 0.0, -1, -1, 0.4, 9.0), (-1, 0.0, -1, -1, 0.8, 6.0)),
    ((1, 5.0, 1, 2, 0.0, 80.0), (-1, 0.0, -1, -1, 0.25, 60.0), (-1, 0.0, -1, -1, -0.5, 20.0)),
)


@register("M16_shap_fixed_trees")
def shap_fixed_trees(spark, folder):
    trees = [attribution.Tree.of(nodes) for nodes in FIXED_TREES]
    names = ["Recency", "Frequency", "Monetary"]
    values = attribution.shap_of_trees(inputs.customer_rfm(spark, folder), trees, names)
    return rounded(values, {6: "base_value margin shap_Recency shap_Frequency shap_Monetary"})


@register("T2_top_features_given")
def top_features_given(spark, folder):
    """The two inputs that move the margin of the fixed trees most."""
    trees = [attribution.Tree.of(nodes) for nodes in FIXED_TREES]
    values = attribution.shap_of_trees(inputs.customer_rfm(spark, folder), trees, RFM)
    return rounded(attribution.shap_importance(values, top=2), {4: "mean_abs_shap"})


@register("M16_shap_importance")
def shap_importance(spark, folder):
    """The 15 inputs that move the fitted forest's churn probability most."""
    lines = inputs.clean(spark, folder)
    training = retention.fit_churn_models(lines, names=("RandomForest",))
    data = churn.churn_dataset(features.customer_features(lines, 90))
    return attribution.shap_importance(attribution.shap_values(data, training.models["RandomForest"]))


@register("S4_run_log")
def run_log(spark, folder):
    log = runlog.RunLog(spark, scratch_path(spark, "runs"))
    log.append_frame(
        runlog.experiment_name("segmentation"), "profile", "param",
        transactions.dataset_profile(star_transactions(spark, folder)),
    )
    board = metrics.ranking_metrics(inputs.labelled_scores(spark, folder))
    log.append_frame(runlog.experiment_name("churn"), "rule", "metric", rounded(board, {4: "auc_roc avg_precision"}))
    return log.read()


@register("S5_model_artifact")
def model_artifact(spark, folder):
    """Predictions of the best model after it was saved and read back."""
    made = inputs.all_features(spark, folder)
    training = lifetime.fit_value_models(made)
    path = scratch_path(spark, "model")
    runlog.save_model(training.models[training.best], path)
    scored = estimators.predict_ltv_segments(made, runlog.load_model(path))
    return scored.select(CUSTOMER, "Predicted_LTV_Log", "LTV_Tier")


@register("C4_dbscan_core")
def dbscan_core(spark, folder):
    return density.dbscan_core(inputs.customer_rfm(spark, folder)).select(CUSTOMER, "Is_Core")


@register("C4_dbscan_outliers")
def dbscan_outliers(spark, folder):
    return density.dbscan_outliers(inputs.customer_rfm(spark, folder)).select(CUSTOMER, "DBSCAN_Cluster")


PROFILE = ["Recency", "Frequency", "Monetary", "avg_order_value", "unique_products", "avg_unit_price"]


@register("C4_dbscan_profile")
def dbscan_profile(spark, folder):
    """Clusters on six features, more than a cell can list its neighbours for."""
    found = density.dbscan_outliers(inputs.all_features(spark, folder), features=PROFILE)
    return found.select(CUSTOMER, "DBSCAN_Cluster")
