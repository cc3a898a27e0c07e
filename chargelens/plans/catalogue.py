"""Every registered query as a callable (spark, folder of the test tables) -> DataFrame."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expressions import risk_bucket
from ..operators import (analyst, cost, evaluation, explain, features, models, ordered, profile, quality,
                         scoring)
from ..schemas import FEATURES_NUM, ORDER, TEST_FRACTION
from ..sources import artifacts
from ..sources import driver_views as views
from ..sources import tables as sources
from ..storage import materialize, new_path
from . import explaining, rule_forest, suite, training
from . import scoring as job

HOUR = 3600


def _txns(spark, d):
    return views.transactions(spark, d)


def _features(spark, d):
    return features.build_features(views.transactions(spark, d, gaps=True),
                                   views.customer_spend(spark, d))


def _split(df):
    return ordered.temporal_split(df, TEST_FRACTION)


# ------------------------------------------------------------ small wrappers

def _spend_anomalies(spark, d):
    return analyst.spend_anomalies(_txns(spark, d), views.customer_spend(spark, d))


def _join_customer_norm(spark, d):
    return features.join_customer_norm(
        _txns(spark, d).select("transaction_id", "customer_id", "amount"),
        views.customer_spend(spark, d))


def _denormalise_merchant(spark, d):
    return features.denormalise_merchant(
        views.events(spark, d).drop("props"), views.merchants(spark, d))


def _amount_norm(spark, d):
    return _join_customer_norm(spark, d).select(
        "transaction_id", F.round(features.amount_norm(), 6).alias("amount_vs_customer_norm"))


def _log_amount(spark, d):
    return (features.log_amount(_txns(spark, d).select("transaction_id", "amount"))
            .withColumn("amount", F.round("amount", 9)))


def _build_features(spark, d):
    return _features(spark, d).withColumn(
        "amount_vs_customer_norm", F.round("amount_vs_customer_norm", 6))


def _scaled_features(spark, d):
    full = materialize(_features(spark, d).select(*ORDER, *FEATURES_NUM))    # read three times below
    train, _, _ = _split(full)
    inputs, _ = models.fit_inputs(train, FEATURES_NUM)                       # the stages that training fits
    return inputs.transform(full).select("transaction_id", *[
        F.round(f"{c}_z", 5).alias(f"{c}_z") for c in FEATURES_NUM])


def _one_hot_category(spark, d):
    txns = materialize(_txns(spark, d).select(*ORDER, "category", "amount"))
    train, _, _ = _split(txns)
    inputs, names = models.fit_inputs(train, ["amount"], "category")
    slots = vector_to_array("_category_slots")
    return inputs.transform(txns).select("transaction_id", "category", *[
        slots[i].cast("int").alias(name) for i, name in enumerate(names[1:])])


def _landed(spark, frame, fmt):
    """Where the frame was written as a file of that format, for the scans to read."""
    path = new_path(spark, "landing")
    if fmt == "csv":
        sources.write_csv(frame, path)
    else:
        frame.write.format(fmt).save(path)
    return path


def _scan_transactions_csv(spark, d):
    """Text to timestamps and numbers."""
    return sources.scan_transactions(spark, _landed(spark, views.transactions(spark, d, gaps=True), "csv"), "csv")


def _loaded(spark, d):
    """The tables after a full refresh of an older load."""
    folder = new_path(spark, "warehouse")
    old = views.tables(spark, d, gaps=True)
    sources.load_tables({n: t.limit(1) for n, t in old.items()}, folder)
    sources.load_tables(old, folder)
    return sources.open_tables(spark, folder)


def _run_sql(spark, d):
    """One SQL text over the registered tables."""
    sources.register_views(views.tables(spark, d))
    return sources.run_sql(spark, "SELECT home_city, count(*) AS txns, max(amount) AS largest "
                                  "FROM transactions JOIN customers USING (customer_id) GROUP BY home_city")


def _flagged_csv(spark, d):
    """The file of flagged rows, read back; its lines are in order of the score."""
    path = new_path(spark, "flagged")
    job.write_flagged(_rule_flags(spark, d), path)
    lines = spark.read.schema("transaction_id bigint, customer_id bigint, category string, amount double, "
                              "timestamp timestamp_ntz, fraud_score double").option("header", True).csv(path)
    place = F.struct(F.input_file_name(), F.monotonically_increasing_id())
    before = F.lag("fraud_score").over(Window.partitionBy(F.input_file_name()).orderBy(place))
    return lines.withColumn("in_order", F.coalesce(before >= F.col("fraud_score"), F.lit(True)))


def _metrics_json(spark, d):
    """Metrics written as JSON and read back."""
    path = new_path(spark, "metrics")
    sources.write_json(evaluation.binary_metrics(views.rule_scored(spark, d)), path)
    return spark.read.schema("precision double, recall double, f1 double, tn bigint, fp bigint, fn bigint, tp bigint").json(path)


def _importances_json(spark, d):
    """The map of importances, written as JSON and read back, a row a feature."""
    path = new_path(spark, "importances")
    explaining.write_importances(rule_forest.ranking(_rules(spark, d)), path)
    return spark.read.schema("importances map<string,double>").json(path).select(
        F.explode("importances").alias("feature", "importance"))


def _wide_features(spark, d):
    """The inputs of the wide model: all columns but the label and the order key."""
    ready = features.log_amount(views.wide(spark, d), "amount")
    layout = training.wide_layout(ready, ["vec_id"], "class", "amount")
    return ready.select("vec_id", F.size(F.array(*layout.numeric)).alias("inputs"),
                        F.round(sum(F.col(c) for c in layout.numeric), 4).alias("total"))


def _scan_transactions(spark, d):
    return sources.scan_transactions(spark, _landed(spark, views.transactions(spark, d, gaps=True), "parquet"))


def _class_weights(spark, d):
    train, _, _ = _split(_txns(spark, d))
    return features.class_weights(train)


def _temporal_split(spark, d):
    events = views.events(spark, d).select(*ORDER)
    point = ordered.split_point(events, TEST_FRACTION)
    return events.select(
        "transaction_id", F.when(ordered.before(point), "train").otherwise("test").alias("part"),
        F.lit(str(point[0])).cast("timestamp_ntz").alias("split_ts"))


def _temporal_split_double(spark, d):
    """Split by a fractional key, with the id as tie-break."""
    order = ["amount", "transaction_id"]
    events = views.events(spark, d).select(*order)
    point = ordered.split_point(events, TEST_FRACTION, order)
    return events.select("transaction_id", "amount", F.when(ordered.before(point, order), "train").otherwise("test").alias("part"),
                         F.lit(point[0]).alias("split_at"))


DRAWN = 2_000       # bound of the registered draw


def _training_weights(spark, d):
    """The rows that a fit of at most DRAWN rows reads, with their weights."""
    txns = _txns(spark, d).select(*ORDER, "amount", "is_fraud")
    train, _, _ = _split(txns)
    classes = features.training_statistics(train, "is_fraud", ["amount"])[0]
    drawn = features.balanced_draw(train, "is_fraud", classes, ORDER, DRAWN)
    return drawn.select("transaction_id", "is_fraud", F.round("weight", 9).alias("weight"))


def _assign_ids(spark, d):
    return features.assign_ids_by_time(
        views.events(spark, d).select("timestamp", F.col("transaction_id").alias("event_id"),
                                      "customer_id", "amount"), "event_id")


def _risk_bucket(spark, d):
    return _txns(spark, d).select("transaction_id", "merchant_risk_score",
                                  risk_bucket("merchant_risk_score").alias("risk_bucket"))


def _weekly_counts(spark, d):
    return analyst.weekly_counts(_txns(spark, d))


def _label_rate(spark, d):
    _, test, _ = _split(_txns(spark, d))
    return profile.label_rate(test)


def _wide_label_rate(spark, d):
    return profile.label_rate(views.wide(spark, d), "class", 5)


def _scan_wide(spark, d):
    path = _landed(spark, views.wide(spark, d), "csv")
    wide, _ = sources.scan_wide(spark, path, "vec_id", "class", "csv")
    return wide.select(
        "vec_id", *[F.round(c, 6).alias(c) for c in views.WIDE_FEATURES], "amount", "class")


def _pr_curve(spark, d):
    return evaluation.pr_curve(views.rule_scored(spark, d), places=4).select(
        "threshold", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


def _pr_curve_raw(spark, d):
    """Unrounded scores, so the running sums are distributed."""
    scored = views.rule_scored(spark, d).withColumn("score", F.col("amount"))
    return evaluation.pr_curve(scored).select(
        "threshold", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


def _rule_flags(spark, d, threshold=0.3):
    return scoring.flag(views.rule_scored(spark, d).withColumnRenamed("score", "fraud_score"), threshold)


def _predict_label(spark, d):
    return evaluation.predict_label(views.rule_scored(spark, d)).select(
        "transaction_id", "score", "predicted")


def _sweep(spark, d):
    return cost.threshold_sweep(views.rule_scored(spark, d))


def _keep_positives(spark, d):
    order = (F.col("transaction_id") % 1000003) * 7919 % 1000003
    return explain.keep_all_positive(_txns(spark, d).select("transaction_id", "is_fraud"), order=order)


def _not_null(spark, d):
    return quality.not_null_report(views.tables(spark, d, gaps=True))


def relational_queries():
    return {
        # sources
        "scan_transactions": _scan_transactions,
        "scan_customers": lambda s, d: sources.scan_customers(s, _landed(s, views.customers(s, d), "csv"), "csv"),
        "scan_merchants": lambda s, d: sources.scan_merchants(s, _landed(s, views.merchants(s, d), "csv"), "csv"),
        "scan_wide": _scan_wide,
        "scan_transactions_csv": _scan_transactions_csv,
        "loaded_transactions": lambda s, d: _loaded(s, d)["transactions"],
        "loaded_customers": lambda s, d: _loaded(s, d)["customers"],
        "run_sql": _run_sql,
        "flagged_csv": _flagged_csv,
        "metrics_json": _metrics_json,
        "load_counts": lambda s, d: sources.load_counts(s, views.tables(s, d)),
        "query_suite": lambda s, d: suite.suite_overview(views.tables(s, d)),
        # integrity
        "dq_not_null": _not_null,
        "dq_unique_key": lambda s, d: quality.unique_key_report(views.tables(s, d)),
        "dq_orphans": lambda s, d: quality.orphan_report(views.tables(s, d)),
        "dataset_profile": lambda s, d: quality.dataset_profile(views.transactions(s, d, gaps=True)),
        # filters and labels
        "fraud_only": lambda s, d: analyst.fraud_only(_txns(s, d)),
        "in_category_set": lambda s, d: analyst.in_category_set(_txns(s, d)),
        "risk_bucket": _risk_bucket,
        # joins
        "join_customer_norm": _join_customer_norm,
        "denormalise_merchant": _denormalise_merchant,
        # analyst questions
        "headline_fraud_rate": lambda s, d: analyst.headline_fraud_rate(_txns(s, d)),
        "fraud_rate_by_category": lambda s, d: analyst.fraud_rate_by_category(_txns(s, d)),
        "fraud_rate_by_hour": lambda s, d: analyst.fraud_rate_by_hour(_txns(s, d)),
        "top_fraud_customers": lambda s, d: analyst.top_fraud_customers(_txns(s, d), views.customers(s, d)),
        "weekly_counts": _weekly_counts,
        "weekly_trend": lambda s, d: analyst.weekly_trend(_txns(s, d)),
        "prev_txn_gap": lambda s, d: analyst.prev_txn_gap(_txns(s, d)),
        "card_testing_customers": lambda s, d: analyst.card_testing_customers(_txns(s, d)),
        "card_testing_customers_1h": lambda s, d: analyst.card_testing_customers(_txns(s, d), HOUR),
        "fraud_rate_by_risk_bucket": lambda s, d: analyst.fraud_rate_by_risk_bucket(_txns(s, d)),
        "spend_anomalies": _spend_anomalies,
        # exploration
        "eda_rate_by_category": lambda s, d: profile.rate_by_category(_txns(s, d)),
        "eda_rate_by_hour": lambda s, d: profile.rate_by_hour(_txns(s, d)),
        "amount_density": lambda s, d: profile.amount_density(_txns(s, d)),
        "label_rate": _label_rate,
        "wide_label_rate": _wide_label_rate,
        # features and order
        "seconds_since_prev": lambda s, d: features.seconds_since_prev(
            views.events(s, d).select("transaction_id", "customer_id", "timestamp")),
        "assign_ids_by_time": _assign_ids,
        "temporal_split": _temporal_split,
        "temporal_split_double_key": _temporal_split_double,
        "time_parts": lambda s, d: features.time_parts(
            views.events(s, d).select("transaction_id", "timestamp")),
        "amount_norm": _amount_norm,
        "log_amount": _log_amount,
        "build_features": _build_features,
        "scaled_features": _scaled_features,
        "one_hot_category": _one_hot_category,
        "class_weights": _class_weights,
        "training_weights": _training_weights,
        "wide_features": _wide_features,
        # evaluation of the rule score
        "predict_label": _predict_label,
        "confusion_matrix": lambda s, d: evaluation.confusion_matrix(views.rule_scored(s, d)),
        "binary_metrics": lambda s, d: evaluation.binary_metrics(views.rule_scored(s, d)),
        "classification_report": lambda s, d: evaluation.classification_report(views.rule_scored(s, d)),
        "pr_curve": _pr_curve,
        "pr_curve_raw_scores": _pr_curve_raw,
        "average_precision": lambda s, d: evaluation.average_precision(views.rule_scored(s, d), places=4),
        "cost_at": lambda s, d: cost.cost_at(views.rule_scored(s, d)),
        "threshold_sweep": _sweep,
        "cost_optimal": lambda s, d: cost.cost_optimal(_sweep(s, d)),
        "cost_reduction": lambda s, d: cost.cost_reduction(_sweep(s, d)),
        "flag_ranking": lambda s, d: scoring.flag_ranking(_rule_flags(s, d)),
        "flag_summary": lambda s, d: scoring.flag_summary(_rule_flags(s, d)),
        "top_scored_fraud": lambda s, d: scoring.top_scored_fraud(views.rule_scored(s, d)),
        "stratified_keep_all_positive": _keep_positives,
    }



# ------------------------------------------------------- queries that fit models

_fitted = {}


def _once(kind, spark, d, build):
    """Fit once per session and folder; later queries use the fitted run, as jobs use a saved model."""
    key = (kind, spark.sparkContext.applicationId, d)
    if key not in _fitted:
        _fitted[key] = build()
    return _fitted[key]


def _card_run(spark, d):
    return _once("cards", spark, d, lambda: training.train_cards(
        views.transactions(spark, d, gaps=True), views.customer_spend(spark, d)))


def _wide_run(spark, d):
    return _once("wide", spark, d, lambda: training.train_wide(
        views.wide(spark, d), ["vec_id"], "class", "amount"))


def _artifact(spark, d):
    """A saved and reopened model, as the scoring job finds it."""
    def build():
        folder = new_path(spark, "model")
        artifacts.save(training.to_artifact(_card_run(spark, d)), folder, spark)
        return folder
    return _once("artifact", spark, d, build)


def _explanation(spark, d):
    """All rows of the test window are explained."""
    return _once("explanation", spark, d, lambda: explaining.explain_run(_card_run(spark, d), size=None))


def _train_logistic(spark, d):
    run = _card_run(spark, d)
    rows = [(n, float(c)) for n, c in zip(run.feature_names, run.logistic.coefficients)]
    rows.append(("intercept", float(run.logistic.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def _train_forest(spark, d):
    nodes = explain.forest_nodes(_card_run(spark, d).forest, spark)
    return nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("nodes"),
                                     F.count_if(F.col("left") < 0).alias("leaves"))


def _predict_proba(spark, d):
    return _card_run(spark, d).scored.select("transaction_id", *training.MODELS)


def _scored(spark, d):
    """Scored once and written; the ranking and the summary read that."""
    return _once("scored", spark, d, lambda: materialize(job.score(
        spark, views.transactions(spark, d, gaps=True), views.customer_spend(spark, d),
        _artifact(spark, d))))


def _gini(spark, d):
    run = _card_run(spark, d)
    return models.gini_importance(explain.forest_nodes(run.forest, spark), run.feature_names)


def _explain_sample(spark, d):
    _, test, _ = _split(_txns(spark, d).select(*ORDER, "amount", "is_fraud"))
    order = (F.col("transaction_id") % 1000003) * 7919 % 1000003
    return explain.keep_all_positive(test, order=order)


def _breakdown(spark, d):
    leaves = _explanation(spark, d).leaves
    return explain.decision_breakdown(explaining.explain_top_fraud(_card_run(spark, d), leaves))


def _top_drivers(spark, d):
    leaves = _explanation(spark, d).leaves
    return explain.top_drivers(explaining.explain_top_fraud(_card_run(spark, d), leaves))


def model_queries():
    return {
        "train_logistic": _train_logistic,
        "train_forest": _train_forest,
        "predict_proba": _predict_proba,
        "model_comparison": lambda s, d: training.model_comparison(_card_run(s, d)),
        "model_pr_curves": lambda s, d: training.pr_curves(_card_run(s, d)),
        "model_threshold_sweep": lambda s, d: _card_run(s, d).sweep(),
        "model_reports": lambda s, d: training.model_reports(_card_run(s, d)),
        "metrics_document": lambda s, d: training.metrics_document(_card_run(s, d)),
        "wide_metrics_document": lambda s, d: training.metrics_document(
            _wide_run(s, d), source="embeddings (split on vec_id)"),
        "train_wide": lambda s, d: training.model_comparison(_wide_run(s, d)),
        "wide_threshold_sweep": lambda s, d: _wide_run(s, d).sweep(),
        "score_transactions": lambda s, d: job.ranked(_scored(s, d)),
        "score_summary": lambda s, d: scoring.flag_summary(_scored(s, d)),
        "gini_importance": _gini,
        "top_importances": lambda s, d: models.top(_gini(s, d), 12),
        "explain_sample": _explain_sample,
        "tree_contributions": lambda s, d: _explanation(s, d).contributions,
        "mean_abs_contribution": lambda s, d: _explanation(s, d).ranking,
        "contribution_points": lambda s, d: _explanation(s, d).points(),
        "decision_breakdown": _breakdown,
        "top_drivers": _top_drivers,
        "importance_overlap": lambda s, d: explain.importance_overlap(
            _explanation(s, d).ranking, _gini(s, d)),
    }


# ---------------- what SQL can check: explanations of a declared forest, the logistic solution

def _rules(spark, d):
    return _once("rules", spark, d, lambda: rule_forest.vectors(_txns(spark, d)))


def _rule_breakdown(spark, d):
    return explain.decision_breakdown(rule_forest.top_fraud(_rules(spark, d), _txns(spark, d)), 2).withColumn(
        "contribution", F.round("contribution", 8))


def _rule_proba(spark, d):
    return rule_forest.scored(_txns(spark, d)).select("transaction_id", F.round("fraud_score", 9).alias("fraud_score"))


DECLARED = ["rule_norm", "rule_forest"]


def _rule_counts(spark, d):
    """Two declared scores of every transaction as one table of counts."""
    forest = rule_forest.scored(_txns(spark, d)).select("transaction_id", F.round("fraud_score", 4).alias("rule_forest"))
    both = (views.rule_scored(spark, d).select("transaction_id", "is_fraud", F.col("score").alias("rule_norm"))
            .join(forest, "transaction_id"))
    return materialize(evaluation.count_scores(evaluation.stack_scores(both, DECLARED)))


def _rule_curves(spark, d):
    return evaluation.pr_curve(_rule_counts(spark, d), by=["model"], n="n").select(
        "model", "threshold", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


def rule_queries():
    return {
        "logistic_gradient": lambda s, d: training.logistic_gradient(_card_run(s, d)).withColumn(
            "gradient", F.round("gradient", 5)),
        "rule_predict_proba": _rule_proba,
        "rule_score_transactions": lambda s, d: job.ranked(rule_forest.flagged(_txns(s, d))),
        "rule_flag_summary": lambda s, d: scoring.flag_summary(rule_forest.flagged(_txns(s, d))),
        "rule_gini_importance": lambda s, d: rule_forest.importance(s).withColumn("importance", F.round("importance", 9)),
        "rule_top_importances": lambda s, d: models.top(rule_forest.importance(s), 2).select("feature"),
        "rule_model_comparison": lambda s, d: evaluation.compare_models(_rule_counts(s, d)),
        "rule_model_reports": lambda s, d: evaluation.classification_report(_rule_counts(s, d), by=["model"], n="n"),
        "rule_model_curves": _rule_curves,
        "rule_contributions": lambda s, d: rule_forest.contributions(_rules(s, d)),
        "rule_mean_contribution": lambda s, d: rule_forest.ranking(_rules(s, d)),
        "rule_contribution_points": lambda s, d: explain.contribution_points(
            _rules(s, d), rule_forest.FEATURES, rule_forest.ranking(_rules(s, d)), 2),
        "rule_top_drivers": lambda s, d: explain.top_drivers(
            rule_forest.top_fraud(_rules(s, d), _txns(s, d)), 2),
        "rule_decision_breakdown": _rule_breakdown,
        "rule_importance_overlap": lambda s, d: rule_forest.overlap(_rules(s, d), _txns(s, d)),
        "importances_json": _importances_json,
    }


# work that the queries above share, built once a session
SHARED = {"train_cards": _card_run, "train_wide": _wide_run, "save_model": _artifact, "score": _scored,
          "explain": _explanation, "rule_contributions": _rules}


def queries():
    return relational_queries() | model_queries() | rule_queries()
