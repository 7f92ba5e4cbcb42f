"""Queries of the relational operators: each takes (spark, sf_dir) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import name, to_number
from tidemark.operators import cleaning, correlation, curves, encoding, fairness
from tidemark.operators import profiling, sampling, scores, splitting
from tidemark.operators.features import engineer_features
from tidemark.roles import ACCOUNTS, ENGINEERED
from tidemark.session import work_path
from tidemark.sources import jsonl, keyed, predictions, tables
from tidemark.sources.views import accounts, score_log, scored_docs, scored_events, table
from tidemark.streaming import latest

Query = Callable[[SparkSession, str], DataFrame]

# Digits at which both engines are compared; their order of summation differs.
DIGITS = 6
THRESHOLD = 0.441


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(name(c), digits) for c in doubles})


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(accounts(spark, sf_dir), ACCOUNTS)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned accounts with the 0/1 label ``y``."""
    label = ACCOUNTS.label_column("string")
    return cleaned(spark, sf_dir).withColumn("y", label)


# Scans, sources and sinks


def load_csv(spark, sf_dir):
    source, target = work_path(spark, "csv"), work_path(spark, "table")
    view = accounts(spark, sf_dir)
    writer = view.write.option("header", True).option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(source)
    return tables.load_csv(spark, source, target, view.schema)


def load_table(spark, sf_dir):
    return tables.load_table(spark, f"{sf_dir}/customer.parquet")


def load_scoring(spark, sf_dir):
    target = work_path(spark, "scoring")
    accounts(spark, sf_dir).drop(ACCOUNTS.label).write.parquet(target)
    return tables.load_scoring(spark, target)


def seed_scoring(spark, sf_dir):
    view = accounts(spark, sf_dir)
    seeded = tables.seed_scoring(view, ACCOUNTS.id, ACCOUNTS.label, 500)
    today = F.col("as_of_date") == F.current_date()
    return seeded.withColumn("stamped_today", today).drop("as_of_date")


def write_predictions(spark, sf_dir):
    target = work_path(spark, "predictions")
    predictions.append_predictions(score_log(spark, sf_dir).withColumn("run_id", F.col("model")), target)
    read = predictions.read_predictions(spark, target)
    return read.withColumn("scored_at", F.col("scored_at").cast("timestamp_ntz"))


def latest_scores_stream(spark, sf_dir):
    """The latest scores of a log that arrives in about four batches."""
    source, target, progress = (work_path(spark, k) for k in ("arrivals", "latest", "progress"))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = score_log(spark, sf_dir)
    log.repartition(files).write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", max(1, files // 4)).parquet(source)
    latest.keep_latest(stream, target, progress, compact_every=2).awaitTermination()
    return latest.current_scores(spark, target).withColumn("scored_at", F.col("scored_at").cast("timestamp_ntz"))


def export_jsonl(spark, sf_dir):
    target = work_path(spark, "requests")
    jsonl.export_jsonl(accounts(spark, sf_dir), ACCOUNTS, target)
    fields = ", ".join(
        [f"{c}: double" for c in ACCOUNTS.numeric]
        + [f"{c}: string" for c in ACCOUNTS.categorical]
        + ["account_id: string"]
    )
    schema = f"instances array<struct<{fields}>>"
    lines = spark.read.text(target)
    parsed = lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select(F.explode("r.instances").alias("i")).select("i.*")


def _response_lines(spark, sf_dir):
    row = F.struct("account_id", "probability", "flag", "threshold")
    wrapped = F.to_json(F.struct(F.array(row, row).alias("predictions")))
    line = F.when(F.col("model") == "view", wrapped).otherwise(F.to_json(row))
    return score_log(spark, sf_dir).select(line.alias("value"))


def parse_jsonl(spark, sf_dir):
    return jsonl.parse_jsonl(_response_lines(spark, sf_dir), jsonl.response_item())


def load_batch_output(spark, sf_dir):
    target = work_path(spark, "responses")
    _response_lines(spark, sf_dir).write.text(target)
    return jsonl.load_batch_output(spark, target, pattern="*.txt")


def export_cache(spark, sf_dir):
    target = work_path(spark, "cache")
    jsonl.export_cache(score_log(spark, sf_dir), target)
    return jsonl.load_cache(spark, target)


def load_cache(spark, sf_dir):
    """A cache with every score of a key as a line of its own: the newest line wins."""
    target = work_path(spark, "cache")
    jsonl.write_cache(score_log(spark, sf_dir), target)
    return jsonl.load_cache(spark, target)


def lookup_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("account_id"))
    latest = scores.latest_scores(score_log(spark, sf_dir))
    return tables.lookup_keys(latest, keys, "account_id")


def lookup_one(spark, sf_dir):
    return tables.lookup_one(score_log(spark, sf_dir), "account_id", "7")


def _keyed_cache(spark, sf_dir):
    target = work_path(spark, "keyed")
    keyed.export_keyed_cache(score_log(spark, sf_dir), target)
    return target


def lookup_keyed(spark, sf_dir):
    """All customers' keys against a cache clustered by key."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("account_id"))
    return keyed.lookup_keyed(spark, _keyed_cache(spark, sf_dir), keys, "account_id")


def lookup_keyed_few(spark, sf_dir):
    """A few keys, one of them absent, by the filter that skips row groups."""
    wanted = ["7", "17", "170", "absent"]
    return keyed.lookup_list(spark, _keyed_cache(spark, sf_dir), wanted, "account_id")


# Projections, filters, validation


def clean_customers(spark, sf_dir):
    return cleaned(spark, sf_dir)


def quarantine(spark, sf_dir):
    return cleaning.quarantine(accounts(spark, sf_dir), ACCOUNTS)


def quarantine_summary(spark, sf_dir):
    return cleaning.quarantine_summary(accounts(spark, sf_dir), ACCOUNTS)


def select_features(spark, sf_dir):
    return cleaning.select_features(cleaned(spark, sf_dir), ACCOUNTS)


def split_roles(spark, sf_dir):
    return cleaning.split_roles(cleaned(spark, sf_dir), ACCOUNTS, ENGINEERED)


def make_dataset(spark, sf_dir):
    return cleaning.make_dataset(accounts(spark, sf_dir), ACCOUNTS)


def unknown_labels(spark, sf_dir):
    return cleaning.unknown_labels(accounts(spark, sf_dir), ACCOUNTS)


def scoring_features(spark, sf_dir):
    unlabelled = accounts(spark, sf_dir).drop(ACCOUNTS.label)
    return cleaning.scoring_features(unlabelled, ACCOUNTS)


def demographics(spark, sf_dir):
    return cleaning.demographics(cleaned(spark, sf_dir), ACCOUNTS)


def validate_schema(spark, sf_dir):
    features = cleaning.select_features(cleaned(spark, sf_dir), ACCOUNTS)
    checked = cleaning.validate_schema(features, ACCOUNTS.feature_columns())
    return checked.groupBy("contract", "payment").agg(F.count("*").alias("n"))


def threshold_flag(spark, sf_dir):
    log = score_log(spark, sf_dir).drop("flag", "threshold")
    flagged = scores.threshold_flag(log, THRESHOLD)
    return flagged.select("run_id", "probability", "flag", "threshold")


def reapply_threshold(spark, sf_dir):
    return scores.reapply_threshold(score_log(spark, sf_dir), 0.8)


def filter_run(spark, sf_dir):
    by_model = score_log(spark, sf_dir).withColumn("run_id", F.col("model"))
    return scores.filter_run(by_model, "purchase")


# Joins


def fairness_join(spark, sf_dir):
    """Scores of the events against the segments of the customers they belong to."""
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("account_id"), F.col("c_mktsegment").alias("segment")
    )
    scored = scored_events(spark, sf_dir)
    return rounded(fairness.fairness_join(scored, people, "account_id", ["segment"], THRESHOLD))


def fairness_unmatched(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("account_id"))
    return fairness.unmatched(scored_events(spark, sf_dir), people, "account_id")


# Aggregations


def label_balance(spark, sf_dir):
    return profiling.label_balance(accounts(spark, sf_dir), ACCOUNTS)


def dup_check(spark, sf_dir):
    return profiling.dup_check(score_log(spark, sf_dir), "account_id")


def rate_by_category(spark, sf_dir):
    columns = ["contract", "internet", "payment", "partner"]
    return profiling.rate_by_category(accounts(spark, sf_dir), ACCOUNTS, columns)


def rate_by_bucket_sql(spark, sf_dir):
    return profiling.rate_by_bucket(accounts(spark, sf_dir), ACCOUNTS)


def rate_by_bins(spark, sf_dir):
    return rounded(profiling.rate_by_bins(accounts(spark, sf_dir), ACCOUNTS, "tenure"))


def blank_count(spark, sf_dir):
    return profiling.blank_count(accounts(spark, sf_dir), "total_text")


def numeric_summary(spark, sf_dir):
    return profiling.numeric_summary(accounts(spark, sf_dir), ACCOUNTS, "monthly")


def describe_numeric(spark, sf_dir):
    view = accounts(spark, sf_dir)
    return rounded(profiling.describe_numeric(view, list(ACCOUNTS.numeric)), 4)


def quartiles_by_label(spark, sf_dir):
    view = accounts(spark, sf_dir)
    return rounded(profiling.quartiles_by_label(view, ACCOUNTS, ["tenure", "monthly"]))


def null_profile(spark, sf_dir):
    view = accounts(spark, sf_dir)
    types = dict(view.dtypes)
    number = to_number(F.col("total_text"), types["total_text"])
    return profiling.null_profile(view.withColumn("total_text", number))


def distinct_levels(spark, sf_dir):
    return profiling.levels(accounts(spark, sf_dir), "internet")


def rule_check(spark, sf_dir):
    return profiling.rule_check(accounts(spark, sf_dir), ACCOUNTS)


def class_histogram(spark, sf_dir):
    return rounded(profiling.class_histogram(accounts(spark, sf_dir), ACCOUNTS, "monthly", 30))


def label_correlation(spark, sf_dir):
    view = accounts(spark, sf_dir)
    return rounded(correlation.label_correlation(view, ACCOUNTS, drop_first=True))


def label_correlation_all_levels(spark, sf_dir):
    view = accounts(spark, sf_dir)
    return rounded(correlation.label_correlation(view, ACCOUNTS, drop_first=False))


def label_correlation_signed(spark, sf_dir):
    view = accounts(spark, sf_dir)
    return rounded(
        correlation.label_correlation(view, ACCOUNTS, drop_first=True, k=20, signed=True)
    )


def correlation_pairs(spark, sf_dir):
    matrix = correlation.exploration_matrix(accounts(spark, sf_dir), ACCOUNTS, drop_first=True)
    return rounded(correlation.correlation_pairs(matrix.withColumnRenamed("y", "label_flag")))


def correlation_pairs_filtered(spark, sf_dir):
    matrix = correlation.exploration_matrix(
        accounts(spark, sf_dir), ACCOUNTS, drop_first=True, exclude_markers=True
    )
    return rounded(correlation.correlation_pairs(matrix.withColumnRenamed("y", "label_flag")))


def encoded_correlation(spark, sf_dir):
    return rounded(correlation.encoded_correlation(_encoded(spark, sf_dir)))


def charge_drift(spark, sf_dir):
    return rounded(profiling.charge_drift(accounts(spark, sf_dir), ACCOUNTS), 4)


def charge_drift_fit(spark, sf_dir):
    return profiling.charge_drift_fit(accounts(spark, sf_dir), ACCOUNTS)


def charge_drift_rate(spark, sf_dir):
    return profiling.charge_drift_rate(accounts(spark, sf_dir), ACCOUNTS)


def prediction_monitor(spark, sf_dir):
    return rounded(scores.prediction_monitor(score_log(spark, sf_dir)))


def run_summary(spark, sf_dir):
    return rounded(scores.run_summary(score_log(spark, sf_dir), by="model"))


def confusion_matrix(spark, sf_dir):
    return curves.confusion_matrix(scored_events(spark, sf_dir), THRESHOLD)


def class_counts(spark, sf_dir):
    return rounded(splitting.class_weights(labelled(spark, sf_dir), "y"))


# Windows, order and samples


def latest_scores(spark, sf_dir):
    return scores.latest_scores(score_log(spark, sf_dir))


def top_risk(spark, sf_dir):
    return scores.top_risk(score_log(spark, sf_dir))


def newest_scores(spark, sf_dir):
    return scores.newest(score_log(spark, sf_dir))


def peek(spark, sf_dir):
    return tables.peek(accounts(spark, sf_dir), "account_id")


def sample_fixed(spark, sf_dir):
    log = score_log(spark, sf_dir)
    return sampling.sample_fixed(log, "run_id", 200).select("run_id", "probability")


# Feature transforms


def engineered(spark, sf_dir):
    return engineer_features(cleaned(spark, sf_dir), ACCOUNTS)


def fit_levels(spark, sf_dir):
    return encoding.fit_levels(accounts(spark, sf_dir), list(ACCOUNTS.categorical))


def one_hot(spark, sf_dir):
    return encoding.one_hot(
        cleaned(spark, sf_dir),
        list(ACCOUNTS.categorical),
        markers=ACCOUNTS.redundant_markers,
        keep=["account_id"],
    )


def one_hot_drop_first(spark, sf_dir):
    return encoding.one_hot(
        cleaned(spark, sf_dir),
        list(ACCOUNTS.categorical),
        markers=ACCOUNTS.redundant_markers,
        drop_first=True,
        keep=["account_id"],
    )


def scale_numeric(spark, sf_dir):
    numeric = list(ACCOUNTS.numeric)
    scaled = encoding.scale_numeric(cleaned(spark, sf_dir), numeric)
    return rounded(scaled.select("account_id", *numeric))


def preprocess(spark, sf_dir):
    """Scaled and encoded columns of all rows, fitted on the training rows only."""
    rows = splitting.stratified_split(labelled(spark, sf_dir), "account_id", "y")
    prep = encoding.FeaturePrep(
        numeric=list(ACCOUNTS.numeric),
        categorical=list(ACCOUNTS.categorical),
        markers=list(ACCOUNTS.redundant_markers),
        dropFirst=True,
        scale=True,
    )
    model = prep.fit(rows.filter("split = 'train'"))
    return rounded(model.encoded(rows, ["account_id"]))


def _encoded(spark, sf_dir):
    return encoding.encode_matrix(
        labelled(spark, sf_dir),
        ACCOUNTS.numeric,
        ACCOUNTS.categorical,
        markers=ACCOUNTS.redundant_markers,
        keep=["y"],
    )


def encode_matrix(spark, sf_dir):
    return _encoded(spark, sf_dir)


def select_encoded(spark, sf_dir):
    prep = encoding.FeaturePrep(
        numeric=list(ACCOUNTS.numeric),
        categorical=list(ACCOUNTS.categorical),
        markers=list(ACCOUNTS.redundant_markers),
        selected=["cat__contract_Month-to-month", "num__tenure", "cat__internet_No"],
    )
    rows = cleaned(spark, sf_dir)
    return prep.fit(rows).encoded(rows, ["account_id"])


# Splits and evaluation


def stratified_split(spark, sf_dir):
    rows = splitting.stratified_split(labelled(spark, sf_dir), "account_id", "y")
    return rows.select("account_id", "y", "split")


def stratified_folds(spark, sf_dir):
    rows = splitting.stratified_folds(labelled(spark, sf_dir), "account_id", "y")
    return rows.select("account_id", "y", "fold")


def pr_curve(spark, sf_dir):
    return rounded(curves.pr_curve(scored_events(spark, sf_dir)))


def pr_curve_ties(spark, sf_dir):
    return rounded(curves.pr_curve(scored_docs(spark, sf_dir)))


def best_threshold(spark, sf_dir):
    counts = curves.score_counts(scored_docs(spark, sf_dir))
    parts = [
        curves.best_point(counts, strategy=s).select(F.lit(s).alias("strategy"), "*")
        for s in curves.STRATEGIES
    ]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def best_threshold_events(spark, sf_dir):
    return rounded(curves.best_threshold(scored_events(spark, sf_dir)))


def evaluate(spark, sf_dir):
    return rounded(curves.evaluate(scored_events(spark, sf_dir), THRESHOLD))


def evaluate_ties(spark, sf_dir):
    return rounded(curves.evaluate(scored_docs(spark, sf_dir), 0.5))


def pr_summary(spark, sf_dir):
    return rounded(curves.pr_summary(scored_docs(spark, sf_dir), 0.5))


def fairness_by_group(spark, sf_dir):
    return rounded(fairness.fairness_by_group(scored_docs(spark, sf_dir), ["grp"], 0.5))


def mcc(spark, sf_dir):
    return rounded(curves.metric_value(scored_events(spark, sf_dir), "mcc"))


def metric_scorer(spark, sf_dir):
    scored = scored_docs(spark, sf_dir)
    first, *rest = [curves.metric_value(scored, m) for m in curves.METRICS]
    for frame in rest:
        first = first.unionByName(frame)
    return rounded(first)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        load_csv,
        load_table,
        load_scoring,
        seed_scoring,
        write_predictions,
        latest_scores_stream,
        export_jsonl,
        parse_jsonl,
        load_batch_output,
        export_cache,
        load_cache,
        lookup_keys,
        lookup_one,
        lookup_keyed,
        lookup_keyed_few,
        clean_customers,
        quarantine,
        quarantine_summary,
        select_features,
        split_roles,
        make_dataset,
        unknown_labels,
        scoring_features,
        demographics,
        validate_schema,
        threshold_flag,
        reapply_threshold,
        filter_run,
        fairness_join,
        fairness_unmatched,
        label_balance,
        dup_check,
        rate_by_category,
        rate_by_bucket_sql,
        rate_by_bins,
        blank_count,
        numeric_summary,
        describe_numeric,
        quartiles_by_label,
        null_profile,
        distinct_levels,
        rule_check,
        class_histogram,
        label_correlation,
        label_correlation_all_levels,
        label_correlation_signed,
        correlation_pairs,
        correlation_pairs_filtered,
        encoded_correlation,
        charge_drift,
        charge_drift_fit,
        charge_drift_rate,
        prediction_monitor,
        run_summary,
        confusion_matrix,
        class_counts,
        latest_scores,
        top_risk,
        newest_scores,
        peek,
        sample_fixed,
        fit_levels,
        one_hot,
        one_hot_drop_first,
        scale_numeric,
        preprocess,
        encode_matrix,
        select_encoded,
        stratified_split,
        stratified_folds,
        pr_curve,
        pr_curve_ties,
        best_threshold,
        best_threshold_events,
        evaluate,
        evaluate_ties,
        pr_summary,
        fairness_by_group,
        mcc,
        metric_scorer,
    )
}
QUERIES["engineer_features"] = engineered
