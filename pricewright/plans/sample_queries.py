"""Every operator as a query over the sample tables.

Each query reads whole tables. Doubles are rounded for comparison with another engine
(:func:`comparable`); that is the only step that is not part of the library itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import schemas
from ..functions.features import price_of, with_calendar_features, with_physical_features
from ..functions import sketches
from ..functions.numeric import round_half_even
from ..operators import category, clean, demand, encode, evaluate, facts, payments, reviews, score
from ..sources import sinks
from ..sources import layout, records
from ..sources.sample import sample_items, sample_requests, sample_star
from ..sources.star import StarSchema, read_star, scan_counts as star_counts
from ..stage import Stage
from ..streaming.scoring import score_into_sinks, score_stream as start_scoring
from . import jobs, presets, search, training

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def comparable(df: DataFrame) -> DataFrame:
    """Round every double to four places and widen every integer column.

    The odd offset keeps round fractions away from the rounding edge, where another order
    of summation could tip them.
    """
    columns = []
    for field in df.schema:
        if isinstance(field.dataType, T.DoubleType):
            columns.append(f"floor({field.name} * 10000 + 0.5003D) / 10000D AS {field.name}")
        elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
            columns.append(f"CAST({field.name} AS BIGINT) AS {field.name}")
        else:
            columns.append(field.name)
    return df.selectExpr(*columns)


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts.build_facts(sample_star(spark, folder), Stage(spark))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("item_key", encode.item_key())


def _engineered(spark: SparkSession, folder: str) -> tuple[DataFrame, Stage]:
    stage = Stage(spark)
    wide = stage.table(_keyed(facts.build_facts(sample_star(spark, folder), stage)), "facts")
    medians = stage.table(clean.imputation_medians(clean.priced(wide)), "medians")
    return clean.engineer(wide, medians), stage


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, Stage]:
    engineered, stage = _engineered(spark, folder)
    bounds = stage.table(clean.outlier_bounds(clean.complete_rows(engineered)), "bounds")
    return encode.with_split(clean.clean(engineered, bounds)), stage


# Sources


@query
def scan_counts(spark, folder):
    return star_counts(sample_star(spark, folder))


@query
def scan_counts_csv(spark, folder):
    """The sample star written as the published CSV files, and read by the CSV reader."""
    return star_counts(_csv_star(spark, folder))


@query
def category_median_sales_csv(spark, folder):
    return category.category_median_sales(_csv_star(spark, folder))


@query
def category_avg_review_csv(spark, folder):
    averages = category.category_prices_and_reviews(_csv_star(spark, folder))
    return comparable(averages.select("category", "avg_review"))


def _csv_star(spark: SparkSession, folder: str) -> StarSchema:
    stage = Stage(spark)
    for name, df in sample_star(spark, folder).tables().items():
        path = stage.path(schemas.CSV_FILES[name])
        df.write.option("header", "true").option("escape", '"').csv(path)
    return read_star(spark, stage.root)


@query
def csv_multiline_records(spark, folder):
    """Texts with line breaks and quotes, written as CSV and read back, a file by many tasks."""
    store, reader = Stage(spark), spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    path = store.path("documents.csv")
    documents.coalesce(1).write.options(**records.WRITE_OPTIONS).csv(path)
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    )
    found = records.read_records(reader, path, schema)
    return found.select("doc_id", F.md5("text").alias("digest"))


@query
def reviews_csv(spark, folder):
    reviews = _csv_star(spark, folder).reviews
    ids = [F.col(c).cast("long").alias(c) for c in ("review_id", "order_id")]
    # The CSV writer keeps no more than milliseconds.
    created = F.date_trunc("second", "review_creation_date").cast("timestamp_ntz")
    return comparable(reviews.select(*ids, "review_score", created.alias("review_creation_date")))


def _layout_star(spark: SparkSession, folder: str) -> tuple[StarSchema, Stage]:
    """The sample star in buckets of the order id."""
    stage = Stage(spark)
    layout.write_layout(sample_star(spark, folder), stage.path("layout"), 8)
    return layout.read_layout(spark, stage.path("layout")), stage


@query
def scan_counts_layout(spark, folder):
    return star_counts(_layout_star(spark, folder)[0])


@query
def job_counts(spark, folder):
    """Source and result counts, taken from the jobs that write the training table."""
    _, counts = jobs.prepare_counted(sample_star(spark, folder), Stage(spark))
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


# Categories


@query
def category_stats(spark, folder):
    return comparable(category.category_stats(sample_star(spark, folder), Stage(spark)))


@query
def category_avg_review(spark, folder):
    averages = category.category_prices_and_reviews(sample_star(spark, folder))
    return comparable(averages.select("category", "avg_review"))


@query
def category_median_sales(spark, folder):
    return category.category_median_sales(sample_star(spark, folder))


@query
def top_categories(spark, folder):
    return comparable(
        category.top_categories(category.category_stats(sample_star(spark, folder), Stage(spark)))
    )


@query
def bottom_categories(spark, folder):
    return comparable(
        category.bottom_categories(
            category.category_stats(sample_star(spark, folder), Stage(spark))
        )
    )


@query
def category_ranges(spark, folder):
    return comparable(
        category.category_ranges(category.category_stats(sample_star(spark, folder), Stage(spark)))
    )


@query
def category_seed_rows(spark, folder):
    return category.seed_rows(category.category_stats(sample_star(spark, folder), Stage(spark)))


@query
def category_seed_file(spark, folder):
    stage = Stage(spark)
    stats = category.category_stats(sample_star(spark, folder), stage)
    sinks.write_seed(stats, stage.path("seed"))
    return spark.read.text(stage.path("seed"))


@query
def category_insert_if_absent(spark, folder):
    stage = Stage(spark)
    stats = stage.table(category.category_stats(sample_star(spark, folder), stage), "stats")
    existing = stats.filter("category < 'm'").withColumn("avg_price", F.lit(0.0))
    return comparable(category.insert_if_absent(stats, existing))


@query
def installment_tier(spark, folder):
    prices = (
        sample_star(spark, folder)
        .items.groupBy("product_id")
        .agg(round_half_even(F.avg("price") / 500).alias("avg_price"))
    )
    tier = category.installment_tier(F.col("avg_price"))
    return comparable(prices.withColumn("installments", tier).drop("avg_price"))


# Aggregates


@query
def order_payment_profile(spark, folder):
    return comparable(payments.order_payment_profile(sample_star(spark, folder).payments))


@query
def latest_review_per_order(spark, folder):
    return comparable(reviews.latest_review_per_order(sample_star(spark, folder).reviews))


@query
def order_mean_review(spark, folder):
    return comparable(reviews.order_mean_review(sample_star(spark, folder).reviews))


def _activity(star: StarSchema, stage: Stage) -> DataFrame:
    latest = stage.table(reviews.latest_review_per_order(star.reviews), "latest_reviews")
    return demand.activity(star.items, latest)


@query
def product_avg_review(spark, folder):
    pairs = _activity(sample_star(spark, folder), Stage(spark))
    return comparable(reviews.product_avg_review(pairs))


@query
def seller_avg_review(spark, folder):
    pairs = _activity(sample_star(spark, folder), Stage(spark))
    return comparable(reviews.seller_avg_review(pairs))


@query
def product_demand(spark, folder):
    return demand.product_demand(demand.activity(sample_star(spark, folder).items))


@query
def seller_demand(spark, folder):
    return demand.seller_demand(demand.activity(sample_star(spark, folder).items))


@query
def seller_diversity_sketch(spark, folder):
    """Distinct sketches of two loads, merged, against the exact counts: three standard errors."""
    items = sample_star(spark, folder).items
    even = F.col("order_id") % 2 == 0
    loads = [sketches.seller_products(items.filter(part)) for part in (even, ~even)]
    guess = sketches.seller_diversity(sketches.merge_seller_products(*loads))
    exact = demand.seller_demand(demand.activity(items)).drop("seller_sales_count")
    gap = F.abs(F.col("guess") - F.col("seller_product_diversity"))
    allowed = F.greatest(F.lit(1.0), 3 * sketches.DISTINCT_ERROR * F.col("seller_product_diversity"))
    return exact.join(guess.toDF("seller_id", "guess"), "seller_id").select(
        "seller_id", "seller_product_diversity", (gap <= allowed).alias("within")
    )


@query
def quantile_sketch(spark, folder):
    """Quantiles from sketches of two loads, merged: whether their exact rank is within the error."""
    items = sample_star(spark, folder).items
    even = F.col("order_id") % 2 == 0
    columns = ["price", "freight_value"]
    loads = [sketches.value_sketches(items.filter(part), columns) for part in (even, ~even)]
    ranks = {0.01: "low", 0.5: "median", 0.99: "high"}
    targets = {f"{c}_{n}": (c, r) for c in columns for r, n in ranks.items()}
    guess = Stage(spark).table(
        sketches.quantiles_of(sketches.merge_value_sketches(*loads), targets), "guess"
    )
    found = guess.select(F.struct(*targets).alias("found")).scalar()
    rows = []
    for name, (column, rank) in targets.items():
        # Equal values share a span of ranks, from those below to those up to the value.
        below = F.avg((F.col(column) < found[name]).cast("double"))
        upto = F.avg((F.col(column) <= found[name]).cast("double"))
        near = (below <= rank + sketches.RANK_ERROR) & (upto >= rank - sketches.RANK_ERROR)
        rows.append(F.struct(F.lit(name).alias("target"), near.alias("within")))
    return items.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


# Facts and derived features


@query
def order_item_facts(spark, folder):
    return comparable(_keyed(_facts(spark, folder)))


@query
def order_item_facts_layout(spark, folder):
    star, stage = _layout_star(spark, folder)
    return comparable(_keyed(facts.build_facts(star, stage)))


@query
def physical_features(spark, folder):
    star = sample_star(spark, folder)
    rows = _keyed(star.items.join(star.products, "product_id", "left"))
    return comparable(
        with_physical_features(rows).select(
            "item_key",
            "product_volume_cm3",
            "density",
            "shipping_ratio",
            "log_weight",
            "log_volume",
            "complexity_score",
        )
    )


@query
def size_category(spark, folder):
    rows = with_physical_features(
        sample_star(spark, folder).products.withColumn("freight_value", F.lit(0.0))
    )
    return rows.select("product_id", "size_category")


@query
def date_features(spark, folder):
    rows = with_calendar_features(sample_star(spark, folder).orders)
    return comparable(rows.drop("order_purchase_timestamp", "customer_id"))


# Cleaning


@query
def median_impute(spark, folder):
    engineered, _ = _engineered(spark, folder)
    return comparable(engineered.select("item_key", *clean.IMPUTED))


@query
def unknown_fill(spark, folder):
    engineered, _ = _engineered(spark, folder)
    return clean.fill_unknown(engineered).select("item_key", *schemas.CATEGORICAL)


@query
def outlier_bounds(spark, folder):
    engineered, _ = _engineered(spark, folder)
    return comparable(clean.outlier_bounds(clean.complete_rows(engineered)))


@query
def outlier_trim(spark, folder):
    rows, _ = _split(spark, folder)
    return comparable(rows.select("item_key", "price"))


@query
def clean_row_count(spark, folder):
    rows, _ = _split(spark, folder)
    return rows.agg(F.count(F.lit(1)).alias("clean_rows"))


def _baseline(spark: SparkSession, folder: str) -> tuple[DataFrame, Stage]:
    stage = Stage(spark)
    wide = facts.build_core_facts(sample_star(spark, folder), stage)
    wide = stage.table(_keyed(wide), "core_facts")
    means = stage.table(clean.full_category_means(wide), "category_means")
    return clean.engineer_baseline(wide, means), stage


@query
def baseline_clean_rows(spark, folder):
    engineered, _ = _baseline(spark, folder)
    rows = F.count(F.lit(1)).alias("clean_rows")
    trimmed = clean.clean_baseline(engineered).agg(rows)
    whole = clean.clean_baseline(engineered, trim=False).agg(rows)
    return trimmed.select(F.lit("baseline").alias("mode"), "clean_rows").unionAll(
        whole.select(F.lit("comparison").alias("mode"), "clean_rows")
    )


@query
def baseline_features(spark, folder):
    engineered, _ = _baseline(spark, folder)
    rows = clean.clean_baseline(engineered)
    return comparable(rows.select("item_key", "price", *schemas.BASELINE_FEATURES))


@query
def feature_row(spark, folder):
    rows = jobs.prepare(sample_star(spark, folder), Stage(spark))
    return comparable(rows.select("item_key", "split", *schemas.FEATURES))


# Split and encodings


@query
def split_counts(spark, folder):
    rows = encode.with_split(sample_star(spark, folder).items)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query
def target_roundtrip(spark, folder):
    rows = encode.with_split(sample_star(spark, folder).items)
    return comparable(
        rows.select("item_key", "label", price_of(F.col("label")).alias("restored_price"))
    )


@query
def global_avg_price(spark, folder):
    rows, _ = _split(spark, folder)
    return comparable(encode.global_avg_price(encode.train_price_totals(rows)))


@query
def category_avg_price_train(spark, folder):
    rows, stage = _split(spark, folder)
    encoded = encode.fit_encodings(rows, stage).apply(rows)
    return comparable(encoded.select("item_key", "split", "category_avg_price"))


@query
def seller_avg_price_train(spark, folder):
    rows, stage = _split(spark, folder)
    encoded = encode.fit_encodings(rows, stage).apply(rows)
    return comparable(encoded.select("item_key", "split", "seller_avg_price"))


@query
def category_avg_price_full(spark, folder):
    engineered, _ = _baseline(spark, folder)
    return comparable(
        engineered.select("item_key", "product_category_name_english", "category_avg_price")
    )


@query
def one_hot_levels(spark, folder):
    rows, _ = _split(spark, folder)
    return encode.level_counts(rows, schemas.CATEGORICAL)


# Metrics


def _category_mean_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows, stage = _split(spark, folder)
    encoded = encode.fit_encodings(rows, stage).apply(rows)
    return evaluate.regression_metrics(encode.test_rows(encoded), "price", "category_avg_price")


@query
def regression_metrics(spark, folder):
    return comparable(_category_mean_metrics(spark, folder))


@query
def baseline_delta(spark, folder):
    delta = evaluate.baseline_delta(_category_mean_metrics(spark, folder))
    return comparable(delta.select("r2_delta", "mae_delta", "improved"))


# Models, on all rows. Boosting of the compared algorithms runs with the rounds of ``presets.TRIAL``,
# searches are of ``presets.QUICK_SPACE``; all else has published sizes.


def _comparison_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, Stage]:
    stage = Stage(spark)
    rows = jobs.prepare_baseline(sample_star(spark, folder), stage, trim=False)
    return stage.table(rows, "training_rows"), stage


def _fitted(rows: DataFrame, model, name: str, exact: bool = True) -> DataFrame:
    """What holds for a fitted model whatever its scores: rows of both splits, finite scores, and the
    mean prediction on the training rows, which least squares keeps at the mean label. A forest
    grows its trees on other draws of the rows, so its mean is only near."""
    scored = training.predict(rows, model)
    train = F.col("split") == "train"
    label, guess = F.avg(F.when(train, F.col("label"))), F.avg(F.when(train, F.col("prediction")))
    gap = F.abs(label - guess) / F.stddev_pop(F.when(train, F.col("label")))
    metrics = training.evaluate(rows, model)
    finite = [f"abs({c}) < CAST('Infinity' AS DOUBLE)" for c in ("r2", "mae", "rmse", "mape")]
    return comparable(
        scored.agg(
            F.lit(name).alias("algorithm"),
            F.count_if(train).alias("train_rows"),
            F.count_if(~train).alias("test_rows"),
            label.alias("mean_label"),
            (gap < (1e-6 if exact else 0.05)).alias("mean_kept"),
        ).join(metrics.selectExpr(" AND ".join(finite) + " AS finite_scores"))
    )


def _fit_query(kind: str) -> Query:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        rows, _ = _comparison_rows(spark, folder)
        name, full = presets.ALGORITHMS[kind]
        model = training.fit(rows, jobs.BASELINE, kind, **presets.TRIAL.get(kind, full))
        return _fitted(rows, model, name, exact=kind != "forest")

    return build


for _kind in presets.ALGORITHMS:
    QUERIES[f"fit_{_kind}"] = _fit_query(_kind)


def _training_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, Stage]:
    stage = Stage(spark)
    return stage.table(jobs.prepare(sample_star(spark, folder), stage), "training_rows"), stage


@query
def fit_gbt_tuned(spark, folder):
    rows, _ = _training_rows(spark, folder)
    model = training.fit(rows, jobs.CURRENT, "gbt", **presets.BEST_PARAMS)
    return _fitted(rows, model, "Gradient Boosting, tuned")


def _search_facts(spark: SparkSession, tuned: training.Tuned, space: dict) -> DataFrame:
    """What holds for a search whatever its scores."""
    names = sorted(space)
    best = F.max("mean_r2").over(Window.partitionBy())
    inside = [F.col("params")[n].isin(*[float(v) for v in space[n]]) for n in names]
    rows = tuned.summary(spark).withColumn("top", F.col("mean_r2") == best)
    values = F.concat_ws("|", *[F.col("params")[n].cast("string") for n in names])
    return rows.agg(
        F.count("*").alias("candidates"),
        F.count_if("best").alias("winners"),
        F.bool_and(~F.col("best") | F.col("top")).alias("winner_is_best"),
        F.count_distinct(values).alias("distinct_params"),
        F.bool_and(reduce(lambda x, y: x & y, inside)).alias("within_space"),
    )


@query
def tune_summary(spark, folder):
    rows, _ = _training_rows(spark, folder)
    tuned = training.tune(rows, jobs.CURRENT, presets.QUICK_SPACE, candidates=3)
    return _search_facts(spark, tuned, presets.QUICK_SPACE)


@query
def tune_summary_baseline(spark, folder):
    stage = Stage(spark)
    rows = stage.table(jobs.prepare_baseline(sample_star(spark, folder), stage), "training_rows")
    space = {**presets.BASELINE_SEARCH_SPACE, "n_estimators": [4, 6], "max_depth": [3, 4]}
    tuned = training.tune(rows, jobs.BASELINE, space, candidates=2)
    return _search_facts(spark, tuned, space)


@query
def search_prefix_scores(spark, folder):
    """Whether the prefixes of one boosted chain score as models fitted with so many rounds."""
    rows, _ = _training_rows(spark, folder)
    encoder = training.Pipeline(stages=jobs.CURRENT.stages()).fit(encode.train_rows(rows))
    both = Stage(spark).table(encoder.transform(rows), "rows")
    train, held = encode.train_rows(both), encode.test_rows(both)
    values = {**presets.BEST_PARAMS, "max_depth": 4, "subsample": 0.8}
    rounds = (2, 4, 6)
    models = {
        k: training.estimator("gbt", **{**values, "n_estimators": k}).fit(train) for k in rounds
    }
    staged = search.prefix_scores(models[6], held, rounds)
    r2 = RegressionEvaluator(labelCol="label", metricName="r2")
    alone = [r2.evaluate(models[k].transform(held)) for k in rounds]
    equal = [(k, abs(a - b) < 1e-9) for k, a, b in zip(rounds, staged, alone)]
    return spark.createDataFrame(equal, "rounds long, equal boolean")


@query
def result_record(spark, folder):
    stage = Stage(spark)
    trained = jobs.train(
        sample_star(spark, folder),
        stage,
        presets.QUICK_SPACE,
        candidates=2,
        model_path=stage.path("model"),
        result_path=stage.path("result"),
    )
    record = spark.read.schema(trained.record.schema).json(stage.path("result"))
    return record.selectExpr(
        "algorithm",
        "CAST(features_count AS BIGINT) AS features_count",
        "array_join(features_numeric, ',') AS features_numeric",
        "array_join(features_categorical, ',') AS features_categorical",
        "CAST(size(best_params) AS BIGINT) AS params",
        "array_join(new_tables_used, ',') AS new_tables_used",
        "leakage_fixed",
        "abs(vs_baseline.r2_delta - (r2 - 0.7831)) < 1e-9 AS r2_delta_right",
        "abs(vs_baseline.mae_delta - (mae - 20.5)) < 1e-9 AS mae_delta_right",
    )


@query
def model_comparison(spark, folder):
    rows, stage = _comparison_rows(spark, folder)
    kinds = tuple(presets.ALGORITHMS)
    table = jobs.compare(rows, kinds, presets.TRIAL, stage.path("results"))
    records = jobs.sinks.read_metrics(spark, [f"{stage.path('results')}/{k}" for k in kinds])
    better = F.col("a.r2") > F.col("b.r2")
    # Of each algorithm: how it stands to the linear one, by its own record and by the ranking.
    place = {r["algorithm"]: i for i, r in enumerate(table.collect())}
    ranked = spark.createDataFrame(list(place.items()), "algorithm string, place int")
    pairs = records.alias("a").join(records.alias("b"), better).select(
        F.col("a.algorithm").alias("x"), F.col("b.algorithm").alias("y")
    )
    wrong = (
        pairs.join(ranked.toDF("x", "px"), "x")
        .join(ranked.toDF("y", "py"), "y")
        .filter("px > py")
        .agg(F.count("*").alias("n"))
    )
    return ranked.select("algorithm").join(wrong.selectExpr("n = 0 AS in_order"))


@query
def model_roundtrip(spark, folder):
    rows, stage = _training_rows(spark, folder)
    model = training.fit(rows, jobs.CURRENT, "tree", **presets.ALGORITHMS["tree"][1])
    sinks.save_model(model, stage.path("model"))
    before = training.predict(encode.test_rows(rows), model)
    after = training.predict(
        before.withColumnRenamed("predicted_price", "price_before").select(
            "price_before", *schemas.FEATURES
        ),
        sinks.load_model(stage.path("model")),
    )
    differs = F.col("price_before") != F.col("predicted_price")
    return after.agg(F.count(F.lit(1)).alias("rows"), F.count_if(differs).alias("different"))


# Scoring


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    star = sample_star(spark, folder)
    return sample_requests(star.items, star)


@query
def score_validate(spark, folder):
    checked = score.validate(_requests(spark, folder))
    return checked.select(
        "request_id",
        F.when(F.size("violations") > 0, F.array_join("violations", "; ")).alias("error"),
    )


@query
def score_defaults(spark, folder):
    filled = score.apply_defaults(score.valid_rows(score.validate(_requests(spark, folder))))
    optional = [n for n, spec in schemas.REQUEST_FIELDS.items() if spec[1] is not None]
    return comparable(filled.select("request_id", *optional))


@query
def score_features(spark, folder):
    valid = score.valid_rows(score.validate(_requests(spark, folder)))
    featured = score.request_features(score.apply_defaults(valid))
    return comparable(featured.select("request_id", *schemas.FEATURES))


#: A least-squares line over one feature, whose predictions another engine can compute.
LINE = training.FeatureSet(("complexity_score",), ())


def _scoring_model(spark: SparkSession, folder: str):
    rows, stage = _training_rows(spark, folder)
    return training.fit(rows, LINE, "linear"), stage


@query
def score_batch(spark, folder):
    model, _ = _scoring_model(spark, folder)
    return comparable(score.score(_requests(spark, folder), model, ("request_id",)))


@query
def score_batch_tree(spark, folder):
    """The full feature row through a tree of the published depth: which rows have a price."""
    rows, _ = _training_rows(spark, folder)
    model = training.fit(rows, jobs.CURRENT, "tree", **presets.ALGORITHMS["tree"][1])
    scored = score.score(_requests(spark, folder), model, ("request_id",))
    return scored.selectExpr("request_id", "predicted_price > 0 AS priced", "error")


def _request_stream(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    stream = (
        spark.readStream.schema(lineitem.schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(folder)
    )
    return sample_requests(sample_items(stream), sample_star(spark, folder))


@query
def score_stream(spark, folder):
    model, stage = _scoring_model(spark, folder)
    requests, output = _request_stream(spark, folder), stage.path("scored")
    start_scoring(
        requests, model, output, stage.path("scoring_log"), ("request_id",)
    ).awaitTermination()
    return comparable(
        spark.read.schema("request_id string, predicted_price double, error string").parquet(output)
    )


@query
def score_stream_sinks(spark, folder):
    model, stage = _scoring_model(spark, folder)
    priced, rejected = stage.path("priced"), stage.path("rejected")
    requests = _request_stream(spark, folder)
    score_into_sinks(
        requests, model, priced, rejected, stage.path("sinks_log"), ("request_id",)
    ).awaitTermination()
    kinds = "request_id string, predicted_price double"
    good = spark.read.schema(kinds).parquet(priced).withColumn("sink", F.lit("priced"))
    bad = spark.read.schema("request_id string, error string").parquet(rejected)
    bad = bad.withColumn("sink", F.lit("rejected"))
    both = good.unionByName(bad, allowMissingColumns=True)
    return comparable(both.select("request_id", "predicted_price", "error", "sink"))
