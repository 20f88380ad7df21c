"""Registered queries: (spark, sf_dir) -> DataFrame over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayguard.operators import assemble, basic, families, staging
from dayguard.params import Params
from dayguard.schema import CITY_FEATURES, CLICK_FEATURES, KEY_COLS, PURCHASE_FEATURES
from dayguard.sources.tables import file_marks
from dayguard.sources.testdata import load_inputs

P = Params.testdata()
REGISTRY: dict = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


_INPUTS: dict = {}


def _sid(spark: SparkSession, sf: str) -> str:
    """Identity of the running application and of the input files (a restarted session or a
    table that was written anew never matches)."""
    return f"{spark.sparkContext.applicationId} {file_marks(spark, sf, ('events', 'orders', 'lineitem', 'part'))}"


def _inp(spark: SparkSession, sf: str):
    """Lazy input frames, built once per session and folder."""
    key = (_sid(spark, sf), sf)
    if key not in _INPUTS:
        _INPUTS[key] = load_inputs(spark, sf)
    return _INPUTS[key]


@register
def city_features(spark, sf) -> DataFrame:
    return families.city_features(_inp(spark, sf), P)


@register
def prev_city(spark, sf) -> DataFrame:
    return city_features(spark, sf).select(*KEY_COLS, CITY_FEATURES[0])


@register
def daily_city(spark, sf) -> DataFrame:
    return city_features(spark, sf).select(*KEY_COLS, *CITY_FEATURES[1:])


@register
def click_features(spark, sf) -> DataFrame:
    return families.click_features(_inp(spark, sf), P)


@register
def purchase_features(spark, sf) -> DataFrame:
    return families.purchase_features(_inp(spark, sf), P)


@register
def behavior_flags(spark, sf) -> DataFrame:
    return families.behavior_flags(_inp(spark, sf), P)


@register
def new_feature_set(spark, sf) -> DataFrame:
    return families.new_feature_set(_inp(spark, sf), P)


@register
def feature_table(spark, sf) -> DataFrame:
    """The 36-feature table, computed once per session and written to the shared
    checkpoint folder (a temp table in the original job); later stages read it."""
    return materialised_features(spark, sf)


# --- shared, materialised inputs of the notebook stages ------------------------
from dayguard.operators import curves, evaluate, labels, prep  # noqa: E402
from dayguard.plans import pipeline  # noqa: E402
from dayguard.schema import FEATURES  # noqa: E402
from dayguard.session import cut_lineage  # noqa: E402

_CACHE: dict = {}
THRESHOLD = 4.3  # decision threshold on the loss score (reference value)


def _r(c, name=None):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


def materialised_features(spark, sf) -> DataFrame:
    """The feature table written once as Parquet to the shared checkpoint folder; later
    stages (preparation, models, evaluation) read the columns and days they need."""
    key = ("ft", _sid(spark, sf), sf)
    if key not in _CACHE:
        _CACHE[key] = pipeline.written(assemble.feature_table(_inp(spark, sf), P))
    return _CACHE[key]


def _lab(spark, sf):
    return pipeline.labelled_days(_inp(spark, sf), P)


def _prepared(spark, sf) -> pipeline.Prepared:
    key = ("prep", _sid(spark, sf), sf)
    if key not in _CACHE:
        _CACHE[key] = pipeline.prepare(_inp(spark, sf), P, materialised_features(spark, sf))
    return _CACHE[key]


@register
def label_orders_ato(spark, sf) -> DataFrame:
    i = _inp(spark, sf)
    return labels.label_orders(i.ato_orders, i.orders, P, "label")


@register
def label_orders_all(spark, sf) -> DataFrame:
    i = _inp(spark, sf)
    return labels.label_orders(i.fraud_orders, i.orders, P, "orders")


@register
def label_days_ato(spark, sf) -> DataFrame:
    return _lab(spark, sf).ato_days.select("customer_id", "date", "order_id")


@register
def label_days_all(spark, sf) -> DataFrame:
    return _lab(spark, sf).all_days.select("customer_id", "date", "order_id")


@register
def ato_rows(spark, sf) -> DataFrame:
    return labels.labelled_rows(materialised_features(spark, sf), _lab(spark, sf).ato_days)


@register
def fraud_rows(spark, sf) -> DataFrame:
    return labels.labelled_rows(materialised_features(spark, sf), _lab(spark, sf).all_days)


@register
def fill_nulls(spark, sf) -> DataFrame:
    return prep.fill_nulls(materialised_features(spark, sf))


@register
def null_profile(spark, sf) -> DataFrame:
    return prep.null_profile(materialised_features(spark, sf))


@register
def dedup_rows(spark, sf) -> DataFrame:
    """ATO rows, filled, keys dropped, duplicates removed (preparation order)."""
    ft = materialised_features(spark, sf)
    ato = prep.fill_nulls(labels.labelled_rows(ft, _lab(spark, sf).ato_days))
    return pipeline.distinct_features(ato)


@register
def sample_rows(spark, sf) -> DataFrame:
    ft = materialised_features(spark, sf)
    return prep.sample_rows(prep.fill_nulls(pipeline.in_training(ft, P)), pipeline.SAMPLE_FRAC)


@register
def normal_rows(spark, sf) -> DataFrame:
    return pipeline.normal_rows(materialised_features(spark, sf), _lab(spark, sf), P)


@register
def split_sizes(spark, sf) -> DataFrame:
    ft = materialised_features(spark, sf)
    lab = _lab(spark, sf)
    split = pipeline.split_normal(ft, lab, P)
    ato, allf = pipeline.fraud_sets(ft, lab)
    sizes = split.groupBy(F.col("split").alias("dataset")).agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.unionByName(
        ato.agg(F.lit("ato").alias("dataset"), F.count(F.lit(1)).alias("n_rows"))).unionByName(
        allf.agg(F.lit("all").alias("dataset"), F.count(F.lit(1)).alias("n_rows")))


@register
def scaler_params(spark, sf) -> DataFrame:
    ft = materialised_features(spark, sf)
    split = pipeline.split_normal(ft, _lab(spark, sf), P)
    sp = prep.scaler_params(split.where(F.col("split") == "train"))
    return sp.select("feature", _r("mean"), _r(F.coalesce(F.col("std"), F.lit(0.0)), "std"))


@register
def standardize(spark, sf) -> DataFrame:
    """All five standardised sets: train, validation, ATO, all-fraud and test rows."""
    pr = _prepared(spark, sf)
    sets = (("train", pr.train), ("val", pr.val), ("ato", pr.ato), ("all", pr.allf), ("test", pr.test_normal))
    return prep.union_periods([df.select(F.lit(n).alias("dataset"), *KEY_COLS, *[_r(c) for c in FEATURES]) for n, df in sets])


def _scored(spark, sf) -> DataFrame:
    pr = _prepared(spark, sf)
    return evaluate.scored_labels(pipeline.with_baseline_score(pr.val),
                                  pipeline.with_baseline_score(pr.ato))


@register
def scored_labels(spark, sf) -> DataFrame:
    return _scored(spark, sf).select(*KEY_COLS, _r("score"), "label")


def _cum(spark, sf) -> DataFrame:
    key = ("cum", _sid(spark, sf), sf)
    if key not in _CACHE:
        _CACHE[key] = curves.cumulative_counts(_scored(spark, sf))
    return _CACHE[key]


@register
def roc_curve(spark, sf) -> DataFrame:
    return curves.roc_curve(_cum(spark, sf)).select(_r("threshold"), _r("fpr"), _r("tpr"))


@register
def roc_curve_dropped(spark, sf) -> DataFrame:
    """ROC points where the curve changes direction, plus the (0, 0) start."""
    return curves.roc_curve(_cum(spark, sf), drop_intermediate=True).select(
        _r("threshold"), _r("fpr"), _r("tpr"))


@register
def auc(spark, sf) -> DataFrame:
    return curves.auc(_cum(spark, sf)).select(_r("auc"))


@register
def pr_curve(spark, sf) -> DataFrame:
    return curves.pr_curve(_cum(spark, sf)).select(_r("threshold"), _r("precision"), _r("recall"))


@register
def f1_curve(spark, sf) -> DataFrame:
    return curves.f1_curve(_cum(spark, sf)).select(_r("threshold"), _r("f1"))


@register
def average_precision(spark, sf) -> DataFrame:
    return curves.average_precision(_cum(spark, sf)).select(_r("average_precision"))


@register
def period_confusion(spark, sf) -> DataFrame:
    pr = _prepared(spark, sf)
    test_ato = pipeline.in_test(pr.ato, P)
    scored = evaluate.scored_labels(pipeline.with_baseline_score(pr.test_normal),
                                    pipeline.with_baseline_score(test_ato))
    return evaluate.period_confusion(scored, THRESHOLD, P.period)


@register
def outlier_rates(spark, sf) -> DataFrame:
    pr = _prepared(spark, sf)
    parts = [pipeline.with_baseline_score(df).select(F.lit(name).alias("dataset"), "score")
             for name, df in (("val", pr.val), ("ato", pr.ato), ("all", pr.allf))]
    pred = prep.union_periods(parts).withColumn(
        "pred", F.when(F.col("score") >= THRESHOLD, -1).otherwise(1))
    return evaluate.outlier_rates(pred)


@register
def period_confusion_stored(spark, sf) -> DataFrame:
    """Weekly confusion counts read from a store of scores that is filled week by week: first
    with scores of all test rows as if unlabelled, then once more, week by week, as they are."""
    from dayguard.sources.parts import Store
    pr = _prepared(spark, sf)
    test_ato = pipeline.in_test(pr.ato, P)
    scored = evaluate.scored_labels(pipeline.with_baseline_score(pr.test_normal), pipeline.with_baseline_score(test_ato))
    path = _scratch(spark, "scores")
    week = evaluate.period_of(KEY_COLS[1], P.period)
    store = evaluate.store_scores(Store.open(spark, path), "draft", scored.withColumn("label", F.lit(0)), P.period)
    for r in scored.select(week.alias("w")).distinct().orderBy("w").collect():  # periods
        store = evaluate.store_scores(store, f"week {r['w']}", scored.where(week == F.lit(r["w"])), P.period)
    return evaluate.period_confusion(Store.open(spark, path).read("scores", scored.schema), THRESHOLD, P.period)


# --- staging tables and daily totals -----------------------------------------
@register
def interaction_events(spark, sf) -> DataFrame:
    """ga_behavior: valid customers, history window, interaction hits only."""
    b = staging.ga_behavior(_inp(spark, sf), P)
    return b.select("customer_id", F.col("day").alias("ga_sessions_date"), "event_category",
                    "event_label", "event_action", "list_category")


@register
def event_check(spark, sf) -> DataFrame:
    """Ad-hoc check: interaction rows of completed ship-now actions."""
    return interaction_events(spark, sf).where(
        (F.col("event_action") == "ship-now") & (F.col("event_label") == "done"))


@register
def order_info(spark, sf) -> DataFrame:
    o = staging.order_info(_inp(spark, sf), P)
    return o.select("customer_id", F.col("day").alias("date"), "product_id",
                    F.col("level1").alias("category_level1"),
                    F.col("level2").alias("category_level2"))


@register
def order_totals(spark, sf) -> DataFrame:
    return basic.order_totals(_inp(spark, sf), P.history_start, P.history_end, P)


@register
def hit_totals(spark, sf) -> DataFrame:
    return basic.hit_totals(_inp(spark, sf), P.history_start, P.history_end, P)


@register
def basic_features(spark, sf) -> DataFrame:
    """The full outer join of daily totals over every day, customer 0 included."""
    return basic.basic_features(_inp(spark, sf), P.history_start, P.history_end, P)


@register
def prev_clicked(spark, sf) -> DataFrame:
    return click_features(spark, sf).select(*KEY_COLS, *CLICK_FEATURES[:3])


@register
def new_clicked(spark, sf) -> DataFrame:
    return click_features(spark, sf).select(*KEY_COLS, *CLICK_FEATURES[3:])


@register
def prev_purchased(spark, sf) -> DataFrame:
    return purchase_features(spark, sf).select(*KEY_COLS, *PURCHASE_FEATURES[:3])


@register
def new_purchased(spark, sf) -> DataFrame:
    return purchase_features(spark, sf).select(*KEY_COLS, *PURCHASE_FEATURES[3:])


@register
def click_active_days(spark, sf) -> DataFrame:
    return click_features(spark, sf).where(F.col(CLICK_FEATURES[3]).isNotNull())


@register
def purchase_active_days(spark, sf) -> DataFrame:
    return purchase_features(spark, sf).where(F.col(PURCHASE_FEATURES[3]).isNotNull())


@register
def address_flag(spark, sf) -> DataFrame:
    """Add-address flag per interaction day, flagged days first."""
    b = staging.ga_behavior(_inp(spark, sf), P).where(
        F.col("day").between(F.lit(P.feature_start), F.lit(P.feature_end)))
    cond = families.BEHAVIOR_RULES["HAS_ADD_NEW_ADDRESS_FLAG"]
    return (b.groupBy("customer_id", F.col("day").alias("ga_sessions_date"))
            .agg(F.expr(f"max(CASE WHEN {cond} THEN 1 ELSE 0 END)").alias("add_new_address_flag"))
            .orderBy(F.desc("add_new_address_flag")))


# --- delimited sources and sinks ---------------------------------------------
import uuid  # noqa: E402

from dayguard.session import ensure_checkpoint_dir  # noqa: E402
from dayguard.sources import csvio  # noqa: E402


def _scratch(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"


@register
def csv_roundtrip(spark, sf) -> DataFrame:
    """Feature table -> CSV (NULL as 'NaN', capped files) -> declared-schema read."""
    path = csvio.write_csv(materialised_features(spark, sf), _scratch(spark, "features"),
                           max_records_per_file=1000)
    return csvio.read_csv(spark, path, csvio.FEATURE_SCHEMA)


@register
def union_periods(spark, sf) -> DataFrame:
    """Two training periods exported as gzip CSV, read back and stacked."""
    ft = pipeline.in_training(materialised_features(spark, sf), P)
    mid = P.feature_start + (P.train_end - P.feature_start) // 2
    paths = []
    for name, part in (("p1", ft.where(F.col(KEY_COLS[1]) <= F.lit(mid))),
                       ("p2", ft.where(F.col(KEY_COLS[1]) > F.lit(mid)))):
        paths.append(csvio.write_csv(part, _scratch(spark, name), compression="gzip"))
    return prep.union_periods([csvio.read_csv(spark, p_, csvio.FEATURE_SCHEMA, spread=True) for p_ in paths])


@register
def tsv_labels(spark, sf) -> DataFrame:
    """ATO label file written as TSV (one file) and read with the tolerant reader."""
    lab = _inp(spark, sf).ato_orders
    path = csvio.write_csv(lab, _scratch(spark, "ato_orders"), single_file=True, sep="\t")
    return csvio.read_csv(spark, path, csvio.ATO_LABEL_SCHEMA, sep="\t", tolerant=True)


@register
def csv_byte_capped(spark, sf) -> DataFrame:
    """The feature table exported in files of at most 64 KB, header included, and read back."""
    path = csvio.write_csv(materialised_features(spark, sf), _scratch(spark, "capped"), max_bytes_per_file=65_536)
    return csvio.read_csv(spark, path, csvio.FEATURE_SCHEMA)


@register
def tsv_rejects(spark, sf) -> DataFrame:
    """A label file with damaged lines: what the tolerant reader mends and drops, and the
    kept rows (action 'kept'), which together with the dropped lines are all lines."""
    o, c = F.col("order_id").cast("string"), F.col("customer_id").cast("string")
    k = F.floor(F.col("order_id") / 7) % 10  # every tenth label has each kind of damage
    line = (F.when(k == 1, o).when(k == 2, F.concat_ws("\t", o, c, F.lit("note"))).when(k == 3, F.concat_ws("\t", o, F.lit("n/a")))
            .when(k == 4, F.concat(F.lit("\t"), c)).otherwise(F.concat_ws("\t", o, c)))
    path = _scratch(spark, "damaged")
    _inp(spark, sf).ato_orders.select(line.alias("value")).write.text(path)
    rows, rejects = csvio.read_with_rejects(spark, path, csvio.ATO_LABEL_SCHEMA, header=False, required=("order_id",))
    kept = rows.select(F.concat_ws("|", F.coalesce(F.col("order_id").cast("string"), F.lit("-")),
                                   F.coalesce(F.col("customer_id").cast("string"), F.lit("-"))).alias("record"),
                       F.lit(None).cast("string").alias("reason"), F.lit("kept").alias("action"))
    return kept.unionByName(rejects.select(F.translate("record", "\t", "|").alias("record"), "reason", "action"))


@register
def ato_export(spark, sf) -> DataFrame:
    """ATO rows exported as one CSV file and read back."""
    path = csvio.write_csv(ato_rows(spark, sf), _scratch(spark, "ato_rows"), single_file=True)
    return csvio.read_csv(spark, path, csvio.FEATURE_SCHEMA)


@register
def fraud_export(spark, sf) -> DataFrame:
    """All-fraud rows exported as one CSV file and read back."""
    path = csvio.write_csv(fraud_rows(spark, sf), _scratch(spark, "fraud_rows"), single_file=True)
    return csvio.read_csv(spark, path, csvio.FEATURE_SCHEMA)


# --- models ---------------------------------------------------------------------
from dayguard.operators import autoencoder as ae  # noqa: E402

AE_EPOCHS = 50
AE_BATCH, PARTITIONS = 64, 4  # part of the models' definition


def _all_z(spark, sf) -> DataFrame:
    pr = _prepared(spark, sf)
    sets = (("train", pr.train), ("val", pr.val), ("ato", pr.ato), ("all", pr.allf), ("test", pr.test_normal))
    return prep.union_periods([df.withColumn("dataset", F.lit(n)) for n, df in sets])


def _ae_scores(spark, sf, params, dims=ae.SHAPE_SMALL) -> DataFrame:
    return _all_z(spark, sf).select("dataset", *KEY_COLS, _r(ae.score_column(params, dims), "score"))


@register
def ae_score_fixed(spark, sf) -> DataFrame:
    """Reconstruction loss of the small autoencoder with seeded, fixed weights
    on the standardised train, validation, ATO, all-fraud and test rows."""
    return _ae_scores(spark, sf, ae.init_params(ae.SHAPE_SMALL, seed=42))


@register
def ae_saved_score(spark, sf) -> DataFrame:
    """The same losses with the weights written to the shared folder and read back."""
    path = ae.save(spark, _scratch(spark, "weights"), ae.init_params(ae.SHAPE_SMALL, seed=42))
    return _ae_scores(spark, sf, ae.load(spark, path, ae.SHAPE_SMALL))


def _fixed_loss(dims):
    return F.round(ae.score_column(ae.init_params(dims, seed=42), dims), 6)


def _ae_scored(spark, sf, dims=ae.SHAPE_SMALL) -> DataFrame:
    """Validation rows (label 0) and ATO rows (label 1) with a fixed autoencoder's loss."""
    pr, loss = _prepared(spark, sf), _fixed_loss(dims)
    return evaluate.scored_labels(pr.val.withColumn("score", loss), pr.ato.withColumn("score", loss))


def _ae_cum(spark, sf, dims=ae.SHAPE_SMALL) -> DataFrame:
    key = ("ae_cum", dims, _sid(spark, sf), sf)
    if key not in _CACHE:
        _CACHE[key] = curves.cumulative_counts(_ae_scored(spark, sf, dims))
    return _CACHE[key]


@register
def ae_scored_labels(spark, sf) -> DataFrame:
    return _ae_scored(spark, sf).select(*KEY_COLS, _r("score"), "label")


@register
def ae_roc_curve(spark, sf) -> DataFrame:
    return curves.roc_curve(_ae_cum(spark, sf)).select(_r("threshold"), _r("fpr"), _r("tpr"))


@register
def ae_auc(spark, sf) -> DataFrame:
    return curves.auc(_ae_cum(spark, sf)).select(_r("auc"))


@register
def ae_pr_curve(spark, sf) -> DataFrame:
    return curves.pr_curve(_ae_cum(spark, sf)).select(_r("threshold"), _r("precision"), _r("recall"))


@register
def ae_f1_curve(spark, sf) -> DataFrame:
    return curves.f1_curve(_ae_cum(spark, sf)).select(_r("threshold"), _r("f1"))


@register
def ae_average_precision(spark, sf) -> DataFrame:
    return curves.average_precision(_ae_cum(spark, sf)).select(_r("average_precision"))


# the same evaluation on the large autoencoder, fixed weights
@register
def ae_large_score_fixed(spark, sf) -> DataFrame:
    return _ae_scores(spark, sf, ae.init_params(ae.SHAPE_LARGE, seed=42), ae.SHAPE_LARGE)


@register
def ae_large_roc_curve(spark, sf) -> DataFrame:
    return curves.roc_curve(_ae_cum(spark, sf, ae.SHAPE_LARGE)).select(_r("threshold"), _r("fpr"), _r("tpr"))


@register
def ae_large_auc(spark, sf) -> DataFrame:
    return curves.auc(_ae_cum(spark, sf, ae.SHAPE_LARGE)).select(_r("auc"))


@register
def ae_large_pr_curve(spark, sf) -> DataFrame:
    return curves.pr_curve(_ae_cum(spark, sf, ae.SHAPE_LARGE)).select(_r("threshold"), _r("precision"), _r("recall"))


@register
def ae_large_f1_curve(spark, sf) -> DataFrame:
    return curves.f1_curve(_ae_cum(spark, sf, ae.SHAPE_LARGE)).select(_r("threshold"), _r("f1"))


@register
def ae_large_period_confusion(spark, sf) -> DataFrame:
    """Weekly false and true positives at loss >= 4.3, large autoencoder with fixed weights."""
    pr, loss = _prepared(spark, sf), _fixed_loss(ae.SHAPE_LARGE)
    scored = evaluate.scored_labels(pr.test_normal.withColumn("score", loss), pipeline.in_test(pr.ato, P).withColumn("score", loss))
    return evaluate.period_confusion(scored, THRESHOLD, P.period)


def _ae_trained(spark, sf) -> ae.TrainResult:
    key = ("ae", _sid(spark, sf), sf)
    if key not in _CACHE:
        pr = _prepared(spark, sf)
        _CACHE[key] = ae.train(pr.train, pr.val, ae.SHAPE_LARGE, epochs=AE_EPOCHS, batch=AE_BATCH,
                               partitions=PARTITIONS)
    return _CACHE[key]


@register
def ae_train(spark, sf) -> DataFrame:
    """Best-epoch weights of the large autoencoder as (tensor, row, col, value)."""
    return ae.weights_frame(spark, _ae_trained(spark, sf).params)


@register
def ae_history(spark, sf) -> DataFrame:
    """Per-epoch mean training and validation loss and learning rate."""
    return ae.history_frame(spark, _ae_trained(spark, sf))


from dayguard.functions.quantile import exact_quantile  # noqa: E402
from dayguard.operators import iforest  # noqa: E402

IFOREST_CONTAMINATIONS = [0.1, 0.05, 0.01]


def _forest(spark, sf):
    key = ("if", _sid(spark, sf), sf)
    if key not in _CACHE:
        _CACHE[key] = iforest.fit(_prepared(spark, sf).train, n_trees=100, max_samples=100,
                                  contamination=IFOREST_CONTAMINATIONS, seed=42)
    return _CACHE[key]


def _eval_sets(spark, sf) -> DataFrame:
    pr = _prepared(spark, sf)
    return prep.union_periods([df.withColumn("dataset", F.lit(n)) for n, df in
                               (("val", pr.val), ("ato", pr.ato), ("all", pr.allf))])


@register
def iforest_train(spark, sf) -> DataFrame:
    """Node table of the fitted forest (tree, node, feature, threshold, ...)."""
    return _forest(spark, sf)[1]


@register
def iforest_score(spark, sf) -> DataFrame:
    """Anomaly score and -1/+1 label (one per contamination) of validation, ATO and
    all-fraud rows under the fitted forest."""
    forest = _forest(spark, sf)[0]
    scored = _eval_sets(spark, sf).select(*KEY_COLS, "dataset", iforest.score_column(forest).alias("s"))
    return scored.select(*KEY_COLS, "dataset", _r("s", "score"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("contamination"), F.when(-F.col("s") < F.lit(o), -1).otherwise(1).alias("pred"))
        for c, o in forest.offsets.items()])).alias("p")).select("*", "p.contamination", "p.pred").drop("p")


FIXED_TREES, FIXED_SAMPLES, FIXED_CONTAMINATION = 25, 64, 0.05


def _fixed_scores(spark, sf) -> DataFrame:
    """Scores of all five sets under a seeded forest that no data takes part in."""
    boxes = iforest.leaf_boxes(iforest.fixed_forest(FIXED_TREES, FIXED_SAMPLES, len(FEATURES)))
    return iforest.score_by_boxes(_all_z(spark, sf), boxes, FIXED_SAMPLES, ["dataset", *KEY_COLS])


@register
def iforest_score_fixed(spark, sf) -> DataFrame:
    """Anomaly score of every row by a lookup in the fixed forest's leaf boxes."""
    return _fixed_scores(spark, sf).select("dataset", *KEY_COLS, _r("score"))


@register
def iforest_rates_fixed(spark, sf) -> DataFrame:
    """Outliers per set at the training scores' contamination quantile, fixed forest."""
    s = _fixed_scores(spark, sf).withColumn("neg", -F.round("score", 9))
    cut = exact_quantile(s.where("dataset = 'train'"), "neg", FIXED_CONTAMINATION)
    return evaluate.outlier_rates(s.withColumn("pred", F.when(F.col("neg") < F.lit(cut), -1).otherwise(1)))


from dayguard.operators import ocsvm  # noqa: E402

SVM_NU = 0.01
SVM_NUS = [0.1, 0.01, 0.001]
SVM_GAMMA = 0.1


def _svms(spark, sf) -> list[ocsvm.OneClassModel]:
    key = ("svm", _sid(spark, sf), sf)
    if key not in _CACHE:
        train = _prepared(spark, sf).train
        frame = ae.training_frame(train, train.where(F.lit(False)), partitions=PARTITIONS)
        _CACHE[key] = ocsvm.fit_all(train, SVM_NUS, gamma=SVM_GAMMA, batch=AE_BATCH, frame=frame)
    return _CACHE[key]


@register
def ocsvm_train(spark, sf) -> DataFrame:
    """Fitted one-class models: coefficient per Fourier component, and rho (component -1), per nu."""
    rows = [(m.nu, i, float(c)) for m in _svms(spark, sf) for i, c in [*enumerate(m.coef), (-1, m.rho)]]
    return spark.createDataFrame(rows, "nu double, component int, value double")


@register
def ocsvm_score(spark, sf) -> DataFrame:
    """Decision value and -1/+1 label of validation, ATO and all-fraud rows per nu
    (SGD-trained one-class models)."""
    z = _eval_sets(spark, sf)
    return prep.union_periods([z.select(*KEY_COLS, "dataset", F.lit(m.nu).alias("nu"), _r(ocsvm.decision_column(m), "decision"),
                                        ocsvm.predict_column(m).alias("pred")) for m in _svms(spark, sf)])


@register
def ocsvm_score_fixed(spark, sf) -> DataFrame:
    """Kernel-mean one-class model (seeded Fourier map, coefficients = mean
    feature vector of the training rows, offset = exact nu-quantile): decision
    and label of validation, ATO and all-fraud rows."""
    key = ("svm0", _sid(spark, sf), sf)
    if key not in _CACHE:
        _CACHE[key] = ocsvm.fit(_prepared(spark, sf).train, nu=SVM_NU, gamma=SVM_GAMMA, epochs=0)
    m = _CACHE[key]
    return _eval_sets(spark, sf).select(
        *KEY_COLS, "dataset", F.round(ocsvm.decision_column(m), 6).alias("decision"),
        ocsvm.predict_column(m).alias("pred"))


@register
def ocsvm_rates_fixed(spark, sf) -> DataFrame:
    """Outlier rates of the fixed kernel-mean model per dataset."""
    return evaluate.outlier_rates(ocsvm_score_fixed(spark, sf))


@register
def ae_period_confusion(spark, sf) -> DataFrame:
    """Weekly false / true positives at loss >= 4.3 with the trained large
    autoencoder on test-period normal rows and ATO rows."""
    res = _ae_trained(spark, sf)
    pr = _prepared(spark, sf)
    loss = ae.score_column(res.params, res.dims)
    scored = evaluate.scored_labels(pr.test_normal.withColumn("score", loss),
                                    pipeline.in_test(pr.ato, P).withColumn("score", loss))
    return evaluate.period_confusion(scored, THRESHOLD, P.period)


@register
def ae_train_small(spark, sf) -> DataFrame:
    """Best-epoch weights of the small autoencoder (36-15-7-2-7-15-36)."""
    key = ("ae_small", _sid(spark, sf), sf)
    if key not in _CACHE:
        pr = _prepared(spark, sf)
        _CACHE[key] = ae.train(pr.train, pr.val, ae.SHAPE_SMALL, epochs=AE_EPOCHS, batch=AE_BATCH,
                               partitions=PARTITIONS)
    return ae.weights_frame(spark, _CACHE[key].params)


@register
def iforest_rates(spark, sf) -> DataFrame:
    """Forest outliers per contamination and dataset: false positives on validation, true
    positives on ATO and all-fraud rows, with their rates."""
    return _rates(iforest_score(spark, sf), "contamination")


def _rates(scored: DataFrame, by: str) -> DataFrame:
    both = scored.withColumn("dataset", F.struct("dataset", by))
    return evaluate.outlier_rates(both).select("dataset.*", "n_rows", "n_outliers", "outlier_rate")


@register
def ocsvm_rates(spark, sf) -> DataFrame:
    """One-class SVM per nu: false positive rate on validation, ATO and all-fraud recall."""
    return _rates(ocsvm_score(spark, sf), "nu")


# --- incremental feature table --------------------------------------------------
import dataclasses  # noqa: E402

from dayguard.operators.state import FeatureState  # noqa: E402
from dayguard.session import stored  # noqa: E402

BATCH_DAYS = 10


ARRIVING = {"order_line": "order_placed_dttm", "ga_sessions": "ga_sessions_date", "hits_products": "ga_sessions_date",
            "hits_union": "ga_sessions_date"}


def _batch_number(day: str):
    due = F.least(F.ceil(F.dayofmonth(day) / BATCH_DAYS), F.lit(3)).cast("int")
    late = (F.col("customer_id") % 5 == 0) & F.dayofmonth(day).isin(6, 14, 15)
    return F.coalesce(F.when(late, F.lit(3)).otherwise(due), F.lit(1))


def batch_of(inp, number: int):
    """The inputs' rows that arrive in batch 1, 2 or 3: ten days each, and every fifth
    customer's rows of some early days only with the third batch."""
    return dataclasses.replace(inp, **{n: getattr(inp, n).where(_batch_number(day) == number) for n, day in ARRIVING.items()})


def arrivals(inp):
    """``batch_of`` as a function of the number, over inputs that are built once for all batches."""
    kept = {n: stored(getattr(inp, n).withColumn("_batch", _batch_number(day))) for n, day in ARRIVING.items()}
    return lambda number: dataclasses.replace(inp, **{n: df.where(F.col("_batch") == number).drop("_batch") for n, df in kept.items()})


@register
def feature_table_incremental(spark, sf) -> DataFrame:
    """The feature table kept up to date over three batches with late rows."""
    state = FeatureState.open(spark, _scratch(spark, "state"), P, buckets=8)
    batch = arrivals(_inp(spark, sf))
    for number in (1, 2, 3):
        state = state.append(f"batch {number}", batch(number))
    return state.features()


# --- synchronous training ---------------------------------------------------------
from dayguard.operators import syncfit  # noqa: E402

SYNC_EPOCHS, SYNC_BATCH = 10, 2048


@register
def ae_full_batch_step(spark, sf) -> DataFrame:
    """Mean gradient over all training rows of the small autoencoder with seeded weights, and
    the weights after one Adam step."""
    g, w = syncfit.full_batch_step(_prepared(spark, sf).train, ae.SHAPE_SMALL, ae.init_params(ae.SHAPE_SMALL, seed=42))
    both = ae.weights_frame(spark, g).withColumnRenamed("value", "gradient").join(ae.weights_frame(spark, w), ["tensor", "row", "col"])
    return both.select("tensor", "row", "col", (_r("gradient") + F.lit(0.0)).alias("gradient"), _r("value"))


@register
def ae_train_sync(spark, sf) -> DataFrame:
    """Loss per epoch of the large autoencoder trained step by step over one global shuffle."""
    pr = _prepared(spark, sf)
    res = syncfit.train(pr.train, pr.val, ae.SHAPE_LARGE, epochs=SYNC_EPOCHS, batch=SYNC_BATCH)
    return ae.history_frame(spark, res)


# --- dual one-class SVM -----------------------------------------------------------
from dayguard.operators import ocsvm_dual  # noqa: E402

DUAL_LANDMARKS = 64


def _duals(spark, sf) -> list[ocsvm_dual.DualModel]:
    key = ("dual", _sid(spark, sf), sf)
    if key not in _CACHE:
        _CACHE[key] = ocsvm_dual.fit(_prepared(spark, sf).train, SVM_NUS, gamma=SVM_GAMMA, landmarks=DUAL_LANDMARKS)
    return _CACHE[key]


@register
def ocsvm_dual_train(spark, sf) -> DataFrame:
    """Dual one-class models per nu: squared norm, offset, duality gap, rounds."""
    rows = [(m.nu, float(m.w @ m.w), float(m.rho), m.gap, m.rounds) for m in _duals(spark, sf)]
    return spark.createDataFrame(rows, "nu double, norm2 double, rho double, gap double, rounds int")


@register
def ocsvm_dual_rates(spark, sf) -> DataFrame:
    """Dual one-class SVM per nu: outlier shares of training, validation, ATO and all-fraud rows."""
    z = _eval_sets(spark, sf).unionByName(_prepared(spark, sf).train.withColumn("dataset", F.lit("train")))
    scored = prep.union_periods([z.select("dataset", F.lit(m.nu).alias("nu"), ocsvm_dual.predict_column(m).alias("pred"))
                                 for m in _duals(spark, sf)])
    return _rates(scored, "nu")
