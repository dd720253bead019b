"""Models on Spark ML (inventory M1-M4, M15, Q5, Q8, P18).

The source trains gradient-boosted trees with native categorical handling on
a GPU.  Here the same model family runs on ``pyspark.ml``:
``GBTClassifier`` with ``weightCol`` (class weights, L5) and
``validationIndicatorCol`` (early stopping on the validation rows), on
features assembled by ``VectorAssembler`` after imputation (P18).
High-cardinality keys enter as numeric codes plus their smoothed priors /
causal target encodings (A4, F6) rather than as one-hot vectors.  Training
is distributed; nothing is converted to pandas.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.priors import fill_with_median
from kestrel.operators.sampling import red_given_susp_weight
from kestrel.operators.scoring import logit, product_score

# Boosting limits of the source; early stopping ends a fit long before.
MAX_TREES = 5000
#: Least number of trees of a refit.
REFIT_LEAST = 300
DEFAULT_PARAMS = {"maxIter": MAX_TREES, "maxDepth": 4, "stepSize": 0.1, "seed": 42}
RG_PARAMS = {"maxIter": MAX_TREES, "maxDepth": 3, "stepSize": 0.05, "seed": 42}

# Column groups of the feature frame.
CAT_COLS = ["event_type_nm", "event_desc", "channel_indicator_type", "channel_indicator_sub_type",
            "currency_iso_cd", "mcc_code_i", "pos_cd", "timezone", "operating_system_type",
            "phone_voip_call_state", "web_rdp_connection", "developer_tools_i", "compromised_i",
            "prev_mcc_code_i", "accept_language_i", "browser_language_i", "device_fp_i"]
FB_COLS = ["cust_prev_red_lbl_cnt", "cust_prev_yellow_lbl_cnt", "cust_prev_labeled_cnt",
           "cust_prev_red_lbl_rate", "cust_prev_yellow_lbl_rate", "cust_prev_susp_lbl_rate",
           "cust_prev_any_red_flag", "cust_prev_any_yellow_flag", "sec_since_prev_red_lbl",
           "sec_since_prev_yellow_lbl", "cnt_prev_labeled_same_desc", "cnt_prev_red_same_desc_lbl",
           "cnt_prev_yellow_same_desc_lbl", "red_rate_prev_same_desc_lbl"]
META_COLS = {"event_id", "customer_id", "period", "event_ts", "ets", "is_train_sample", "is_test",
             "train_target_raw", "target_bin", "target", "keep_green", "event_date", "is_val",
             "in_train_part", "in_fit", "w_main", "w_susp", "y_susp", "in_recent", "is_red_lbl",
             "is_yellow_lbl", "is_labeled_fb", "prev_ets", "prev_amt", "prev_session_id",
             "cust_event_idx"}

# Feature groups for the importance report (M15), by name prefix.
FEATURE_GROUPS = [
    ("device", ("device_", "cust_prev_mean_amt_same_device", "amt_vs_same_device_mean", "null_")),
    ("velocity", ("cnt_", "amt_sum_", "max_amt_last", "burst_", "spend_", "voip_", "unique_mcc",
                  "tz_change", "amt_ratio_24h", "amt_vs_1h", "amt_vs_24h", "velocity_", "mcc_scatter")),
    ("prior", ("prior_", "risk_new_")),
    ("profile", ("profile_", "amt_over_profile", "amt_profile", "amt_drift", "hour_drift",
                 "mcc_diversity")),
    ("history", ("cust_", "sec_since", "is_new_", "_log_cnt", "amt_avg_", "amt_momentum",
                 "markov_", "events_before", "today_", "session_", "days_since")),
]


def feature_columns(df: DataFrame, with_feedback: bool = False) -> list[str]:
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint", "boolean"}
    cols = [f.name for f in df.schema.fields
            if f.dataType.simpleString() in numeric and f.name not in META_COLS
            and (with_feedback or f.name not in FB_COLS)]
    return cols


def prepare(df: DataFrame, cols: list[str], train_ref: DataFrame | None = None) -> DataFrame:
    """Categorical -> -1, feedback -> 0, other numeric -> training median; assemble."""
    cat = [c for c in cols if c in CAT_COLS]
    fb = [c for c in cols if c in FB_COLS]
    num = [c for c in cols if c not in cat and c not in fb]
    df = df.fillna(-1, subset=cat).fillna(0, subset=fb)
    df = fill_with_median(df, num, ref=train_ref)
    # a column null on every training row has no median: it becomes 0
    df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
    plain = [c for c in cols if c not in FB_COLS]
    df = VectorAssembler(inputCols=plain, outputCol="features", handleInvalid="keep").transform(df)
    # the feedback model sees the label history as well
    return VectorAssembler(inputCols=[*plain, *fb], outputCol="features_fb", handleInvalid="keep").transform(df)


def fit_gbt(df: DataFrame, label: str, weight: str | None, val_col: str | None,
            params: dict | None = None, features: str = "features"):
    """M1: weighted GBT; early stopping on ``val_col`` rows when given."""
    p = dict(DEFAULT_PARAMS, **(params or {}))
    gbt = GBTClassifier(labelCol=label, featuresCol=features, **p)
    if weight:
        gbt = gbt.setWeightCol(weight)
    if val_col:
        gbt = gbt.setValidationIndicatorCol(val_col)
    return gbt.fit(df)


def refit_gbt(df: DataFrame, label: str, weight: str | None, fitted, params: dict | None = None,
              features: str = "features", least: int = REFIT_LEAST):
    """M2: refit on all rows with ``max(least, best)`` trees, best = the early-stopped size of ``fitted`` (a model or a number)."""
    size = max(least, fitted if isinstance(fitted, int) else fitted.getNumTrees)
    return fit_gbt(df, label, weight, None, dict(params or {}, maxIter=size), features)


#: Rows of a training frame's partition, at about.
FIT_ROWS = 30_000


def dealt(df: DataFrame) -> DataFrame:
    """A materialised training frame in partitions of about ``FIT_ROWS`` rows.

    A tree is some ten jobs of a task each partition: partitions of a few rows, as joins leave them, cost more than the rows.
    """
    return df.coalesce(max(1, -(-df.count() // FIT_ROWS)))


#: Fits that run at the same time: a tree is some small jobs, in which one fit leaves most cores idle.
PARALLEL = 5


def fitted(fits: dict, parallel: int = PARALLEL) -> dict:
    """Results of independent fits under their names, ``parallel`` at a time."""
    own = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(parallel) as pool:
        started = {name: pool.submit(own(fit)) for name, fit in fits.items()}
        return {name: x.result() for name, x in started.items()}


def fit_family(df: DataFrame, val_col: str = "is_val", trees: int = MAX_TREES) -> dict:
    """M1, M3: MAIN, RECENT, SUSP, RED-given-SUSP and FEEDBACK models of at most ``trees`` trees."""
    p = {"maxIter": trees}
    lab = df.filter(F.col("train_target_raw") != -1).withColumn("w_rg", red_given_susp_weight())
    susp = df.withColumn("y_susp", F.col("y_susp").cast("double"))
    return fitted({
        "main": lambda: fit_gbt(df, "target_bin", "w_main", val_col, p),
        "recent": lambda: fit_gbt(df.filter(F.col("in_recent")), "target_bin", "w_main", val_col, p),
        "susp": lambda: fit_gbt(susp, "y_susp", "w_susp", val_col, p),
        "rg": lambda: fit_gbt(lab, "target_bin", "w_rg", val_col, dict(RG_PARAMS, **p)),
        "fb": lambda: fit_gbt(df, "target_bin", "w_main", val_col, p, "features_fb"),
    })


def save_family(models: dict, path: str) -> None:
    """Fitted models under their names, to be scored or refitted by a later run."""
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/{name}")


def load_family(path: str, names: tuple[str, ...] = ("main", "recent", "susp", "rg", "fb")) -> dict:
    return {name: GBTClassificationModel.load(f"{path}/{name}") for name in names}


def score_family(models: dict, df: DataFrame) -> DataFrame:
    """M4, M5: logit scores of all models and the product score."""
    for name, model in models.items():
        df = raw_margin(model, df, f"s_{name}")
    return df.withColumn("s_prod", product_score(F.col("s_susp"), F.col("s_rg")))


def raw_margin(model, df: DataFrame, out: str) -> DataFrame:
    """M4: logit-scale score (Spark's GBT probability is sigmoid(2 * margin))."""
    pred = model.transform(df.drop("rawPrediction", "probability", "prediction"))
    return pred.withColumn(out, logit(vector_to_array("probability")[1])).drop(
        "rawPrediction", "probability", "prediction")


def importance_by_group(model, cols: list[str]) -> list[tuple[str, str, float]]:
    """M15 input: (feature, group, importance)."""
    imp = model.featureImportances.toArray()
    out = []
    for c, v in zip(cols, imp):
        grp = "raw"
        for g, prefixes in FEATURE_GROUPS:
            if any(c.startswith(p) or p in c for p in prefixes):
                grp = g
                break
        out.append((c, grp, float(v)))
    return out


def word2vec_embeddings(seqs: DataFrame, field: str = "mcc_seq", size: int = 16,
                        seed: int = 42, partitions: int = 8) -> DataFrame:
    """Q5 (re-aimed): Word2Vec over per-customer code sequences; customer vector = mean."""
    toks = seqs.select("customer_id", F.transform(field, lambda x: F.concat(
        F.lit("t"), x.cast("string"))).alias("tokens"))
    w2v = Word2Vec(vectorSize=size, minCount=1, maxIter=1, seed=seed, inputCol="tokens",
                   outputCol="vec", numPartitions=partitions)
    model = w2v.fit(toks)
    return model.transform(toks).select("customer_id",
                                        vector_to_array("vec", "float32").alias("embedding"))


def join_embeddings(rows: DataFrame, emb: DataFrame, size: int) -> DataFrame:
    """Q8: left join by customer; missing vectors become zeros."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), size)
    return rows.join(emb, "customer_id", "left").withColumn(
        "embedding", F.coalesce(F.col("embedding"), zero))
