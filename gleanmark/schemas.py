"""Declared schemas, as DDL: nothing is inferred at read time."""

from __future__ import annotations

# Corpora and exports
HIERARCHICAL_CORPUS = (
    "flags string, instruction string, category string, intent string, response string"
)
FLAT_CORPUS = ("text string, label int, label_name string")
LABEL_DICTIONARY = ("label int, label_name string")
INSTRUCTION = ("instruction string, input string, output string")
CHAT = ("messages array<struct<role:string,content:string>>")
GENERATION = (
    "text string, gold string, pred_raw string, pred_intent string, "
    "parse_error boolean, parse_path string"
)
ERROR_ROW = (
    "text string, true_label string, predicted_label string, confidence double, text_length int"
)
TIMING = ("sample_idx long, elapsed_ms double")

# Run documents
_METRICS = (
    "struct<accuracy:double,macro_f1:double,macro_precision:double,macro_recall:double,"
    "weighted_f1:double,per_class:map<string,struct<precision:double,recall:double,"
    "f1:double,support:bigint>>>"
)
RUN = (
    "run_id string, dataset string, model string, model_name string, model_family string, "
    "test_set_hash string, n_samples long, seed long, training_wallclock_seconds double, "
    f"metrics struct<intent:{_METRICS},intent_val:{_METRICS}>, "
    "latency struct<p50_ms:double,p95_ms:double,p99_ms:double,mean_ms:double,std_ms:double,"
    "throughput_per_sec:double,n_samples_timed:bigint>, "
    "resources struct<parameters_total:bigint,parameters_trainable:bigint,disk_size_mb:double,"
    "vocab_size:bigint>, "
    "parse_errors long, parse_path_counts map<string,bigint>"
)
TRAINING_LOG = (
    "run_id string, step long, epoch double, loss double, grad_norm double, learning_rate double, "
    "eval_loss double, eval_accuracy double, eval_macro_f1 double, train_runtime double"
)

# The tables queries read
TABLES = {
    "region": ("r_regionkey int, r_name string"),
    "nation": ("n_nationkey int, n_name string, n_regionkey int"),
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "events": (
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ),
    "documents": ("doc_id long, text string, lang string, source string, n_chars long"),
    "labels": ("doc_id long, quality int, toxic int"),
    "benchmark": ("item_id long, text string"),
    "conversations": ("conv_id long, turn long, role string, text string"),
    "pages": ("page_id long, url string, html string"),
}
