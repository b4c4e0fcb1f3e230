"""The monitoring tables, derived from a folder of Parquet tables.

Every table is a lazy DataFrame over whole inputs. Texts are joined in only by the callers that read them
(`with_texts`), so counters and gauges never touch the documents.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def logs_from_events(events: DataFrame) -> DataFrame:
    """Prediction log columns of an event table or stream."""
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    return events.selectExpr(
        "event_id AS id",
        "concat('dep-', CAST(user_id % 5 AS STRING)) AS deployment_id",
        "concat('req-', CAST(event_id AS STRING)) AS request_id",
        f"CASE WHEN {k} >= 50 THEN 1 ELSE 0 END AS predicted_label",
        f"CASE WHEN {k} >= 50 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS predicted_sentiment",
        "round(CAST(100 AS DOUBLE) / (100 + value), 6) AS confidence_score",
        "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS prediction_time",
        f"concat('v', CAST({k} % 3 AS STRING)) AS model_version",
        "event_type AS endpoint",
        "event_type = 'error' AS is_error",
        "ts AS predicted_at",
        "CASE event_type WHEN 'purchase' THEN true WHEN 'error' THEN false END AS is_correct",
        "user_id AS client_id",
        "props AS metadata",
    )


def alert_events_from_lines(lines: DataFrame) -> DataFrame:
    """Acknowledge and resolve actions on alerts, one per order line of a table or stream."""
    return lines.selectExpr(
        "l_orderkey AS alert_id",
        "l_partkey * 100000000 + l_suppkey * 10 + l_linenumber AS seq",
        "CASE WHEN l_returnflag = 'R' THEN 'resolve' ELSE 'acknowledge' END AS action",
        "concat('user-', CAST(l_suppkey AS STRING)) AS actor",
        "CASE WHEN l_linestatus = 'F' THEN concat('note ', CAST(l_linenumber AS STRING)) END AS notes",
        "l_shipdate AS happened_at",
    )


class Tables:
    """Lazy canonical tables over `folder`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        """The texts."""
        return self.raw("documents")

    def stream(self, name: str) -> DataFrame:
        """One table as a file stream; its files are taken in as they arrive."""
        reader = self.spark.readStream.schema(self.raw(name).schema).option("pathGlobFilter", f"{name}.parquet")
        return reader.parquet(self.folder)

    @cached_property
    def logs(self) -> DataFrame:
        """One prediction per event, without its text."""
        return logs_from_events(self.raw("events"))

    def with_texts(self, logs: DataFrame) -> DataFrame:
        """Add the input text and its hash: the texts go round all documents, so texts and hashes repeat."""
        documents = self.documents.select("doc_id", F.col("text").alias("input_text"))
        n_documents = self.raw("documents").select(F.count("*")).scalar()
        keyed = logs.withColumn("doc_id", F.col("id") % n_documents)
        hashed = documents.withColumn("input_hash", F.sha2("input_text", 256))
        return keyed.join(hashed, "doc_id").drop("doc_id")

    @cached_property
    def alerts(self) -> DataFrame:
        """One alert per order; the resolution join is dropped by Catalyst when `resolved_at` is not read."""
        shipped = self.raw("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("m"))
        orders = self.raw("orders")
        return orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left").selectExpr(
            "o_orderkey AS id",
            "CASE o_orderkey % 5 WHEN 0 THEN 'DATA_DRIFT' WHEN 1 THEN 'CONCEPT_DRIFT' WHEN 2 THEN 'MODEL_DRIFT' "
            "WHEN 3 THEN 'PERFORMANCE' ELSE 'SYSTEM_HEALTH' END AS alert_type",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' "
            "WHEN '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS severity",
            "CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'ACKNOWLEDGED' ELSE 'RESOLVED' END AS status",
            "concat('dep-', CAST(o_custkey % 5 AS STRING)) AS deployment_id",
            "o_totalprice AS metric_value",
            "o_orderdate AS triggered_at",
            "CASE WHEN o_orderstatus = 'F' AND m > o_orderdate THEN m END AS resolved_at",
        )

    @cached_property
    def alert_events(self) -> DataFrame:
        """Actions on alerts."""
        return alert_events_from_lines(self.raw("lineitem"))

    @cached_property
    def dataset_metrics(self) -> DataFrame:
        """Monthly quality history per dataset and split."""
        return (
            self.raw("lineitem")
            .selectExpr(
                "concat(l_returnflag, '-', l_linestatus) AS dataset_name",
                "CASE l_linenumber % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split_name",
                "CAST(trunc(l_shipdate, 'MM') AS TIMESTAMP_NTZ) AS computed_at",
                "CAST(l_quantity AS INT) AS quantity",
                "CAST(round(l_discount * 100) AS INT) AS discount",
                "CAST(round(l_tax * 100) AS INT) AS tax",
                "l_discount",
                "l_tax",
            )
            .groupBy("dataset_name", "split_name", "computed_at")
            .agg(
                F.count("*").alias("num_examples"),
                F.expr("CAST(sum(quantity) AS DOUBLE) / count(*)").alias("avg_text_length"),
                F.expr("1 - CAST(sum(discount) AS DOUBLE) / (100 * count(*))").alias("quality_score"),
                F.expr("1 - CAST(sum(tax) AS DOUBLE) / (100 * count(*))").alias("completeness_score"),
                F.expr("round(1 - max(l_discount), 2)").alias("consistency_score"),
                F.expr("round(1 - max(l_tax), 2)").alias("validity_score"),
                F.expr(
                    "CASE WHEN count(*) % 4 = 0 THEN NULL ELSE CAST(sum(discount) AS DOUBLE) / (100 * count(*)) END"
                ).alias("drift_score"),
            )
        )

    @cached_property
    def runs(self) -> DataFrame:
        """One experiment run per part."""
        return self.raw("part").selectExpr(
            "p_partkey AS id",
            "concat('mlf-', CAST(p_partkey AS STRING)) AS mlflow_run_id",
            "p_brand AS experiment_name",
            "p_name AS run_name",
            "CASE p_size % 3 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'COMPLETED' ELSE 'FAILED' END AS status",
            "CASE WHEN p_size % 7 = 0 THEN NULL ELSE round(p_size / CAST(51 AS DOUBLE), 6) END AS accuracy",
            "CASE WHEN p_size % 5 = 0 THEN NULL "
            "ELSE round((p_size + p_partkey % 3) / CAST(53 AS DOUBLE), 6) END AS f1_score",
            "p_retailprice AS training_duration",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(p_partkey AS INT), 0) AS created_at",
            "to_json(named_struct('learning_rate', p_retailprice / 1000, 'epochs', p_size % 5)) AS hyperparameters",
        )

    @cached_property
    def run_changes(self) -> DataFrame:
        """Field updates of runs, NULL values included; one per order line."""
        return self.raw("lineitem").selectExpr(
            "l_partkey AS run_id",
            "l_orderkey * 100000000 + l_suppkey * 10 + l_linenumber AS seq",
            "CASE l_linenumber % 4 WHEN 0 THEN 'status' WHEN 1 THEN 'accuracy' "
            "WHEN 2 THEN 'f1_score' ELSE 'no_such_field' END AS field",
            "CASE WHEN l_linenumber % 4 = 0 THEN l_returnflag WHEN l_tax = 0 THEN NULL "
            "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS value",
            "l_shipdate AS changed_at",
        )

    @cached_property
    def checkpoints(self) -> DataFrame:
        """Evaluation results along a training run, one per order line of the run's part."""
        return self.raw("lineitem").selectExpr(
            "l_partkey AS run_id",
            "l_orderkey AS epoch",
            "l_suppkey * 10 + l_linenumber AS step",
            "round(0.8 + l_discount, 2) AS eval_f1",
            "round(0.4 - l_tax, 2) AS eval_loss",
        )

    @cached_property
    def deployments(self) -> DataFrame:
        """One deployment per supplier."""
        return self.raw("supplier").selectExpr(
            "concat('dep-', CAST(s_suppkey AS STRING)) AS id",
            "s_suppkey * 3 AS experiment_run_id",
            "s_name AS deployment_name",
            "CASE s_suppkey % 4 WHEN 0 THEN 'DEPLOYING' WHEN 1 THEN 'ACTIVE' "
            "WHEN 2 THEN 'INACTIVE' ELSE 'FAILED' END AS status",
            "s_acctbal AS avg_response_time",
        )

    @cached_property
    def deployment_changes(self) -> DataFrame:
        """Status and metric updates of deployments; NULL means the argument was not given."""
        return self.raw("events").selectExpr(
            "concat('dep-', CAST(user_id % 40 AS STRING)) AS deployment_id",
            "event_id AS seq",
            "CASE event_type WHEN 'signup' THEN 'ACTIVE' WHEN 'error' THEN 'FAILED' END AS status",
            "CASE WHEN event_type = 'error' THEN 'UNHEALTHY' WHEN event_type = 'signup' AND value > 50 "
            "THEN 'HEALTHY' END AS health_status",
            "CASE WHEN event_type = 'purchase' THEN CAST(get_json_object(props, '$.k') AS INT) END AS request_count",
            "CASE WHEN event_type IN ('purchase', 'click') THEN value END AS avg_response_time",
            "CASE WHEN event_type = 'view' THEN round(value / 1000, 5) END AS error_rate",
            "ts AS changed_at",
        )

    @cached_property
    def feedback(self) -> DataFrame:
        """Feedback on predictions, one per conversation turn, valid or not."""
        return self.raw("conversations").selectExpr(
            "conv_id * 10 + turn AS prediction_id",
            "turn % 2 = 0 AS is_correct",
            "CASE WHEN length(text) % 7 = 0 THEN NULL ELSE (length(text) % 120) / CAST(100 AS DOUBLE) END "
            "AS feedback_score",
            "text AS comments",
        )

    @cached_property
    def labelled_texts(self) -> DataFrame:
        """Documents with optional labels, a weak classifier's output and a fixed split."""
        # one row per document, so that Catalyst drops the join where no label is read
        labels = self.raw("labels").groupBy(F.col("doc_id").alias("labelled_id")).agg(
            F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
        )
        documents = self.documents
        return documents.join(labels, documents.doc_id == labels.labelled_id, "left").selectExpr(
            "doc_id",
            "text",
            "lang",
            "quality AS label",
            "toxic",
            "CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS predicted_label",
            "CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 = 7 THEN 'validation' ELSE 'test' END AS split",
        )

    @cached_property
    def text_batches(self) -> DataFrame:
        """Batch requests: the lines of one document, with the time the whole batch took."""
        return self.documents.selectExpr(
            "concat('batch-', CAST(doc_id AS STRING)) AS request_id",
            r"split(text, '\n') AS texts",
            "CAST(n_chars AS DOUBLE) AS total_time_ms",
        )

    @cached_property
    def logits(self) -> DataFrame:
        """Two-class scores."""
        return self.raw("embeddings").selectExpr(
            "vec_id", "CAST(embedding[0] AS DOUBLE) AS z0", "CAST(embedding[1] AS DOUBLE) AS z1", "label % 2 AS label"
        )
