"""The canonical tables in DuckDB SQL, for the oracle side of the checks."""

VIEWS = {
    "prediction_logs": """
        SELECT event_id AS id, concat('dep-', CAST(user_id % 5 AS VARCHAR)) AS deployment_id,
          concat('req-', CAST(event_id AS VARCHAR)) AS request_id,
          CASE WHEN k >= 50 THEN 1 ELSE 0 END AS predicted_label,
          CASE WHEN k >= 50 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS predicted_sentiment,
          round(CAST(100 AS DOUBLE) / (100 + value), 6) AS confidence_score,
          CASE WHEN event_type = 'error' THEN NULL ELSE value END AS prediction_time,
          concat('v', CAST(k % 3 AS VARCHAR)) AS model_version, event_type AS endpoint,
          event_type = 'error' AS is_error, ts AS predicted_at,
          CASE event_type WHEN 'purchase' THEN true WHEN 'error' THEN false END AS is_correct,
          user_id AS client_id, props AS metadata
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)""",
    # needs prediction_logs
    "text_logs": """
        SELECT p.*, d.text AS input_text, sha256(d.text) AS input_hash
        FROM prediction_logs p JOIN documents d ON d.doc_id = p.id % (SELECT count(*) FROM documents)""",
    "monitoring_alerts": """
        SELECT o_orderkey AS id,
          CASE o_orderkey % 5 WHEN 0 THEN 'DATA_DRIFT' WHEN 1 THEN 'CONCEPT_DRIFT' WHEN 2 THEN 'MODEL_DRIFT'
            WHEN 3 THEN 'PERFORMANCE' ELSE 'SYSTEM_HEALTH' END AS alert_type,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM'
            ELSE 'LOW' END AS severity,
          CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'ACKNOWLEDGED' ELSE 'RESOLVED' END AS status,
          concat('dep-', CAST(o_custkey % 5 AS VARCHAR)) AS deployment_id, o_totalprice AS metric_value,
          o_orderdate AS triggered_at, CASE WHEN o_orderstatus = 'F' AND m > o_orderdate THEN m END AS resolved_at
        FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY l_orderkey) l
          ON o_orderkey = l_orderkey""",
    "alert_events": """
        SELECT l_orderkey AS alert_id, l_partkey * 100000000 + l_suppkey * 10 + l_linenumber AS seq,
          CASE WHEN l_returnflag = 'R' THEN 'resolve' ELSE 'acknowledge' END AS action,
          concat('user-', CAST(l_suppkey AS VARCHAR)) AS actor,
          CASE WHEN l_linestatus = 'F' THEN concat('note ', CAST(l_linenumber AS VARCHAR)) END AS notes,
          l_shipdate AS happened_at
        FROM lineitem""",
    "dataset_metrics": """
        SELECT concat(l_returnflag, '-', l_linestatus) AS dataset_name,
          CASE l_linenumber % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split_name,
          CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS computed_at, count(*) AS num_examples,
          CAST(sum(CAST(l_quantity AS INT)) AS DOUBLE) / count(*) AS avg_text_length,
          1 - CAST(sum(CAST(round(l_discount * 100) AS INT)) AS DOUBLE) / (100 * count(*)) AS quality_score,
          1 - CAST(sum(CAST(round(l_tax * 100) AS INT)) AS DOUBLE) / (100 * count(*)) AS completeness_score,
          round(1 - max(l_discount), 2) AS consistency_score, round(1 - max(l_tax), 2) AS validity_score,
          CASE WHEN count(*) % 4 = 0 THEN NULL
            ELSE CAST(sum(CAST(round(l_discount * 100) AS INT)) AS DOUBLE) / (100 * count(*)) END AS drift_score
        FROM lineitem GROUP BY 1, 2, 3""",
    "experiment_runs": """
        SELECT p_partkey AS id, concat('mlf-', CAST(p_partkey AS VARCHAR)) AS mlflow_run_id,
          p_brand AS experiment_name, p_name AS run_name,
          CASE p_size % 3 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
          CASE WHEN p_size % 7 = 0 THEN NULL ELSE round(p_size / CAST(51 AS DOUBLE), 6) END AS accuracy,
          CASE WHEN p_size % 5 = 0 THEN NULL ELSE round((p_size + p_partkey % 3) / CAST(53 AS DOUBLE), 6) END AS f1_score,
          p_retailprice AS training_duration, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey) AS created_at,
          p_size % 5 AS epochs, p_retailprice / 1000 AS learning_rate
        FROM part""",
    "run_changes": """
        SELECT l_partkey AS run_id, l_orderkey * 100000000 + l_suppkey * 10 + l_linenumber AS seq,
          CASE l_linenumber % 4 WHEN 0 THEN 'status' WHEN 1 THEN 'accuracy' WHEN 2 THEN 'f1_score'
            ELSE 'no_such_field' END AS field,
          CASE WHEN l_linenumber % 4 = 0 THEN l_returnflag WHEN l_tax = 0 THEN NULL
            ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS value, l_shipdate AS changed_at
        FROM lineitem""",
    "checkpoints": """
        SELECT l_partkey AS run_id, l_orderkey AS epoch, l_suppkey * 10 + l_linenumber AS step,
          round(0.8 + l_discount, 2) AS eval_f1, round(0.4 - l_tax, 2) AS eval_loss FROM lineitem""",
    "model_deployments": """
        SELECT concat('dep-', CAST(s_suppkey AS VARCHAR)) AS id, s_suppkey * 3 AS experiment_run_id,
          s_name AS deployment_name,
          CASE s_suppkey % 4 WHEN 0 THEN 'DEPLOYING' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'INACTIVE' ELSE 'FAILED' END
            AS status, s_acctbal AS avg_response_time FROM supplier""",
    "deployment_changes": """
        SELECT concat('dep-', CAST(user_id % 40 AS VARCHAR)) AS deployment_id, event_id AS seq,
          CASE event_type WHEN 'signup' THEN 'ACTIVE' WHEN 'error' THEN 'FAILED' END AS status,
          CASE WHEN event_type = 'error' THEN 'UNHEALTHY' WHEN event_type = 'signup' AND value > 50 THEN 'HEALTHY' END
            AS health_status,
          CASE WHEN event_type = 'purchase' THEN CAST(json_extract(props, '$.k') AS INT) END AS request_count,
          CASE WHEN event_type IN ('purchase', 'click') THEN value END AS avg_response_time,
          CASE WHEN event_type = 'view' THEN round(value / 1000, 5) END AS error_rate, ts AS changed_at
        FROM events""",
    "feedback": """
        SELECT conv_id * 10 + turn AS prediction_id, turn % 2 = 0 AS is_correct,
          CASE WHEN length(text) % 7 = 0 THEN NULL ELSE (length(text) % 120) / CAST(100 AS DOUBLE) END AS feedback_score,
          text AS comments FROM conversations""",
    "labelled_texts": """
        SELECT d.doc_id, d.text, d.lang, l.quality AS label, l.toxic,
          CASE WHEN d.n_chars > 1500 THEN 1 ELSE 0 END AS predicted_label,
          CASE WHEN d.doc_id % 10 < 7 THEN 'train' WHEN d.doc_id % 10 = 7 THEN 'validation' ELSE 'test' END AS split
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "text_batches": """
        SELECT concat('batch-', CAST(doc_id AS VARCHAR)) AS request_id, string_split(text, chr(10)) AS texts,
          CAST(n_chars AS DOUBLE) AS total_time_ms FROM documents""",
    "logits": """
        SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS z0, CAST(embedding[2] AS DOUBLE) AS z1, label % 2 AS label
        FROM embeddings""",
}
