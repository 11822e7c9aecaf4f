"""DuckDB SQL for the registered queries, written against the generic tables only.

The statements restate what each query must give; they share no code with the package.
"""

from __future__ import annotations

MINUTE = 60_000_000

EV = """
ev AS (
  SELECT event_id, user_id, event_type, ts, epoch_us(ts) AS ts_us,
         CAST(round(value * 100) AS BIGINT) AS cents, CAST(props->>'$.k' AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, strftime(ts, '%Y-%m-%d') AS day,
         'cluster-' || user_id AS cluster_id
  FROM events)"""

REC = """
rec AS (
  SELECT cluster_id, 'q-' || user_id AS id, event_id AS batch_id, ts_us, iso AS ts_raw, day, user_id,
         CASE WHEN event_type <> 'error' THEN CAST(cents AS DOUBLE) END AS dur, CAST(k AS DOUBLE) AS srck
  FROM ev)"""

DAILY_REC = REC.replace("event_id AS batch_id, ts_us,", "event_id AS batch_id, ts_us - ts_us % 86400000000 AS ts_us,")

RULES = """
rules(rule_ord, rule_name, metric, aggregation, operator, threshold, window_minutes, min_batches, target, cooldown_minutes) AS (
  VALUES (1, 'surge', 'source.k', 'last', 'gt', 80.0::DOUBLE, 4320, 3, 16, 1440),
         (2, 'slow', 'batchDuration', 'avg', 'gt', 6000.0::DOUBLE, 4320, 3, 8, 1440),
         (3, 'idle', 'batchDuration', 'max', 'lt', 10000.0::DOUBLE, 7200, 5, 2, 4320),
         (4, 'floor', 'batchDuration', 'min', 'gt', 2500.0::DOUBLE, 2880, 2, 4, 720))"""


def frame(minutes: int) -> str:
    return (
        "(PARTITION BY cluster_id ORDER BY ts_us "
        f"RANGE BETWEEN {minutes * MINUTE - 1} PRECEDING AND CURRENT ROW)"
    )


def last_in(column: str, window: str) -> str:
    return (
        f"(max(CASE WHEN {column} IS NOT NULL THEN struct_pack(u := ts_us, b := batch_id, i := id, v := {column}) END) "
        f"OVER {window}).v"
    )


EVAL = f"""
windows AS (
  SELECT *, count(*) OVER w2 AS n2, count(*) OVER w3 AS n3, count(*) OVER w5 AS n5,
         count(srck) OVER w3 AS c1, {last_in("srck", "w3")} AS v1,
         count(dur) OVER w3 AS c2, sum(dur) OVER w3 AS s2,
         count(dur) OVER w5 AS c3, max(dur) OVER w5 AS v3,
         count(dur) OVER w2 AS c4, min(dur) OVER w2 AS v4
  FROM rec
  WINDOW w2 AS {frame(2880)}, w3 AS {frame(4320)}, w5 AS {frame(7200)}),
evals AS (
  SELECT cluster_id, id, batch_id, ts_us, ts_raw, 1 AS rule_ord, 'surge' AS rule_name, n3 AS n, c1 AS c,
         CASE WHEN c1 >= 3 THEN v1 END AS agg FROM windows
  UNION ALL
  SELECT cluster_id, id, batch_id, ts_us, ts_raw, 2, 'slow', n3, c2, CASE WHEN c2 >= 3 THEN s2 / c2 END FROM windows
  UNION ALL
  SELECT cluster_id, id, batch_id, ts_us, ts_raw, 3, 'idle', n5, c3, CASE WHEN c3 >= 5 THEN v3 END FROM windows
  UNION ALL
  SELECT cluster_id, id, batch_id, ts_us, ts_raw, 4, 'floor', n2, c4, CASE WHEN c4 >= 2 THEN v4 END FROM windows),
held AS (
  SELECT e.*, coalesce(CASE r.operator WHEN 'gt' THEN agg > r.threshold ELSE agg < r.threshold END, false) AS holds
  FROM evals e JOIN rules r USING (rule_ord)),
matched AS (
  SELECT * FROM held WHERE holds
  QUALIFY row_number() OVER (PARTITION BY cluster_id, batch_id, id ORDER BY rule_ord) = 1)"""

WALK = """
points AS (
  SELECT m.*, r.target, CAST(r.cooldown_minutes AS BIGINT) * 60000000 AS cooldown_us,
         row_number() OVER (PARTITION BY m.cluster_id ORDER BY m.ts_us, m.batch_id, m.id) AS rn
  FROM matched m JOIN rules r USING (rule_ord)),
steps AS (
  SELECT p.cluster_id, p.rn, 4 AS cur, CAST(NULL AS BIGINT) AS last_us,
         CASE WHEN p.target = 4 THEN 'blocked_idempotence' ELSE 'decision' END AS outcome
  FROM points p WHERE p.rn = 1
  UNION ALL
  SELECT cluster_id, rn, cur, last_us,
         CASE WHEN target = cur THEN 'blocked_idempotence'
              WHEN last_us IS NOT NULL AND ts_us < last_us + cooldown_us THEN 'blocked_cooldown'
              ELSE 'decision' END
  FROM (
    SELECT p.cluster_id, p.rn, p.target, p.cooldown_us, p.ts_us,
           CASE WHEN s.outcome = 'decision' THEN q.target ELSE s.cur END AS cur,
           CASE WHEN s.outcome = 'decision' THEN q.ts_us ELSE s.last_us END AS last_us
    FROM steps s JOIN points q USING (cluster_id, rn)
    JOIN points p ON p.cluster_id = s.cluster_id AND p.rn = s.rn + 1)),
walked AS (SELECT * FROM points JOIN steps USING (cluster_id, rn)),
made AS (
  SELECT cluster_id, ts_raw AS decision_ts, rule_name, CAST(cur AS BIGINT) AS from_workers,
         CAST(target AS BIGINT) AS to_workers, ts_us, batch_id
  FROM walked WHERE outcome = 'decision'),
last_made AS (
  SELECT * FROM made
  QUALIFY row_number() OVER (PARTITION BY cluster_id, decision_ts ORDER BY ts_us DESC, batch_id DESC) = 1)"""

# --- log text ----------------------------------------------------------------------------

LOGS = r"""
kinds AS (
  SELECT *, strftime(ts, '%y/%m/%d %H:%M:%S') AS prefix,
         CASE WHEN event_id % 50 = 0 THEN 'cut' WHEN event_id % 53 = 0 THEN 'no_id' WHEN event_id % 59 = 0 THEN 'bad_ts'
              WHEN event_id % 61 = 0 THEN 'idle' ELSE 'good' END AS kind,
         'logs/cluster-' || user_id || '/' ||
         CASE user_id % 10 WHEN 3 THEN 'driver-' || day || '.log' WHEN 4 THEN 'log4j-' || day || '-25.log.gz'
              ELSE 'log4j-' || day || '-00.log.gz' END AS path
  FROM ev),
logs AS (
  SELECT *,
    CASE
      WHEN kind = 'cut' THEN prefix || ' INFO ProgressReporter: Streaming query made progress: {"id":"q-' || user_id || '","timestamp":"2024-'
      WHEN kind = 'idle' THEN prefix || ' INFO MicroBatchExecution: Streaming query has been idle and waiting for new data more than 10000 ms.'
      WHEN event_id % 2 = 0 THEN
        prefix || ' INFO ProgressReporter: Streaming query made progress: {' ||
        CASE WHEN kind = 'no_id' THEN '' ELSE '"id":"q-' || user_id || '",' END ||
        '"runId":"r-' || user_id || '","name":"ingest","timestamp":"' || CASE WHEN kind = 'bad_ts' THEN 'yesterday' ELSE iso END ||
        '","batchId":' || event_id || ',' || CASE WHEN event_type = 'error' THEN '' ELSE '"batchDuration":' || cents || ',' END ||
        '"durationMs":{"addBatch":7},"stateOperators":[],"sources":[{"description":"files","metrics":{"k":"' || k ||
        '"}}],"sink":{"numOutputRows":' || k || '}}'
      ELSE
        prefix || E' INFO MicroBatchExecution: Streaming query made progress: {\n' ||
        CASE WHEN kind = 'no_id' THEN '' ELSE '  "id" : "q-' || user_id || E'",\n' END ||
        '  "runId" : "r-' || user_id || E'",\n  "name" : "ingest",\n  "timestamp" : "' ||
        CASE WHEN kind = 'bad_ts' THEN 'yesterday' ELSE iso END || E'",\n  "batchId" : ' || event_id || E',\n' ||
        CASE WHEN event_type = 'error' THEN '' ELSE '  "batchDuration" : ' || cents || E',\n' END ||
        E'  "sources" : [ {\n    "metrics" : {\n      "k" : "' || k ||
        E'"\n    }\n  } ]\n}\n\tat org.example.Progress.report(Progress.scala:7)'
    END AS entry,
    prefix || ' WARN TaskSetManager: Lost task ' || event_id || E'.0\n\tat org.example.Task.run(Task.scala:9)' AS unrelated,
    E'\tat org.example.Earlier.end(Earlier.scala:3)' AS preamble
  FROM kinds)"""

# --- files -------------------------------------------------------------------------------

FILES = """
files AS (
  SELECT DISTINCT user_id, cluster_id, day, CAST(substr(day, 9, 2) AS INTEGER) AS dom,
         'logs/cluster-' || user_id || '/' ||
         CASE user_id % 10 WHEN 3 THEN 'driver-' || day || '.log' WHEN 4 THEN 'log4j-' || day || '-25.log.gz'
              ELSE 'log4j-' || day || '-00.log.gz' END AS key
  FROM ev),
manifest AS (
  SELECT user_id, cluster_id, CAST(4 AS BIGINT) AS initial_workers,
         count(*) + any_value(CASE WHEN user_id % 8 = 5 THEN 1 ELSE 0 END) AS num_log_files
  FROM files GROUP BY user_id, cluster_id),
file_notes AS (
  SELECT 'm-' || cluster_id || '-' || day AS message_id, * FROM files
  UNION ALL
  SELECT 'again-' || cluster_id || '-' || day, * FROM files WHERE (user_id + dom) % 11 = 0),
notes AS (
  SELECT message_id, 'driver-logs' AS bucket, key, cluster_id FROM file_notes
  UNION ALL
  SELECT 'b-' || event_id, 'driver-logs', 'k', 'ghost-' || user_id FROM ev WHERE event_id % 100 = 1),
listing AS (SELECT key, user_id * 100 + dom AS length FROM files WHERE (user_id + dom) % 13 <> 0)"""

COMPLETENESS = """
completeness AS (
  SELECT m.cluster_id, m.initial_workers, m.num_log_files, count(DISTINCT n.key) AS files_received,
         count(DISTINCT n.key) >= m.num_log_files AS is_complete
  FROM manifest m LEFT JOIN notes n ON n.cluster_id = m.cluster_id GROUP BY m.cluster_id, m.initial_workers, m.num_log_files)"""

MANIFEST_DOCS = """
users AS (SELECT DISTINCT user_id FROM events),
items AS (
  SELECT 'manifest-' || (user_id // 100) AS doc_id,
         CAST(row_number() OVER (PARTITION BY user_id // 100 ORDER BY user_id) - 1 AS INTEGER) AS position, user_id,
         user_id % 19 <> 7 AS is_mapping,
         CASE WHEN user_id % 19 = 7 THEN NULL WHEN user_id % 9 = 0 THEN '' WHEN user_id % 17 = 3 THEN 'cluster-twice'
              ELSE 'cluster-' || user_id END AS cluster_id,
         CASE WHEN user_id % 19 = 7 THEN NULL WHEN user_id % 11 = 5 THEN -1 WHEN user_id % 13 = 6 THEN NULL ELSE 4 END AS initial_workers,
         CASE WHEN user_id % 19 = 7 THEN NULL WHEN user_id % 15 = 8 THEN 0 ELSE user_id % 30 + 1 END AS num_log_files
  FROM users)"""

RAW_RULES = """
raw AS (
  SELECT 'rules-' || user_id AS ruleset, CAST(event_id AS INTEGER) AS rule_ord, event_id AS e, k,
         CASE WHEN event_id % 17 <> 0 THEN 'r' || (event_id % 200) END AS name
  FROM ev)"""

INCREMENTAL = """
placed AS (
  SELECT *, CAST(substr(day, 9, 2) AS INTEGER) AS dom FROM rec),
copies AS (
  SELECT cluster_id, id, batch_id, ts_us, CASE WHEN dom IN (10, 20) AND batch_id % 3 = 1 THEN 2 ELSE 1 END AS times FROM placed)"""


STATE = """
arrivals AS (
  SELECT cluster_id, batch_id, ts_us,
         CASE WHEN dom <= 10 THEN 0 WHEN dom <= 20 THEN 1 ELSE 2 END + CASE WHEN dom IN (10, 20) AND batch_id % 3 = 0 THEN 1 ELSE 0 END AS chunk
  FROM placed),
frontiers AS (SELECT cluster_id, chunk AS epoch, min(ts_us) AS frontier FROM arrivals GROUP BY cluster_id, chunk),
held AS (
  SELECT a.cluster_id, a.batch_id, a.ts_us, a.chunk, coalesce(min(f.epoch), 3) AS walked
  FROM arrivals a LEFT JOIN frontiers f ON f.cluster_id = a.cluster_id AND f.epoch >= a.chunk AND a.ts_us < f.frontier
  GROUP BY ALL),
prunes AS (
  SELECT f.* FROM frontiers f WHERE EXISTS (SELECT 1 FROM held h WHERE h.cluster_id = f.cluster_id AND h.walked = f.epoch)),
epochs AS (SELECT CAST(unnest(range(4)) AS INTEGER) AS epoch)"""


def sql(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + select


def decision_sql(select: str, *extra: str, rec: str = REC) -> str:
    return sql(EV, rec, RULES, EVAL, WALK, *extra, select=select)


def window_sql(value: str, name: str) -> str:
    picked = f"SELECT cluster_id, batch_id, CASE WHEN c2 >= 3 THEN {value} END AS {name} FROM w"
    body = f"""w AS (
  SELECT *, count(dur) OVER w3 AS c2, sum(dur) OVER w3 AS s, max(dur) OVER w3 AS mx, min(dur) OVER w3 AS mn,
         {last_in("dur", "w3")} AS lst
  FROM rec WINDOW w3 AS {frame(4320)})"""
    return sql(EV, REC, body, select=picked)


DECISION = "cluster_id, decision_ts, rule_name, from_workers, to_workers"
DECISIONS = decision_sql(f"SELECT {DECISION} FROM made")
STORED = decision_sql(f"SELECT {DECISION} FROM last_made")
CUT, IDLE, NO_ID, BAD_TS, GOOD = ("kind = 'cut'", "kind = 'idle'", "kind = 'no_id'", "kind = 'bad_ts'", "kind = 'good'")
MS = "ts_us - ts_us % 1000"
REASON = (
    "CASE kind WHEN 'cut' THEN 'payload is not a JSON object' WHEN 'no_id' THEN 'id is not a non-empty string' "
    "ELSE 'timestamp is not ISO-8601' END"
)
STATUS = "CASE kind WHEN 'cut' THEN 'malformed_json' ELSE 'missing_required' END"

STEADY = f"""
rules(rule_ord, rule_name, target, cooldown_minutes) AS (VALUES (1, 'steady', 16, 4320)),
windows AS (SELECT *, count(dur) OVER w3 AS c2, max(dur) OVER w3 AS agg FROM rec WINDOW w3 AS {frame(4320)}),
matched AS (SELECT cluster_id, id, batch_id, ts_us, ts_raw, 1 AS rule_ord, 'steady' AS rule_name, agg FROM windows WHERE c2 >= 1 AND agg > -1)"""

FIRST_TS = sql(EV, LOGS, select=f"SELECT path, min(arg) AS first_ts_us FROM (SELECT path, first_value({MS}) OVER (PARTITION BY path ORDER BY event_id) AS arg FROM logs WHERE {GOOD}) GROUP BY path")
FROM_FILES = sql(
    EV, LOGS,
    """rec AS (
  SELECT cluster_id, 'q-' || user_id AS id, event_id AS batch_id, ts_us - ts_us % 1000 AS ts_us, iso AS ts_raw, day, user_id,
         CASE WHEN event_type <> 'error' THEN CAST(cents AS DOUBLE) END AS dur, CAST(k AS DOUBLE) AS srck
  FROM logs WHERE kind = 'good' AND user_id % 8 <> 5)""",
    RULES, EVAL, WALK, select=f"SELECT {DECISION} FROM last_made",
)

ORACLE: dict[str, str] = {
    "decisions_from_logs": FROM_FILES,
    "decisions_from_lines": FROM_FILES,
    "decisions_from_ranges": FROM_FILES,
    "document_shapes": "SELECT CAST(event_id AS VARCHAR) AS doc_id FROM events WHERE event_id % 7 IN (0, 1, 2, 3, 4)",
    "decisions_steady": sql(
        EV, REC, STEADY, WALK, "made_at AS (SELECT cluster_id, ts_us, ts_raw FROM walked WHERE outcome = 'decision')",
        select="""SELECT w.cluster_id, w.batch_id, w.rule_ord, w.agg AS aggregate, CAST(w.cur AS BIGINT) AS current_workers, w.last_us AS last_decision_us,
          l.ts_raw AS last_decision_ts, w.last_us + w.cooldown_us AS cooldown_until_us, w.outcome
        FROM walked w LEFT JOIN made_at l ON l.cluster_id = w.cluster_id AND l.ts_us = w.last_us""",
    ),
    "window_avg_of_fractions": sql(
        EV, REC,
        f"""w AS (SELECT cluster_id, ts_us, count(*) OVER w3 AS c, sum(batch_id) OVER w3 AS s FROM rec WINDOW w3 AS {frame(4320)})""",
        select="SELECT DISTINCT cluster_id, ts_us, round(CAST(s AS DOUBLE) / 3 / c, 6) AS avg_value FROM w WHERE c >= 3",
    ),
    "window_avg_of_extremes": sql(
        EV, REC,
        f"""w AS (
          SELECT cluster_id, ts_us, CAST(substr(id, 3) AS BIGINT) % 5 AS kind, count(*) OVER w3 AS c, sum(batch_id) OVER w3 AS s,
                 sum(CASE WHEN batch_id % 2 = 1 THEN batch_id END) OVER w3 AS odd FROM rec WINDOW w3 AS {frame(4320)}),
        v AS (
          SELECT DISTINCT cluster_id, ts_us, CASE WHEN c >= 3 THEN
            CASE WHEN kind = 4 AND odd IS NULL THEN CAST(s AS DOUBLE) / c * pow(2.0::DOUBLE, -900)
                 WHEN kind = 4 THEN CAST(odd AS DOUBLE) / c * pow(2.0::DOUBLE, 900)
                 ELSE CAST(s AS DOUBLE) / c * pow(2.0::DOUBLE, CASE kind WHEN 0 THEN -1000 WHEN 1 THEN -60 WHEN 2 THEN 0 ELSE 1000 END) END END AS avg_value FROM w)""",
        select="SELECT cluster_id, ts_us, coalesce(avg_value > 0, false) AS holds, avg_value FROM v",
    ),
    "source_metric_shapes": sql(
        EV,
        select="""SELECT event_id, CASE WHEN event_id % 11 IN (0, 7, 9) THEN CAST(k AS DOUBLE) END AS k,
          CASE WHEN event_id % 11 IN (0, 7, 9) THEN CAST(k AS DOUBLE) END AS k_chosen FROM ev""",
    ),
    # sources
    "scan_logs": sql(
        EV, LOGS,
        select=f"""SELECT 'logs/' || cluster_id || '/' || event_id || '.log.gz' AS path, CAST(CASE WHEN event_id % 4 = 3 THEN 2 ELSE 3 END AS BIGINT) AS entries,
          CAST(CASE WHEN {IDLE} THEN 0 ELSE 1 END AS BIGINT) AS progress_entries FROM logs""",
    ),
    "scan_progress_entries": sql(
        EV, LOGS,
        select=f"""SELECT 'logs/' || cluster_id || '/' || event_id || '.log.gz' AS path, CAST(1 AS BIGINT) AS entry_no, entry AS text
        FROM logs WHERE NOT ({IDLE})""",
    ),
    "notified_files": sql(EV, FILES, select="SELECT n.message_id, n.cluster_id, n.key, l.length FROM notes n JOIN listing l USING (key)"),
    "missing_files": sql(EV, FILES, select="SELECT message_id, key FROM notes WHERE key NOT IN (SELECT key FROM listing)"),
    "valid_notifications": sql(EV, FILES, select="SELECT message_id, bucket, key, cluster_id FROM notes"),
    "rejected_notifications": sql(
        EV,
        select="""SELECT 'b-' || event_id AS message_id,
          CASE event_id % 100 WHEN 2 THEN '{"bucket":"driver-logs","key":"","cluster_id":"cluster-' || user_id || '"}' WHEN 3 THEN '[]' ELSE 'not json' END AS body,
          CASE event_id % 100 WHEN 2 THEN 'missing non-empty text field(s): key' WHEN 3 THEN 'body must be a JSON object' ELSE 'body is not JSON' END AS reason
        FROM ev WHERE event_id % 100 IN (2, 3, 4)""",
    ),
    "notification_audit": sql(
        EV, FILES,
        select="""SELECT message_id, '{"bucket":"driver-logs","key":"' || key || '","cluster_id":"' || cluster_id || '","extra":1}' AS raw_body, true AS is_json
        FROM file_notes
        UNION ALL
        SELECT 'b-' || event_id,
          CASE event_id % 100 WHEN 1 THEN '{"bucket":"driver-logs","key":"k","cluster_id":"ghost-' || user_id || '"}'
               WHEN 2 THEN '{"bucket":"driver-logs","key":"","cluster_id":"cluster-' || user_id || '"}' WHEN 3 THEN '[]' ELSE 'not json' END,
          event_id % 100 <> 4
        FROM ev WHERE event_id % 100 BETWEEN 1 AND 4""",
    ),
    "manifest_rows": sql(
        MANIFEST_DOCS,
        select="SELECT doc_id, position, cluster_id, CAST(initial_workers AS BIGINT) AS initial_workers, CAST(num_log_files AS BIGINT) AS num_log_files FROM items",
    ),
    "rules_rows": sql(
        EV,
        select="""SELECT 'rules-' || event_id AS ruleset, 0 AS rule_ord, 'up-' || user_id AS name, '5e9' AS threshold, 'str' AS threshold_type,
          CAST(k + 1 AS VARCHAR) AS window_minutes, '3.0' AS min_batches, 'str' AS target_workers_type FROM ev
        UNION ALL
        SELECT 'rules-' || event_id, 1, 'down-' || user_id, CAST(cents AS VARCHAR), 'int', '30', '5', 'int' FROM ev""",
    ),
    "file_first_ts": FIRST_TS,
    "file_first_ts_early": FIRST_TS,
    # the decision table
    "decision_lookup": decision_sql(
        f"SELECT {DECISION} FROM last_made QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY decision_ts) = 1"
    ),
    "decision_point_lookup": decision_sql(f"SELECT {DECISION} FROM last_made ORDER BY cluster_id, decision_ts LIMIT 1"),
    "decisions_for_cluster": decision_sql(
        "SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY decision_ts) AS position, decision_ts, rule_name FROM last_made"
    ),
    "upsert_decisions": decision_sql(
        "SELECT cluster_id, decision_ts, CASE WHEN to_workers > from_workers THEN rule_name ELSE 'stale' END AS rule_name, "
        "from_workers, to_workers FROM last_made"
    ),
    "upsert_two_runs": decision_sql(
        "SELECT cluster_id, decision_ts, CASE WHEN to_workers <> 16 THEN rule_name ELSE 'first' END AS rule_name, from_workers, to_workers FROM last_made"
    ),
    "compacted_decisions": decision_sql(
        "SELECT cluster_id, decision_ts, CASE to_workers WHEN 16 THEN 'first' WHEN 2 THEN 'third' ELSE rule_name END AS rule_name, "
        "from_workers, to_workers FROM last_made"
    ),
    "dedupe_decisions_last": decision_sql(
        "SELECT cluster_id, substr(decision_ts, 1, 10) AS decision_ts, rule_name, from_workers, to_workers FROM made "
        "QUALIFY row_number() OVER (PARTITION BY cluster_id, substr(decision_ts, 1, 10) ORDER BY ts_us DESC, batch_id DESC) = 1"
    ),
    "decision_violations": sql(
        EV,
        """d AS (SELECT CASE WHEN event_id % 11 <> 0 THEN cluster_id ELSE '' END AS cluster_id, iso AS decision_ts,
          CASE WHEN event_id % 13 <> 0 THEN event_type END AS rule_name, CAST(k % 7 - 1 AS BIGINT) AS from_workers, CAST(k % 5 AS BIGINT) AS to_workers FROM ev)""",
        select="""SELECT *, 'cluster_id is empty' AS violation FROM d WHERE cluster_id = ''
        UNION ALL SELECT *, 'rule_name is empty' FROM d WHERE rule_name IS NULL
        UNION ALL SELECT *, 'from_workers is negative' FROM d WHERE from_workers < 0
        UNION ALL SELECT *, 'workers do not change' FROM d WHERE from_workers = to_workers""",
    ),
    "decisions_export_roundtrip": DECISIONS,
    "decisions_export": decision_sql(
        """SELECT '{"cluster_id":{"S":"' || cluster_id || '"},"decision_ts":{"S":"' || decision_ts || '"},"rule_name":{"S":"' || rule_name ||
        '"},"from_workers":{"N":"' || from_workers || '"},"to_workers":{"N":"' || to_workers || '"}}' AS item FROM made"""
    ),
    "decision_trace": decision_sql(
        """SELECT w.cluster_id, w.ts_raw AS evaluation_ts, w.batch_id, w.rule_name AS rule,
          ['', 'surge', 'surge,slow', 'surge,slow,idle'][w.rule_ord] AS rules_not_holding_above,
          r.metric, r.aggregation, w.agg AS aggregate, r.operator, r.threshold,
          CAST(r.window_minutes AS BIGINT) AS window_minutes, w.n AS records_in_window, w.c AS records_with_metric,
          CAST(r.min_batches AS BIGINT) AS min_batches, CAST(w.cur AS BIGINT) AS current_workers, CAST(r.target AS BIGINT) AS target_workers,
          r.target = w.cur AS idempotent,
          w.agg || ' ' || r.operator || ' ' || r.threshold AS comparison,
          (SELECT ts_raw FROM made_at l WHERE l.cluster_id = w.cluster_id AND l.ts_us = w.last_us) AS last_decision_ts,
          CAST(r.cooldown_minutes AS BIGINT) AS cooldown_minutes,
          strftime(make_timestamp(w.last_us + w.cooldown_us), '%Y-%m-%dT%H:%M:%S.%fZ') AS cooldown_until,
          w.ts_us >= w.last_us + w.cooldown_us AS cooldown_passed, w.outcome
        FROM walked w JOIN rules r USING (rule_ord)""",
        "made_at AS (SELECT cluster_id, ts_us, ts_raw FROM walked WHERE outcome = 'decision')",
        rec=REC.replace("iso AS ts_raw", "CASE event_id % 3 WHEN 0 THEN substr(iso, 1, 23) || '+00:00' WHEN 1 THEN substr(iso, 1, 23) || '000Z' ELSE iso END AS ts_raw"),
    ),
    # entries and records
    "header_lines": sql(
        EV, LOGS,
        select=r"""SELECT event_id, split_part(entry, E'\n', 1) AS value FROM logs
        UNION ALL SELECT event_id, split_part(unrelated, E'\n', 1) FROM logs""",
    ),
    "entries_from_text": sql(
        EV, LOGS,
        select="""SELECT event_id, 0 AS entry_no, preamble AS text FROM logs
        UNION ALL SELECT event_id, 1, entry FROM logs UNION ALL SELECT event_id, 2, unrelated FROM logs""",
    ),
    "entries_from_lines": sql(EV, LOGS, select="SELECT entry AS text FROM logs UNION ALL SELECT unrelated FROM logs"),
    "preamble_entries": sql(EV, LOGS, select="SELECT event_id, 0 AS entry_no, preamble AS text FROM logs"),
    "progress_entries": sql(EV, LOGS, select=f"SELECT event_id, cluster_id, path FROM logs WHERE NOT ({IDLE})"),
    "progress_records": sql(
        EV, LOGS,
        select=f"""SELECT cluster_id, path, 'q-' || user_id AS id, event_id AS batch_id, {MS} AS ts_us, iso AS ts_raw,
          CASE WHEN event_type <> 'error' THEN CAST(cents AS DOUBLE) END AS batch_duration, CAST(k AS DOUBLE) AS source_k
        FROM logs WHERE {GOOD}""",
    ),
    "rejected_records": sql(
        EV, LOGS, select=f"SELECT event_id, path, {STATUS} AS status, {REASON} AS reason FROM logs WHERE {CUT} OR {NO_ID} OR {BAD_TS}"
    ),
    "batch_id_coercion": sql(
        EV,
        select="""SELECT event_id, CASE WHEN event_id % 9 IN (0, 1, 2) THEN event_id WHEN event_id % 9 = 7 THEN -event_id END AS batch_id,
          CASE WHEN event_id % 9 IN (0, 1, 2, 7) THEN 'record' ELSE 'missing_required' END AS status FROM ev""",
    ),
    "timestamp_parse": sql(
        EV,
        select=f"""SELECT event_id,
          CASE event_id % 9 WHEN 0 THEN {MS} WHEN 1 THEN {MS} - 7200000000 WHEN 2 THEN {MS} WHEN 3 THEN ts_us - ts_us % 1000000 WHEN 7 THEN {MS} END AS ts_us,
          CASE event_id % 9 WHEN 0 THEN iso WHEN 1 THEN substr(iso, 1, 23) || '+02:00' WHEN 2 THEN substr(iso, 1, 23)
            WHEN 3 THEN replace(substr(iso, 1, 19), 'T', ' ') WHEN 4 THEN '' WHEN 5 THEN 'yesterday' WHEN 6 THEN CAST(event_id AS VARCHAR)
            WHEN 7 THEN ' ' || substr(iso, 1, 23) || 'z ' END AS ts_raw,
          CASE WHEN event_id % 9 IN (0, 1, 2, 3, 7) THEN 'record' ELSE 'missing_required' END AS status
        FROM ev""",
    ),
    "metric_coercion": sql(
        EV,
        select="""SELECT event_id, CASE WHEN event_id % 9 < 3 THEN CAST(cents AS DOUBLE) WHEN event_id % 9 = 8 THEN CAST(cents * 100 AS DOUBLE) END AS m FROM ev""",
    ),
    "metrics_long": sql(
        EV, LOGS,
        select=f"""SELECT cluster_id, event_id AS batch_id, 'batchDuration' AS metric, CAST(cents AS DOUBLE) AS value FROM logs WHERE {GOOD} AND event_type <> 'error'
        UNION ALL SELECT cluster_id, event_id, 'source.k', CAST(k AS DOUBLE) FROM logs WHERE {GOOD}""",
    ),
    "parse_stats": sql(
        EV, LOGS,
        select=f"""SELECT path, count(*) AS entries, CAST(count_if(NOT ({IDLE})) AS BIGINT) AS progress_entries, CAST(count_if({GOOD}) AS BIGINT) AS records,
          CAST(count_if({CUT}) AS BIGINT) AS malformed_json, CAST(count_if({NO_ID} OR {BAD_TS}) AS BIGINT) AS missing_required FROM logs GROUP BY path""",
    ),
    "skip_samples": sql(
        EV, LOGS,
        select=f"""SELECT * FROM (SELECT cluster_id AS path, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY event_id) AS INTEGER) AS place,
          event_id AS entry_no, {REASON} AS reason FROM logs WHERE {CUT} OR {NO_ID} OR {BAD_TS}) WHERE place <= 2""",
    ),
    # file sets
    "file_hours": sql(
        EV, FILES,
        select="SELECT cluster_id, key, CASE WHEN user_id % 10 NOT IN (3, 4) THEN epoch_us(CAST(day AS TIMESTAMP)) END AS hour_us FROM files",
    ),
    "file_order": sql(
        EV, LOGS, FILES,
        f"""firsts AS (SELECT path AS key, arg_min({MS}, event_id) AS first_us FROM logs WHERE {GOOD} GROUP BY path)""",
        select="""SELECT f.cluster_id, f.key, row_number() OVER (PARTITION BY f.cluster_id ORDER BY
          CASE WHEN f.user_id % 10 NOT IN (3, 4) THEN epoch_us(CAST(f.day AS TIMESTAMP)) ELSE coalesce(first_us, 9000000000000000000) END, f.key) AS file_ord
        FROM files f LEFT JOIN firsts USING (key)""",
    ),
    "cluster_completeness": sql(EV, FILES, COMPLETENESS, select="SELECT * FROM completeness"),
    "unknown_clusters": sql(EV, FILES, select="SELECT message_id, cluster_id FROM notes WHERE cluster_id LIKE 'ghost-%'"),
    "cluster_status": decision_sql(
        """SELECT c.cluster_id, c.initial_workers, c.num_log_files, c.files_received,
          CASE WHEN is_complete THEN (SELECT count(*) FROM rec r WHERE r.cluster_id = c.cluster_id) ELSE 0 END AS unique_records,
          is_complete AS evaluated,
          CASE WHEN is_complete THEN (SELECT count(*) FROM made d WHERE d.cluster_id = c.cluster_id) ELSE 0 END AS decisions
        FROM completeness c""",
        FILES, COMPLETENESS,
    ),
    "run_status": sql(
        EV, FILES, COMPLETENESS,
        select="SELECT count(*) AS clusters_total, CAST(count_if(is_complete) AS BIGINT) AS clusters_processed, bool_and(is_complete) AS all_clusters_processed FROM completeness",
    ),
    # record set
    "dedup_records": sql(EV, REC, select="SELECT cluster_id, id, batch_id, ts_us, ts_raw, 0 AS file_ord, dur AS batch_duration FROM rec"),
    "record_order": sql(
        EV, REC, select="SELECT cluster_id, batch_id, row_number() OVER (PARTITION BY cluster_id ORDER BY ts_us, batch_id, id) AS walk_ord FROM rec"
    ),
    "dedup_stats": sql(
        EV, REC,
        select="""SELECT cluster_id, CAST(count(*) + count_if(batch_id % 7 = 0) AS BIGINT) AS records_seen, count(*) AS unique_records,
          CAST(count_if(batch_id % 7 = 0) AS BIGINT) AS duplicates FROM rec GROUP BY cluster_id""",
    ),
    # windows
    "window_counts": sql(
        EV, REC,
        select=f"SELECT cluster_id, batch_id, count(*) OVER w AS records_in_window, count(dur) OVER w AS records_with_metric FROM rec WINDOW w AS {frame(4320)}",
    ),
    "window_avg": window_sql("s / c2", "avg_value"),
    "window_max": window_sql("mx", "max_value"),
    "window_min": window_sql("mn", "min_value"),
    "window_last": window_sql("lst", "last_value"),
    "rule_evaluations": sql(
        EV, REC, RULES, EVAL,
        select="SELECT cluster_id, ts_us, rule_ord, rule_name, holds, n AS records_in_window, c AS records_with_metric, agg AS aggregate FROM held",
    ),
    # matching and gates
    "matched_rule": sql(
        EV, REC, RULES, EVAL,
        select="""SELECT cluster_id, batch_id, rule_ord, ['', 'surge', 'surge,slow', 'surge,slow,idle'][rule_ord] AS rules_not_holding_above,
          agg AS aggregate FROM matched""",
    ),
    "gate_outcomes": decision_sql(
        """SELECT cluster_id, batch_id, rule_ord, CAST(cur AS BIGINT) AS current_workers, last_us AS last_decision_us,
          last_us + cooldown_us AS cooldown_until_us, outcome FROM walked"""
    ),
    "gate_outcomes_of_peers": decision_sql(
        """SELECT cluster_id, batch_id, rule_ord, n AS records_in_window, agg AS aggregate, CAST(cur AS BIGINT) AS current_workers,
          last_us AS last_decision_us, outcome FROM walked""",
        rec=DAILY_REC,
    ),
    "decisions": DECISIONS,
    "decisions_sliced": DECISIONS,
    "decisions_alternating": sql(
        EV, REC,
        "rules(rule_ord, rule_name, target, cooldown_minutes) AS (VALUES (1, 'up', 8, 1440), (2, 'down', 2, 2880))",
        "times AS (SELECT DISTINCT cluster_id, ts_us FROM rec)",
        """matched AS (SELECT cluster_id, '' AS id, 0 AS batch_id, ts_us, '' AS ts_raw,
          CAST(2 - row_number() OVER (PARTITION BY cluster_id ORDER BY ts_us) % 2 AS INTEGER) AS rule_ord, '' AS rule_name FROM times)""",
        WALK,
        select="""SELECT cluster_id, ts_us, rule_ord, CAST(cur AS BIGINT) AS current_workers, last_us AS last_decision_us,
          last_us + cooldown_us AS cooldown_until_us, outcome FROM walked""",
    ),
    # validation
    "rule_problems": sql(
        EV, RAW_RULES,
        "firsts AS (SELECT ruleset, name, min(rule_ord) AS first_ord FROM raw WHERE name IS NOT NULL GROUP BY ALL)",
        select="""SELECT raw.ruleset, raw.rule_ord, raw.name, p.field, p.problem
        FROM raw LEFT JOIN firsts USING (ruleset, name), (VALUES
          ('name', 'must be text', 1), ('name', 'duplicate rule name', 2), ('metric', 'must not be empty', 3),
          ('aggregation', 'must be one of avg, max, min, last', 4), ('operator', 'must be one of gt, lt', 5),
          ('threshold', 'must be a number', 6), ('window_minutes', 'must be at least 1', 7),
          ('min_batches', 'must be a whole number', 8), ('min_batches', 'must be at least 1', 9),
          ('target_workers', 'must be at least 0', 10), ('cooldown_minutes', 'must be a whole number', 11)) p(field, problem, n)
        WHERE CASE n WHEN 1 THEN raw.name IS NULL WHEN 2 THEN coalesce(rule_ord > first_ord, false) WHEN 3 THEN e % 31 = 0 WHEN 4 THEN e % 5 = 0
          WHEN 5 THEN e % 7 = 0 WHEN 6 THEN e % 4 IN (1, 3) WHEN 7 THEN e % 6 = 0 WHEN 8 THEN e % 9 = 0
          WHEN 9 THEN e % 9 <> 0 AND e % 8 = 0 WHEN 10 THEN e % 10 = 0 ELSE e % 23 = 0 END""",
    ),
    "rule_number_coercion": sql(
        EV, RAW_RULES,
        select="""SELECT ruleset, rule_ord, CASE e % 4 WHEN 0 THEN 5e9::DOUBLE WHEN 2 THEN 2.5::DOUBLE END AS threshold_value,
          CAST(CASE WHEN e % 6 = 0 THEN 0 ELSE 15 END AS BIGINT) AS window_minutes_value,
          CAST(CASE WHEN e % 9 = 0 THEN NULL WHEN e % 8 = 0 THEN 0 ELSE 3 END AS BIGINT) AS min_batches_value,
          CAST(CASE WHEN e % 10 = 0 THEN -1 ELSE k END AS BIGINT) AS target_workers_value,
          CAST(CASE WHEN e % 23 = 0 THEN NULL ELSE 20 END AS BIGINT) AS cooldown_minutes_value FROM raw""",
    ),
    "manifest_problems": sql(
        MANIFEST_DOCS,
        "firsts AS (SELECT doc_id, cluster_id, min(position) AS first_position FROM items WHERE cluster_id <> '' GROUP BY ALL)",
        select="""SELECT i.doc_id, i.position, p.problem FROM items i LEFT JOIN firsts USING (doc_id, cluster_id), (VALUES
          ('not a mapping', 1), ('cluster_id must be non-empty text', 2), ('duplicate cluster_id', 3),
          ('initial_workers must be at least 0', 4), ('num_log_files must be at least 1', 5)) p(problem, n)
        WHERE CASE n WHEN 1 THEN NOT is_mapping WHEN 2 THEN is_mapping AND cluster_id = '' WHEN 3 THEN coalesce(position > first_position, false)
          WHEN 4 THEN is_mapping AND coalesce(initial_workers, -1) < 0 ELSE is_mapping AND num_log_files < 1 END""",
    ),
    # streams
    "stream_decisions": STORED,
    "stream_upsert_replay": STORED,
    "stream_dedup": sql(EV, REC, select="SELECT cluster_id, id, batch_id, ts_us FROM rec"),
    "walk_stats": sql(
        EV, REC, INCREMENTAL, STATE,
        """held_at AS (
          SELECT h.cluster_id, e.epoch, count(*) AS n FROM epochs e JOIN held h ON h.chunk <= e.epoch
          WHERE h.walked >= e.epoch OR NOT EXISTS (
            SELECT 1 FROM prunes p WHERE p.cluster_id = h.cluster_id AND p.epoch >= h.walked AND p.epoch < e.epoch AND h.ts_us <= p.frontier - 432000000000)
          GROUP BY h.cluster_id, e.epoch),
        peaks AS (SELECT cluster_id, max(n) AS peak_held_records FROM held_at GROUP BY cluster_id)""",
        select="""SELECT cluster_id, CAST(sum(times) AS BIGINT) AS records_seen, count(*) AS unique_records, count(*) AS evaluation_points,
          CAST(0 AS BIGINT) AS late_records, any_value(peak_held_records) AS peak_held_records FROM copies JOIN peaks USING (cluster_id) GROUP BY cluster_id""",
    ),
    "stream_state_size": sql(
        EV, REC, INCREMENTAL, STATE,
        select="""SELECT epoch, 'pending' AS state, (SELECT count(*) FROM held h WHERE h.chunk <= e.epoch AND h.walked > e.epoch) AS records FROM epochs e
        UNION ALL
        SELECT epoch, 'lookback', (SELECT count(*) FROM held h WHERE h.walked <= e.epoch AND NOT EXISTS (
          SELECT 1 FROM prunes p WHERE p.cluster_id = h.cluster_id AND p.epoch BETWEEN h.walked AND e.epoch AND h.ts_us <= p.frontier - 432000000000)) FROM epochs e
        UNION ALL
        SELECT epoch, 'seen', (SELECT count(*) FROM held h WHERE h.chunk <= e.epoch AND NOT EXISTS (
          SELECT 1 FROM prunes p WHERE p.cluster_id = h.cluster_id AND p.epoch BETWEEN h.chunk AND e.epoch AND h.ts_us <= p.frontier - 439200000000)) FROM epochs e""",
    ),
    "stream_complete_then_walk": decision_sql(
        f"SELECT {DECISION} FROM last_made WHERE CAST(substr(cluster_id, 9) AS BIGINT) % 8 <> 5"
    ),
}
