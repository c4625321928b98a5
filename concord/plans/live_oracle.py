"""DuckDB SQL of the live rounds: the chain of states by recursion, a request at a step."""

from __future__ import annotations

from concord.operators.rounds import DETAILS
from concord.plans.oracle import UPDATES

_DETAILS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DETAILS.items())

LIVE = f"""
re AS (
  SELECT CAST(user_id % 16 AS INTEGER) AS federation_id, event_id, ts, user_id AS client_id,
    CASE WHEN event_type IN ('view', 'click') THEN 'fetch' ELSE 'upload' END AS op,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS sample_size
  FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')
),
rq AS (
  SELECT *, epoch_us(ts) AS us,
         CAST((event_id * 31 + client_id) % (event_id // 500 + 1) AS INTEGER) AS claimed_version,
         event_id % 29 <> 0 AS present, event_id % 4 * 2400000000 AS merge_us,
         event_id % 3 * 1800000000 AS evaluate_us, event_id % 500 AS model_id,
         row_number() OVER (PARTITION BY federation_id ORDER BY ts, event_id) AS i
  FROM re
),
st AS (
  SELECT DISTINCT federation_id, CAST(0 AS BIGINT) AS i, 0 AS v, CAST(0 AS BIGINT) AS balance,
         CAST(NULL AS BIGINT) AS merged, CAST(NULL AS BIGINT) AS ready,
         CAST(NULL AS BIGINT) AS event_id, 0 AS server_version, false AS merging,
         false AS evaluating, '' AS status, 0 AS delta, false AS closes FROM rq
  UNION ALL
  SELECT federation_id, i, CASE WHEN shut AND takes = 0 THEN now + 1 ELSE now END, total,
         CASE WHEN shut AND takes > 0 THEN us + merge_us WHEN busy THEN merged END,
         CASE WHEN shut AND takes > 0 THEN us + takes WHEN busy THEN ready END,
         event_id, now, busy AND us < merged, busy AND us >= merged, said, move, shut
  FROM (
    SELECT *, balance + move AS total, op = 'upload' AND move = -1 AND balance + move = 0 AS shut
    FROM (
      SELECT *, CASE WHEN said <> 'accepted' THEN 0 WHEN op = 'fetch' THEN 1 ELSE -1 END AS move
      FROM (
        SELECT *, merge_us + evaluate_us AS takes,
               CASE WHEN claimed_version <> now THEN 'wrong_version'
                    WHEN op = 'fetch' AND NOT present THEN 'missing'
                    WHEN busy THEN 'busy' ELSE 'accepted' END AS said
        FROM (
          SELECT st.federation_id, rq.i, st.balance, st.merged, st.ready, rq.event_id, rq.us, rq.op,
                 rq.claimed_version, rq.present, rq.merge_us, rq.evaluate_us,
                 st.v + CASE WHEN st.ready <= rq.us THEN 1 ELSE 0 END AS now,
                 coalesce(rq.us < st.ready, false) AS busy
          FROM st JOIN rq ON rq.federation_id = st.federation_id AND rq.i = st.i + 1))))
),
b AS (
  SELECT st.federation_id, st.event_id, rq.op, rq.client_id, rq.sample_size, rq.ts, rq.claimed_version,
         rq.model_id, st.server_version, st.server_version AS version, st.merging, st.evaluating,
         st.status, st.delta, st.balance, st.closes
  FROM st JOIN rq ON rq.event_id = st.event_id
)"""

OBJECTS = LIVE + """,
up AS (
  SELECT b.federation_id, b.version, b.event_id, greatest(coalesce(b.sample_size, 1), 1) AS sample_size,
         e.embedding FROM b JOIN embeddings e ON e.vec_id = b.model_id
  WHERE b.op = 'upload' AND b.status = 'accepted'
),
obj AS (
  SELECT federation_id, version, embedding, arg_max(sample_size, event_id) AS sample_size,
         count(*) AS n_uploads FROM up GROUP BY ALL
),
cl AS (SELECT federation_id, version, event_id AS close_event FROM b WHERE closes),
par AS (
  SELECT o.federation_id, o.version, generate_subscripts(embedding, 1) - 1 AS pos,
         unnest(embedding)::DOUBLE AS value, sample_size
  FROM obj o JOIN cl ON cl.federation_id = o.federation_id AND cl.version = o.version
),
pub AS (
  SELECT federation_id, CAST(version + 1 AS INTEGER) AS version, pos,
         sum(value * sample_size) / sum(sample_size) AS value FROM par GROUP BY ALL
)"""

SCORES = OBJECTS + """,
test AS (
  SELECT CAST(vec_id % 16 AS INTEGER) AS federation_id, vec_id, CAST(label >= 5 AS INTEGER) AS y,
         generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS x
  FROM embeddings
),
sc AS (
  SELECT p.federation_id, p.version, t.vec_id, any_value(y) AS y, CAST(sum(p.value * t.x) > 0 AS INTEGER) AS pr
  FROM pub p JOIN test t ON t.federation_id = p.federation_id AND t.pos = p.pos GROUP BY ALL
),
cls AS (SELECT DISTINCT federation_id, version, c FROM (
  SELECT federation_id, version, y AS c FROM sc UNION ALL SELECT federation_id, version, pr FROM sc)),
per AS (
  SELECT cls.federation_id, cls.version, c, sum(CAST(y = c AND pr = c AS INTEGER)) AS tp,
         sum(CAST(y = c AS INTEGER)) AS support, sum(CAST(pr = c AS INTEGER)) AS predicted
  FROM cls JOIN sc ON sc.federation_id = cls.federation_id AND sc.version = cls.version GROUP BY ALL
),
fs AS (
  SELECT federation_id, version, sum(tp) / sum(support) AS accuracy,
         avg(CASE WHEN tp > 0 THEN 2.0 * tp / (support + predicted) ELSE 0 END) AS macro_f1
  FROM per GROUP BY ALL
)"""

LIVE_SQL = {
    "live_admission": "WITH RECURSIVE " + LIVE + f"""
SELECT federation_id, event_id, op, claimed_version, server_version, status,
       CASE op || '_' || status {_DETAILS} END AS details, delta FROM b""",
    "live_counter": "WITH RECURSIVE " + LIVE + """
SELECT federation_id, event_id, version, balance, closes FROM b""",
    "live_hold_off": "WITH RECURSIVE " + LIVE + """
SELECT federation_id, version, CAST(sum(CAST(op = 'fetch' AS INTEGER)) AS BIGINT) AS n_fetches,
       CAST(sum(CAST(op = 'upload' AS INTEGER)) AS BIGINT) AS n_uploads,
       CAST(sum(CAST(merging AS INTEGER)) AS BIGINT) AS n_merging,
       CAST(sum(CAST(evaluating AS INTEGER)) AS BIGINT) AS n_evaluating, CAST(sum(delta) AS BIGINT) AS delta
FROM b WHERE status = 'busy' GROUP BY ALL""",
    "live_requester": "WITH RECURSIVE " + LIVE + """
SELECT federation_id, event_id, op, claimed_version, server_version,
       CASE WHEN claimed_version > server_version THEN 'wait' ELSE 'upgrade' END AS action,
       greatest(claimed_version, server_version) AS next_version
FROM b WHERE status = 'wrong_version'""",
    "live_rounds": "WITH RECURSIVE " + LIVE + """,
pc AS (SELECT federation_id, version, client_id, arg_max(sample_size, i) AS sample_size
       FROM b JOIN (SELECT event_id, i FROM rq) USING (event_id)
       WHERE op = 'upload' AND status = 'accepted' GROUP BY ALL),
md AS (SELECT federation_id, version, count(*) AS n_models, CAST(sum(sample_size) AS BIGINT) AS total_samples
       FROM pc GROUP BY ALL),
ct AS (SELECT federation_id, version,
         CAST(count(*) FILTER (op = 'fetch' AND status = 'accepted') AS BIGINT) AS n_fetches,
         CAST(count(*) FILTER (op = 'upload' AND status = 'accepted') AS BIGINT) AS n_uploads,
         CAST(count(*) FILTER (status <> 'accepted') AS BIGINT) AS n_rejected, bool_or(closes) AS closed
       FROM b GROUP BY ALL)
SELECT federation_id, version, n_fetches, n_uploads, n_rejected, coalesce(n_models, 0) AS n_models,
       coalesce(total_samples, 0) AS total_samples, closed
FROM ct LEFT JOIN md USING (federation_id, version)""",
    "live_status": "WITH RECURSIVE " + LIVE + """,
la AS (SELECT federation_id, arg_max(server_version, i) AS version, arg_max(merging, i) AS merging,
              arg_max(evaluating, i) AS evaluating
       FROM b JOIN (SELECT event_id, i FROM rq) USING (event_id) GROUP BY federation_id),
pc AS (SELECT federation_id, version, client_id, arg_max(sample_size, i) AS sample_size
       FROM b JOIN (SELECT event_id, i FROM rq) USING (event_id)
       WHERE op = 'upload' AND status = 'accepted' GROUP BY ALL),
sz AS (SELECT federation_id, version, count(*) AS n, CAST(sum(sample_size) AS BIGINT) AS s FROM pc GROUP BY ALL)
SELECT federation_id, version, merging, evaluating, coalesce(n, 0) AS n_clients, coalesce(s, 0) AS total_samples
FROM la LEFT JOIN sz USING (federation_id, version)""",
    "live_published": "WITH RECURSIVE " + OBJECTS + """
SELECT federation_id, version, 'w' AS layer, CAST(pos AS INTEGER) AS pos, (round(value, 6) + 0.0) AS value
FROM pub""",
    "live_history": "WITH RECURSIVE " + SCORES + """,
nm AS (SELECT o.federation_id, CAST(o.version + 1 AS INTEGER) AS version, any_value(close_event) AS close_event,
              count(*) AS n_models, CAST(sum(n_uploads) AS BIGINT) AS n_uploads,
              CAST(sum(sample_size) AS BIGINT) AS total_samples
       FROM obj o JOIN cl ON cl.federation_id = o.federation_id AND cl.version = o.version GROUP BY ALL)
SELECT nm.federation_id, nm.version, close_event, n_models, n_uploads, total_samples,
       (round(accuracy, 6) + 0.0) AS accuracy, (round(macro_f1, 6) + 0.0) AS macro_f1
FROM nm LEFT JOIN fs USING (federation_id, version)""",
    "avg_blocks": "WITH " + UPDATES + """,
wt AS (SELECT version, content_hash, arg_max(sample_size, upload_seq) AS sample_size FROM upd GROUP BY ALL),
p2 AS (SELECT p.version, p.layer, p.pos, p.value, wt.sample_size FROM params p JOIN wt USING (version, content_hash)),
k AS (SELECT version, layer, pos, avg(value) AS u, sum(value * sample_size) / sum(sample_size) AS w FROM p2 GROUP BY ALL)
SELECT 'uniform' AS algo, version, layer, pos, (round(u, 6) + 0.0) AS value FROM k
UNION ALL SELECT 'weighted', version, layer, pos, (round(w, 6) + 0.0) FROM k
UNION ALL SELECT 'scaled_sum', version, layer, pos, (round(u, 6) + 0.0) FROM k""",
}
