"""DuckDB oracle SQL for the registered queries.

Each statement runs over the driver's pre-registered views. Shared CTEs are
kept as text blocks and composed per query; every computed column is aliased
to the name the Spark query uses, and doubles are rounded to 6 places on
both sides.
"""

from __future__ import annotations

LABELLED = """
labelled AS (
  SELECT d.doc_id, d.text, d.source AS client, d.n_chars, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

ENCODED = LABELLED + """,
enc AS (
  SELECT doc_id, text, client,
    CASE doc_id % 4 WHEN 0 THEN 'onehot' WHEN 1 THEN 'multifile'
                    WHEN 2 THEN 'binary' ELSE 'ordinal' END AS source,
    CAST(doc_id % 4 + 1 AS INTEGER) AS seq,
    CASE WHEN doc_id % 4 = 0 THEN toxic * CAST(doc_id % 3 = 0 AS INTEGER) END AS m1,
    CASE WHEN doc_id % 4 = 0 THEN toxic * CAST(doc_id % 3 = 1 AS INTEGER) END AS m2,
    CASE WHEN doc_id % 4 = 0 THEN toxic * CAST(doc_id % 3 = 2 AS INTEGER) END AS m3,
    CASE WHEN doc_id % 4 = 0 THEN 1 - toxic END AS p1,
    CASE WHEN doc_id % 4 = 1 THEN toxic END AS oh_label,
    CASE WHEN doc_id % 4 = 1 THEN client END AS file,
    CASE WHEN doc_id % 4 = 2 THEN toxic END AS hateful,
    CASE WHEN doc_id % 4 = 3 THEN
      CASE WHEN toxic IS NULL THEN NULL
           WHEN toxic = 1 AND quality = 0 THEN 0
           WHEN toxic = 1 AND quality = 1 THEN 1 ELSE 2 END END AS "class"
  FROM labelled
)"""

TAGGED = ENCODED + """,
tagged AS (
  SELECT source, seq, file, doc_id, text, 1 AS objectionable FROM enc
  WHERE text IS NOT NULL AND length(trim(text)) > 0 AND (
       (source = 'onehot' AND m1 + m2 + m3 = 1) OR (source = 'multifile' AND oh_label = 1)
    OR (source = 'binary' AND hateful = 1) OR (source = 'ordinal' AND "class" < 2))
  UNION ALL
  SELECT source, seq, file, doc_id, text, 0 AS objectionable FROM enc
  WHERE text IS NOT NULL AND length(trim(text)) > 0 AND (
       (source = 'onehot' AND p1 = 1) OR (source = 'multifile' AND oh_label = 0)
    OR (source = 'binary' AND hateful = 0) OR (source = 'ordinal' AND "class" = 2))
)"""

CORPUS = TAGGED + """,
corpus AS (SELECT DISTINCT text, objectionable FROM tagged)"""

SPLIT = CORPUS + """,
keyed AS (
  SELECT text, objectionable, md5('42:' || text) AS split_key,
         row_number() OVER (PARTITION BY objectionable ORDER BY md5('42:' || text), text) AS rk,
         count(*) OVER (PARTITION BY objectionable) AS n
  FROM corpus
),
split AS (
  SELECT text, objectionable, split_key,
    CASE WHEN rk <= n - (3 * n + 9) // 10 THEN 'train'
         WHEN rk <= n - (3 * n + 9) // 10
                   + ((3 * n + 9) // 10 - ((3 * n + 9) // 10 + 1) // 2) THEN 'val'
         ELSE 'test' END AS split
  FROM keyed
)"""

SOURCE_DISTINCT = TAGGED + """,
sd AS (SELECT DISTINCT source, seq, file, objectionable, text FROM tagged)"""

COUNTS = TAGGED + """,
per_text AS (SELECT source, seq, file, objectionable, text, count(*) AS n FROM tagged GROUP BY ALL),
counts AS (
  SELECT source, seq, file, objectionable, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct
  FROM per_text GROUP BY source, seq, file, objectionable
)"""

CORPUS_SQL = {
    "corpus_source_tags": "WITH " + TAGGED + "\nSELECT doc_id, source, objectionable FROM tagged",
    "corpus_source_counts": "WITH " + COUNTS
    + "\nSELECT source, file, objectionable, n_rows, n_distinct FROM counts",
    "corpus_running_totals": "WITH " + COUNTS + """,
ps AS (
  SELECT source, seq, file,
    CAST(sum(CASE WHEN objectionable = 1 THEN n_distinct ELSE 0 END) AS BIGINT) AS n_offensive,
    CAST(sum(CASE WHEN objectionable = 0 THEN n_distinct ELSE 0 END) AS BIGINT) AS n_inoffensive
  FROM counts GROUP BY source, seq, file
)
SELECT source, seq, file, n_offensive, n_inoffensive,
  CAST(sum(n_offensive) OVER (ORDER BY seq, file ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS cum_offensive,
  CAST(sum(n_inoffensive) OVER (ORDER BY seq, file ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS cum_inoffensive
FROM ps""",
    "corpus_sketch_counts": "WITH " + TAGGED + """
SELECT source, objectionable, count(*) AS n_rows, count(DISTINCT text) AS n_distinct, true AS within
FROM tagged GROUP BY ALL""",
    "corpus_source_distinct": "WITH " + SOURCE_DISTINCT
    + "\nSELECT source, file, objectionable, text FROM sd",
    "corpus_bag_union": "WITH " + SOURCE_DISTINCT + "\nSELECT text, objectionable FROM sd",
    "corpus_dedup": "WITH " + CORPUS + "\nSELECT text, objectionable FROM corpus",
    "corpus_grand_total": "WITH " + SOURCE_DISTINCT + "\nSELECT count(*) AS n_total FROM sd",
    "corpus_split": "WITH " + SPLIT + "\nSELECT text, objectionable, split FROM split",
    "corpus_split_summary": "WITH " + SPLIT + """
SELECT split, count(*) AS n_rows, (round(avg(CAST(objectionable AS DOUBLE)), 6) + 0.0) AS positive_rate
FROM split GROUP BY split""",
    "corpus_vote_totals": "WITH " + ENCODED + """
SELECT text, CAST(sum(m1) AS BIGINT) AS votes_1, CAST(sum(m2) AS BIGINT) AS votes_2,
       CAST(sum(m3) AS BIGINT) AS votes_3
FROM enc WHERE source = 'onehot' AND m1 + m2 + m3 = 1 GROUP BY text""",
    "corpus_label_conflicts": "WITH " + LABELLED + """,
ann AS (
  SELECT doc_id, text, toxic AS objectionable FROM labelled
  UNION ALL
  SELECT doc_id, text, 1 - toxic AS objectionable FROM labelled WHERE doc_id % 10 = 0
)
SELECT sha256(text) AS text_hash, count(DISTINCT objectionable) AS n_labels, count(*) AS n_rows
FROM ann GROUP BY sha256(text) HAVING count(DISTINCT objectionable) > 1""",
    "corpus_training_frame": "WITH " + SPLIT
    + "\nSELECT text, objectionable AS labels FROM split WHERE split = 'train'",
}

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(CORPUS_SQL)

# Averaging is over distinct objects: one row per (version, content hash).
UPDATES = """
base AS (
  SELECT CAST(label AS INTEGER) AS version, vec_id, embedding,
         sha256(array_to_string(list_transform(embedding,
           lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)), ','))
           AS content_hash
  FROM embeddings
),
upd AS (
  SELECT version, vec_id AS client_id, 0 AS upload_seq, content_hash,
         1 + vec_id % 97 AS sample_size, embedding FROM base
  UNION ALL
  SELECT version, vec_id, 1, content_hash, 2 + vec_id % 97, embedding FROM base
  WHERE vec_id % 7 = 0
  UNION ALL
  SELECT version, vec_id + 1000000, 2, content_hash, 3 + vec_id % 97, embedding FROM base
  WHERE vec_id % 5 = 0
),
objects AS (
  SELECT version, content_hash, any_value(embedding) AS embedding FROM upd
  GROUP BY version, content_hash
),
params AS (
  SELECT version, content_hash, 'w' AS layer, CAST(i - 1 AS INTEGER) AS pos,
         CAST(embedding[i] AS DOUBLE) AS value
  FROM objects, unnest(generate_series(1, len(embedding))) AS g(i)
),
nm AS (SELECT version, count(*) AS n_models FROM objects GROUP BY version),
weights AS (
  SELECT version, content_hash, arg_max(sample_size, upload_seq) AS sample_size
  FROM upd GROUP BY version, content_hash
)"""

UPLOADS = """
ing AS (
  SELECT doc_id, CAST(doc_id % 4 AS INTEGER) AS version,
    CASE WHEN doc_id % 43 <> 0 AND doc_id % 47 <> 0 THEN sha256(text) END AS content_hash,
    CASE WHEN doc_id % 43 <> 0 AND doc_id % 47 <> 0
         THEN CAST(octet_length(encode(text)) AS BIGINT) END AS size,
    CASE WHEN doc_id % 37 = 0 THEN NULL WHEN doc_id % 41 = 0 THEN -4 ELSE n_chars END
      AS sample_size
  FROM documents
),
named AS (
  SELECT *, CASE WHEN content_hash IS NOT NULL
                 THEN 'local_v' || version || '_' || content_hash || '.zip' END AS object_name,
         CASE WHEN content_hash IS NOT NULL AND sample_size >= 1 THEN 'accepted'
              ELSE 'rejected' END AS status
  FROM ing
),
acc AS (SELECT * FROM named WHERE status = 'accepted'),
stored AS (
  SELECT version, content_hash, any_value(object_name) AS object_name, any_value(size) AS size,
         count(*) AS n_uploads
  FROM acc GROUP BY version, content_hash
),
latest AS (
  SELECT version, content_hash, arg_max(sample_size, doc_id) AS sample_size
  FROM acc GROUP BY version, content_hash
)"""

GAPS = UPDATES + """,
objs AS (SELECT version, content_hash, count(*) AS n_uploads FROM upd WHERE client_id % 17 <> 0
         GROUP BY version, content_hash),
wts AS (SELECT version, content_hash, arg_max(sample_size, upload_seq) AS sample_size
        FROM upd WHERE client_id % 13 <> 0 GROUP BY version, content_hash)"""

AVERAGING_SQL = {
    "avg_scaled": "WITH " + UPDATES + """
SELECT version, content_hash, layer, pos, (round(value / n_models, 6) + 0.0) AS scaled
FROM params JOIN nm USING (version)""",
    "avg_sum_scaled": "WITH " + UPDATES + """
SELECT version, layer, pos, (round(avg(value), 6) + 0.0) AS value FROM params GROUP BY ALL""",
    "avg_uniform": "WITH " + UPDATES + """
SELECT version, layer, pos, (round(avg(value), 6) + 0.0) AS value FROM params GROUP BY ALL""",
    "params_published": "WITH " + UPDATES + """
SELECT version, layer, pos, (round(avg(value), 6) + 0.0) AS value FROM params GROUP BY ALL""",
    "avg_weighted": "WITH " + UPDATES + """
SELECT version, layer, pos, (round(sum(value * sample_size) / sum(sample_size), 6) + 0.0) AS value
FROM params JOIN weights USING (version, content_hash) GROUP BY version, layer, pos""",
    "avg_order_property": "WITH " + UPDATES + """
SELECT version, layer, pos, (round(avg(value), 6) + 0.0) AS divide_then_add,
       (round(avg(value), 6) + 0.0) AS add_then_divide, true AS agree
FROM params GROUP BY ALL""",
    "avg_cohorts": "WITH " + UPDATES + """,
r AS (SELECT *, row_number() OVER (PARTITION BY version ORDER BY content_hash) - 1 AS rk FROM objects),
dealt AS (
  SELECT version, content_hash,
         CAST(rk // 11 * 3 + CASE WHEN rk % 11 < 4 THEN 0 WHEN rk % 11 < 7 THEN 1 ELSE 2 END AS INTEGER) AS cohort
  FROM r)
SELECT version, cohort, layer, pos, (round(avg(value), 6) + 0.0) AS value
FROM params JOIN dealt USING (version, content_hash) GROUP BY ALL""",
    "uploads_ingest": "WITH " + UPLOADS + """
SELECT doc_id, version, content_hash, object_name, sample_size, status FROM named""",
    "uploads_dedupe": "WITH " + UPLOADS + """
SELECT version, content_hash, object_name, size, n_uploads FROM stored""",
    "uploads_listing": "WITH " + UPLOADS + """
SELECT version, object_name AS name, content_hash AS key, size,
       count(*) OVER (PARTITION BY version) AS n_objects,
       (round(avg(size) OVER (PARTITION BY version), 6) + 0.0) AS mean_size
FROM stored""",
    "object_files": "WITH " + UPDATES + """,
f AS (SELECT version, content_hash,
        octet_length(encode('[' || array_to_string(list_transform(embedding,
          lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)), ',') || ']')) + 1 AS length
      FROM objects)
SELECT version, 'local_v' || version || '_' || content_hash || '.zip' AS name, content_hash AS key, length,
       count(*) OVER (PARTITION BY version) AS n_objects,
       (round(avg(length) OVER (PARTITION BY version), 6) + 0.0) AS mean_size
FROM f""",
    "uploads_global_names": "WITH " + UPLOADS + """
SELECT version + 1 AS version, CAST(sum(size) AS BIGINT) AS bytes,
       'global_v' || (version + 1) || '.zip' AS object_name
FROM stored GROUP BY version""",
    "uploads_last_write": "WITH " + UPLOADS + """
SELECT version, content_hash, sample_size FROM latest""",
    "uploads_shares": "WITH " + UPLOADS + """
SELECT version, content_hash, sample_size,
       (round(sample_size / sum(sample_size) OVER (PARTITION BY version), 6) + 0.0) AS share
FROM latest""",
    "avg_join_weights": "WITH " + GAPS + """
SELECT version, content_hash, n_uploads, sample_size FROM objs JOIN wts USING (version, content_hash)""",
    "avg_weight_gaps": "WITH " + GAPS + """
SELECT version, content_hash, 'no_weight' AS gap FROM objs ANTI JOIN wts USING (version, content_hash)
UNION ALL
SELECT version, content_hash, 'no_object' AS gap FROM wts ANTI JOIN objs USING (version, content_hash)""",
    "scaled_global_mean": """
SELECT (round(sum(event_id / (SELECT count(*) FROM events)), 6) + 0.0) AS scaled_sum,
       (round(sum(value / (SELECT count(*) FROM events)), 6) + 0.0) AS scaled_value_sum,
       count(*) AS n
FROM events""",
}
ORACLE_SQL.update(AVERAGING_SQL)

ROUNDS = """
re AS (
  SELECT CAST(user_id % 16 AS INTEGER) AS federation_id, event_id, ts, user_id AS client_id,
    CASE WHEN event_type IN ('view', 'click') THEN 'fetch' ELSE 'upload' END AS op,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS sample_size
  FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')
),
rq AS (
  SELECT *, CAST(event_id // 1000 AS INTEGER) AS server_version,
         CAST(event_id // 1000 + CASE WHEN event_id % 5 = 0 THEN -1 WHEN event_id % 7 = 0 THEN 1
              ELSE 0 END AS INTEGER) AS claimed_version,
         event_id % 23 = 0 AS busy, event_id % 29 = 0 AS missing
  FROM re
),
ad AS (
  SELECT *, CASE WHEN claimed_version <> server_version THEN 'wrong_version'
                 WHEN op = 'fetch' AND missing THEN 'missing'
                 WHEN busy THEN 'busy' ELSE 'accepted' END AS status
  FROM rq
),
dec AS (
  SELECT *,
    CASE op || '_' || status
      WHEN 'fetch_wrong_version' THEN 'Requested version is unavailable'
      WHEN 'fetch_missing' THEN 'Could not find resource'
      WHEN 'fetch_busy' THEN 'Served, but not counted: the next model is in the making'
      WHEN 'upload_wrong_version' THEN 'Upload request is for a bad version'
      WHEN 'upload_busy' THEN 'Upload request denied'
      WHEN 'fetch_accepted' THEN 'Sending global model'
      WHEN 'upload_accepted' THEN 'Successfully saved client model' END AS details,
    CASE WHEN op = 'fetch' AND status = 'accepted' THEN 1
         WHEN op = 'upload' AND status = 'accepted' THEN -1 ELSE 0 END AS delta
  FROM ad
),
bal AS (
  SELECT *, CAST(sum(delta) OVER (PARTITION BY federation_id ORDER BY ts, event_id
                                  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance
  FROM dec
),
cl AS (SELECT *, (op = 'upload' AND status = 'accepted' AND balance = 0) AS closes FROM bal),
b AS (
  SELECT *, CAST(sum(CAST(closes AS INTEGER)) OVER (PARTITION BY federation_id ORDER BY ts, event_id
                 ROWS UNBOUNDED PRECEDING) - CAST(closes AS INTEGER) AS INTEGER) AS version
  FROM cl
),
pc AS (
  SELECT federation_id, version, client_id, sample_size FROM (
    SELECT *, row_number() OVER (PARTITION BY federation_id, version, client_id
                                 ORDER BY ts DESC, event_id DESC) AS rn
    FROM b WHERE op = 'upload' AND status = 'accepted') WHERE rn = 1
),
md AS (
  SELECT federation_id, version, count(*) AS n_models, CAST(sum(sample_size) AS BIGINT) AS total_samples
  FROM pc GROUP BY ALL
),
ct AS (
  SELECT federation_id, version,
    CAST(sum(CASE WHEN op = 'fetch' AND status = 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS n_fetches,
    CAST(sum(CASE WHEN op = 'upload' AND status = 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS n_uploads,
    CAST(sum(CASE WHEN status <> 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected,
    bool_or(closes) AS closed, min(ts) AS opened_at, max(CASE WHEN closes THEN ts END) AS closed_at
  FROM b GROUP BY ALL
),
hist AS (
  SELECT ct.federation_id, ct.version, n_fetches, n_uploads, n_rejected,
         CAST(coalesce(n_models, 0) AS BIGINT) AS n_models,
         CAST(coalesce(total_samples, 0) AS BIGINT) AS total_samples, closed, opened_at, closed_at
  FROM ct LEFT JOIN md ON ct.federation_id = md.federation_id AND ct.version = md.version
),
cur AS (SELECT federation_id, max(version) AS version FROM hist GROUP BY federation_id)"""

ROUNDS_SQL = {
    "rounds_admission": "WITH " + ROUNDS + """
SELECT federation_id, event_id, op, status, details, delta FROM dec""",
    "rounds_balance": "WITH " + ROUNDS + "\nSELECT federation_id, event_id, balance FROM b",
    "rounds_barrier": "WITH " + ROUNDS
    + "\nSELECT federation_id, event_id, version FROM b WHERE closes",
    "rounds_history": "WITH " + ROUNDS + """
SELECT federation_id, version, n_fetches, n_uploads, n_rejected, n_models, total_samples, closed,
       epoch_us(opened_at) AS opened_us, epoch_us(closed_at) AS closed_us,
       epoch_us(closed_at) - epoch_us(opened_at) AS elapsed_us
FROM hist""",
    "rounds_requester": "WITH " + ROUNDS + """
SELECT federation_id, event_id, op, claimed_version, server_version,
       CASE WHEN claimed_version > server_version THEN 'wait' ELSE 'upgrade' END AS action,
       greatest(claimed_version, server_version) AS next_version
FROM dec WHERE status = 'wrong_version'""",
    "rounds_rejects": "WITH " + ROUNDS + """
SELECT federation_id, event_id, op, status, details, claimed_version, server_version
FROM dec WHERE status <> 'accepted'""",
    "rounds_hold_off": "WITH " + ROUNDS + """
SELECT b.federation_id, b.event_id, b.version,
       coalesce(epoch_us(b.ts) <= epoch_us(h.closed_at) + 600 * 1000000, false) AS held
FROM b LEFT JOIN hist h ON h.closed AND h.federation_id = b.federation_id
  AND h.version = b.version - 1""",
    "rounds_latest_version": "WITH " + ROUNDS + """
SELECT federation_id, CAST(max(version) + 1 AS INTEGER) AS published_version,
       epoch_us(arg_max(closed_at, version)) AS published_us, count(*) AS n_closed
FROM hist WHERE closed GROUP BY federation_id""",
    "rounds_status": "WITH " + ROUNDS + """,
entries AS (
  SELECT event_id, client_id, 'c1' AS client, event_id % 11 AS size, 1 AS seq FROM re
  WHERE op = 'upload'
  UNION ALL
  SELECT event_id, client_id, CAST(client_id % 3 AS VARCHAR), event_id % 5, 1 FROM re
  WHERE op = 'upload'
  UNION ALL
  SELECT event_id, client_id, CAST(client_id AS VARCHAR), sample_size, 2 FROM re
  WHERE op = 'upload'
)
SELECT event_id, client_id, CAST(event_id % 9 AS INTEGER) AS version, event_id % 2 = 0 AS merging,
       event_id % 3 = 0 AS evaluating, client, arg_max(size, seq) AS sample_size
FROM entries GROUP BY event_id, client_id, client""",
    "rounds_pending_updates": "WITH " + ROUNDS + """
SELECT b.federation_id, b.version, event_id, client_id, sample_size
FROM b JOIN cur ON b.federation_id = cur.federation_id AND b.version = cur.version
WHERE op = 'upload' AND status = 'accepted'""",
}
ORACLE_SQL.update(ROUNDS_SQL)

# Model: features are ln(1 + bucket counts) scaled to length 1, the bias is bucket -1 with
# x = 1; one class-balanced gradient step from the zero model with lr = 5, bias at the centre.
def _features(name: str, source: str, keys: str) -> str:
    """CTEs {name}tok, {name}cnt, {name}rows of a relation with a text column."""
    return f"""
{name}tok AS (
  SELECT {keys}, t FROM (
    SELECT {keys}, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS t FROM {source})
  WHERE t <> ''
),
{name}cnt AS (
  SELECT {keys}, CAST(('0x' || substr(md5(t), 1, 8))::BIGINT % 4096 AS INTEGER) AS bucket,
         count(*) AS c
  FROM {name}tok GROUP BY ALL
),
{name}rows AS (
  SELECT {keys}, bucket, ln(1 + c) / sqrt(sum(pow(ln(1 + c), 2)) OVER (PARTITION BY {keys})) AS x
  FROM {name}cnt
  UNION ALL SELECT {keys}, -1, 1.0 FROM {source}
)"""


def _step(name: str, source: str, group: str) -> str:
    """CTEs of one step from the zero model (residual 0.5 - label) per group: {name}delta,
    and of the version that the mean of the groups makes: {name}p1."""
    return f"""
{name}sum AS (
  SELECT {group}, bucket, sum(CASE WHEN objectionable = 0 THEN x ELSE 0.0 END) AS x0,
         sum(CASE WHEN objectionable = 1 THEN x ELSE 0.0 END) AS x1
  FROM {source} GROUP BY {group}, bucket
),
{name}delta AS (
  SELECT s.{group}, CASE WHEN s.bucket = -1 THEN 'bias' ELSE 'weight' END AS layer,
         CASE WHEN s.bucket = -1 THEN 0 ELSE s.bucket END AS pos,
         -2.5 * (CASE WHEN z.x1 > 0 THEN -0.5 * s.x1 / z.x1 ELSE 0.0 END
               + CASE WHEN z.x0 > 0 THEN 0.5 * s.x0 / z.x0 ELSE 0.0 END) AS delta,
         CAST(z.x0 + z.x1 AS BIGINT) AS sample_size, s.x0, s.x1
  FROM {name}sum s JOIN {name}sum z ON s.{group} = z.{group} AND z.bucket = -1
),
{name}tot AS (SELECT sum(sample_size) AS w, sum(x0) AS n0, sum(x1) AS n1 FROM {name}delta
              WHERE layer = 'bias'),
{name}avg AS (
  SELECT layer, pos, sum(delta * sample_size) / any_value(w) AS delta,
         (sum(x0) / any_value(n0) + sum(x1) / any_value(n1)) / 2 AS centre
  FROM {name}delta, {name}tot WHERE layer = 'weight' GROUP BY layer, pos
),
{name}p1 AS (
  SELECT 1 AS version, 'weight' AS layer, CAST(i AS INTEGER) AS pos,
         coalesce(delta, 0.0) AS value
  FROM range(4096) r(i) LEFT JOIN {name}avg ON pos = i
  UNION ALL SELECT 1, 'bias', 0, -sum(delta * centre) FROM {name}avg
  UNION ALL SELECT 1, 'n_buckets', 0, 4096.0
  UNION ALL SELECT 1, 'lr', 0, 5.0
)"""


def _scores(name: str, rows: str, keys: str) -> str:
    return f"""
{name} AS (
  SELECT {keys}, sum(x * w) AS z, CAST(CASE WHEN sum(x * w) > 0 THEN 1 ELSE 0 END AS INTEGER)
         AS prediction
  FROM {rows} JOIN w1 USING (bucket) GROUP BY {keys}
)"""


MODEL = SPLIT + "," + _features("k", "split", "split_key, objectionable, split") + """,
heldout AS (SELECT DISTINCT split_key FROM split WHERE split <> 'train'),
owner AS (
  SELECT DISTINCT client, md5('42:' || text) AS split_key, toxic AS objectionable
  FROM labelled WHERE toxic IS NOT NULL
),
crows AS (
  SELECT client, krows.* FROM krows JOIN owner USING (split_key, objectionable)
  WHERE split = 'train' AND split_key NOT IN (SELECT split_key FROM heldout)
),""" + _step("c", "crows", "client") + """,
w1 AS (
  SELECT CASE WHEN layer = 'bias' THEN -1 ELSE pos END AS bucket, value AS w
  FROM cp1 WHERE layer IN ('weight', 'bias')
)"""

SCORED = "WITH " + MODEL + "," + _scores("sc", "krows", "split_key, objectionable, split")

#: Three models (v0 predicts 0 everywhere, v1 averaged with itself is v1) and their reports.
REPORT = SCORED + """,
sm AS (
  SELECT 'v0' AS model, split, objectionable, 0 AS prediction FROM sc
  UNION ALL SELECT 'v1', split, objectionable, prediction FROM sc
  UNION ALL SELECT 'v1_self', split, objectionable, prediction FROM sc
),
conf AS (SELECT model, split, objectionable AS label, prediction, count(*) AS n FROM sm GROUP BY ALL),
sides AS (
  SELECT model, split, label AS class, n AS support,
         CASE WHEN label = prediction THEN n ELSE 0 END AS tp, 0 AS predicted FROM conf
  UNION ALL
  SELECT model, split, prediction, 0, 0, n FROM conf
),
pc AS (
  SELECT model, split, class, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted
  FROM sides GROUP BY ALL
),
m AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
            CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
  FROM pc
),
m2 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
            ELSE 0.0 END AS f1
  FROM m
),
summ AS (
  SELECT model, split, sum(tp) AS tp, sum(support) AS total, avg(precision) AS mp,
         avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) AS wp,
         sum(recall * support) AS wr, sum(f1 * support) AS wf
  FROM m2 GROUP BY model, split
),
rep AS (
  SELECT model, split, CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM m2
  UNION ALL SELECT model, split, 'accuracy', NULL, NULL, tp / total, total FROM summ
  UNION ALL SELECT model, split, 'macro avg', mp, mr, mf, total FROM summ
  UNION ALL SELECT model, split, 'weighted avg', wp / total, wr / total, wf / total, total FROM summ
),
rounded AS (
  SELECT model, split, class, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall,
         round(f1, 6) + 0.0 AS f1, CAST(support AS BIGINT) AS support
  FROM rep
)"""

MODEL_SQL = {
    "model_features": "WITH " + _features("f", "documents", "doc_id") + """,
n AS (SELECT doc_id, count(*) AS n_tokens FROM ftok GROUP BY doc_id)
SELECT doc_id, n_tokens, bucket, (round(x, 6) + 0.0) AS x FROM frows JOIN n USING (doc_id)
WHERE bucket >= 0""",
    "model_client_step": "WITH " + MODEL + """
SELECT client, layer, pos, (round(delta, 6) + 0.0) AS delta, sample_size FROM cdelta""",
    "model_round": "WITH " + MODEL + """
SELECT version, layer, pos, (round(value, 6) + 0.0) AS value FROM cp1""",
    "model_central_step": "WITH " + MODEL + """,
trows AS (SELECT * FROM krows WHERE split = 'train'),""" + _step("t", "trows", "split") + """
SELECT version, layer, pos, (round(value, 6) + 0.0) AS value FROM tp1""",
    "model_scores": SCORED + """
SELECT split, split_key, objectionable, (round(z, 6) + 0.0) AS z, prediction FROM sc
WHERE split <> 'train'""",
    "eval_confusion": SCORED + """
SELECT split, objectionable AS label, prediction, count(*) AS n FROM sc GROUP BY ALL""",
    "eval_wrong": SCORED + """
SELECT split, split_key, objectionable, prediction FROM sc
WHERE split <> 'train' AND prediction <> objectionable""",
    "eval_report": REPORT + """
SELECT split, class, precision, recall, f1, support FROM rounded WHERE model = 'v1'""",
    "eval_compare": REPORT + """,
pairs(a, b) AS (VALUES ('v0', 'v1'), ('v1', 'v1_self')),
keys AS (SELECT DISTINCT split, class FROM rounded WHERE split <> 'train')
SELECT keys.split, keys.class, b || '-' || a AS pair,
       round(y.precision - x.precision, 6) + 0.0 AS d_precision,
       round(y.recall - x.recall, 6) + 0.0 AS d_recall, round(y.f1 - x.f1, 6) + 0.0 AS d_f1
FROM keys JOIN pairs ON true
LEFT JOIN rounded x ON x.model = a AND x.split = keys.split AND x.class = keys.class
LEFT JOIN rounded y ON y.model = b AND y.split = keys.split AND y.class = keys.class""",
    "conversation_flags": "WITH " + MODEL + """,
ut AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),""" + _features(
        "u", "ut", "conv_id, turn") + "," + _scores("us", "urows", "conv_id, turn") + """
SELECT conv_id, count(*) AS n_user_turns, (round(max(z), 6) + 0.0) AS max_z,
       max(prediction) AS flagged
FROM us GROUP BY conv_id""",
}
ORACLE_SQL.update(MODEL_SQL)
