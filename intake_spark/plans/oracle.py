"""DuckDB SQL for every registered query (same column names).

The SQL restates each derivation and operator directly over the driver's
views (``events``, ``documents``, ...), independently of the Spark code: a
plain window per key for W1, ``regexp_full_match`` with hand-written regexes
for the globs, ``row_number`` instead of arg-max aggregates.
"""

from __future__ import annotations

SCAN_LOG = """
obs AS (
  SELECT event_type AS watch, CAST(user_id AS VARCHAR) AS name, CAST(ts AS DATE) AS scan_day,
         CAST(floor(max(value) / 50) AS BIGINT) AS size
  FROM events GROUP BY 1, 2, 3),
scans AS (
  SELECT watch, scan_day, row_number() OVER (PARTITION BY watch ORDER BY scan_day) AS scan_no
  FROM (SELECT DISTINCT event_type AS watch, CAST(ts AS DATE) AS scan_day FROM events)),
log AS (SELECT o.watch, s.scan_no, o.name, o.size FROM obs o JOIN scans s USING (watch, scan_day)),
lagged AS (
  SELECT *, lag(scan_no) OVER w AS p_scan, lag(size) OVER w AS p_size
  FROM log WINDOW w AS (PARTITION BY watch, name ORDER BY scan_no)),
flagged AS (
  SELECT *, CASE WHEN p_scan = scan_no - 1 AND p_size IS NOT DISTINCT FROM size THEN 0 ELSE 1 END AS brk
  FROM lagged),
runs AS (
  SELECT *, sum(brk) OVER (PARTITION BY watch, name ORDER BY scan_no ROWS UNBOUNDED PRECEDING) AS run_id
  FROM flagged),
counted AS (
  SELECT watch, scan_no, name, size,
         CAST(least(row_number() OVER (PARTITION BY watch, name, run_id ORDER BY scan_no), 1000000) AS BIGINT)
           AS cnt
  FROM runs)
"""

SQL: dict[str, str] = {}

SQL["stable_candidates"] = f"""
WITH {SCAN_LOG}
SELECT watch, CAST(scan_no AS BIGINT) AS scan_no, name, size,
       sha1(name || CAST(size AS VARCHAR)) AS hash, cnt AS "count"
FROM counted WHERE cnt >= 2
"""

SQL["latest_snapshot"] = f"""
WITH {SCAN_LOG},
latest AS (SELECT watch, max(scan_no) AS scan_no FROM scans GROUP BY watch),
snap AS (SELECT c.* FROM counted c JOIN latest l USING (watch, scan_no) WHERE c.cnt >= 2)
SELECT watch, CAST(scan_no AS BIGINT) AS scan_no, name, size,
       sha1(name || CAST(size AS VARCHAR)) AS hash, cnt AS "count",
       count(*) OVER (PARTITION BY watch) AS n_in_snapshot
FROM snap
"""

SQL["scan_counts"] = f"""
WITH {SCAN_LOG},
per AS (SELECT watch, scan_no, count(*) AS n_files, count(*) FILTER (WHERE cnt >= 2) AS n_candidates,
               max(cnt) AS max_count FROM counted GROUP BY 1, 2)
SELECT s.watch, CAST(s.scan_no AS BIGINT) AS scan_no,
       CAST(coalesce(p.n_files, 0) AS BIGINT) AS n_files,
       CAST(coalesce(p.n_candidates, 0) AS BIGINT) AS n_candidates,
       CAST(coalesce(p.max_count, 0) AS BIGINT) AS max_count
FROM scans s LEFT JOIN per p USING (watch, scan_no)
"""

INVENTORY = r"""
files AS (
  SELECT source AS watch, doc_id, lang, n_chars AS size,
         lang || '/' || CAST(doc_id AS VARCHAR) ||
         CASE doc_id % 3 WHEN 0 THEN '_std.raw' WHEN 1 THEN '.raw' ELSE '.d/analysis.tdf' END AS rel
  FROM documents),
inv AS (
  SELECT watch, rel, regexp_extract(rel, '([^/]*)$', 1) AS name, '/data/' || watch || '/' || rel AS abs,
         false AS is_dir FROM files
  UNION ALL
  SELECT DISTINCT watch, lang, lang, '/data/' || watch || '/' || lang, true FROM files
  UNION ALL
  SELECT watch, lang || '/' || CAST(doc_id AS VARCHAR) || '.d', CAST(doc_id AS VARCHAR) || '.d',
         '/data/' || watch || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.d', true
  FROM files WHERE doc_id % 3 = 2)
"""

SQL["include_match"] = rf"""
WITH {INVENTORY},
pats(watch, rx) AS (VALUES
  ('src1', '(.*/)?[^/]*\.d'), ('src1', '(.*/)?de/[^/]*\.raw'), ('src1', '(.*/)?de/[^/]*\.d'),
  ('src2', '(.*/)?[^/]*/1[^/]\.raw'), ('src2', '(.*/)?[^/]*/1[^/]\.d'), ('src2', '(.*/)?es'),
  ('src2', '(.*/)?[^/]*\.tdf'),
  ('src3', '(.*/)?[^e/][^/]*/[^/]*[05]\.raw'), ('src3', '(.*/)?[^e/][^/]*/[^/]*[05]\.d'),
  ('src4', '(.*/)?analysis\.tdf')),
dflt(rx) AS (VALUES ('(.*/)?[^/]*_std\.raw'), ('(.*/)?[^/]*_std\.d'))
SELECT watch, rel, name, is_dir FROM inv i
WHERE (NOT is_dir OR lower(name) LIKE '%.d')
  AND CASE WHEN watch IN (SELECT watch FROM pats)
           THEN EXISTS (SELECT 1 FROM pats p WHERE p.watch = i.watch AND regexp_full_match(i.rel, p.rx))
           ELSE EXISTS (SELECT 1 FROM dflt d WHERE regexp_full_match(i.rel, d.rx)) END
"""

SQL["ignore_filter"] = rf"""
WITH {INVENTORY},
user_lits(p) AS (VALUES ('en/7.raw'), ('/data/src5/es'), ('zz_unused.raw')),
ledger AS (
  SELECT CASE WHEN doc_id % 3 = 2 THEN CAST(doc_id AS VARCHAR) || '.d'
              ELSE regexp_extract(rel, '([^/]*)$', 1) END AS p
  FROM files WHERE doc_id IN (SELECT doc_id FROM labels)),
lits AS (SELECT p FROM user_lits UNION SELECT p FROM ledger),
globs(rx) AS (VALUES ('.*\.tdf'), ('fr/.*'), ('.*1_std\.raw'), ('en/4.\.raw'), ('/data/src3/.*'),
                     ('[^a-z].*9\.d'), ('de/1[0-5].*'))
SELECT watch, rel, name, is_dir FROM inv i
WHERE NOT EXISTS (SELECT 1 FROM lits l WHERE l.p = i.rel OR l.p = i.name OR l.p = i.abs)
  AND NOT EXISTS (SELECT 1 FROM globs g WHERE regexp_full_match(i.rel, g.rx)
                  OR regexp_full_match(i.name, g.rx) OR regexp_full_match(i.abs, g.rx))
"""

SQL["dir_size_rollup"] = r"""
WITH m AS (SELECT 'run' || CAST(l_orderkey AS VARCHAR) || '.d' AS dir, CAST(trunc(l_quantity) AS BIGINT) AS size
           FROM lineitem),
s AS (SELECT dir, sum(size) AS size, count(*) AS n_files FROM m GROUP BY dir),
d AS (SELECT DISTINCT 'run' || CAST(o_orderkey AS VARCHAR) || '.d' AS dir FROM orders)
SELECT coalesce(d.dir, s.dir) AS dir, CAST(coalesce(s.size, 0) AS BIGINT) AS size,
       CAST(coalesce(s.n_files, 0) AS BIGINT) AS n_files
FROM d FULL OUTER JOIN s ON d.dir = s.dir
"""

SQL["last_wins_listing"] = r"""
WITH l AS (
  SELECT 'p' || CAST(l_partkey AS VARCHAR) || '.raw' AS name,
         CASE WHEN l_orderkey % 2 = 0 THEN 'Run' ELSE 'run' END || CAST(l_orderkey AS VARCHAR)
           || '/p' || CAST(l_partkey AS VARCHAR) || '.raw' AS rel,
         CAST(trunc(l_quantity) AS BIGINT) AS size
  FROM lineitem)
SELECT name, rel, size FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY lower(rel) DESC, rel DESC, size DESC) AS rn FROM l)
WHERE rn = 1
"""

SQL["pattern_normalize"] = r"""
WITH s AS (SELECT p_partkey, '*' || p_type || '.raw,*' || p_brand || '.d; *' || p_type || '.raw' AS pat FROM part),
parts AS (SELECT p_partkey,
                 list_filter(list_transform(string_split_regex(pat, '[,;|]'), lambda x: trim(x)),
                             lambda x: x <> '') AS l FROM s),
ex AS (SELECT p_partkey,
              flatten(list_transform(l, lambda x: CASE WHEN x LIKE '%.raw'
                                                       THEN [x, left(x, length(x) - 4) || '.d'] ELSE [x] END)) AS l2
       FROM parts),
u AS (SELECT p_partkey, unnest(l2) AS pattern, unnest(range(length(l2))) AS i FROM ex),
d AS (SELECT p_partkey, pattern, min(i) AS i FROM u GROUP BY ALL)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY i) - 1 AS BIGINT) AS pos, pattern FROM d
"""

SQL["row_key"] = r"""
WITH f AS (
  SELECT doc_id, n_chars AS size, '/data/' || source AS folder,
         lang || '/' || CAST(doc_id AS VARCHAR) ||
         CASE doc_id % 3 WHEN 0 THEN '_std.raw' WHEN 1 THEN '.raw' ELSE '.d' END AS src_rel
  FROM documents),
n AS (SELECT doc_id, size, folder,
             CASE WHEN doc_id % 2 = 0 THEN src_rel ELSE folder || '/' || src_rel END AS name FROM f),
a AS (SELECT *, CASE WHEN starts_with(name, '/') THEN name ELSE folder || '/' || name END AS abs FROM n)
SELECT doc_id, name, size, sha1(name || CAST(size AS VARCHAR)) AS key, abs,
       regexp_extract(abs, '([^/]*)/*$', 1) AS base,
       regexp_replace(regexp_extract(abs, '([^/]*)/*$', 1), '^(.+)\.[^.]+$', '\1') AS stem,
       coalesce(nullif(regexp_replace(trim(name), '[^A-Za-z0-9._-]+', '_', 'g'), ''), 'x') AS slug
FROM a
"""

CONTENT_CANDIDATES = r"""
c AS (SELECT md5(text) || '.raw' AS name, n_chars AS size, source AS watch,
             CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) AS watch_idx, doc_id FROM documents)
"""

SQL["unprocessed"] = rf"""
WITH {CONTENT_CANDIDATES},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, size ORDER BY watch_idx, doc_id) AS rn FROM c)
      WHERE rn = 1),
p AS (SELECT DISTINCT name, size FROM c WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT name, size, watch, doc_id FROM f
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.name = f.name AND p.size = f.size)
"""

SQL["still_exists"] = r"""
SELECT o_orderkey AS job, '/data/run' || CAST(o_orderkey AS VARCHAR) || '.d' AS abs
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
"""

SQL["ledger_append"] = rf"""
WITH {CONTENT_CANDIDATES},
ex AS (SELECT name FROM c WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT DISTINCT name FROM c WHERE name NOT IN (SELECT name FROM ex)
"""

SQL["prefix_match"] = r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) AS path FROM pages),
r(root) AS (VALUES ('blog.tionsh.example.com'), ('blog.tionsh.example.com/en'), ('tionble.example.org/'),
                   ('m.ththth.example.net/en'), ('m.ththth.example.net/fr/'), ('www.ththon.example.org/de'),
                   ('ththan.example.com'), ('nothing.example.com'),
                   ('blog.tionsh.example.net'), ('blog.tionsh.example.net/en'), ('blog.tiontion.example.com/en/'),
                   ('thther.example.org'), ('www.ththhe.example.com/en'), ('m.tionsh.example.net'),
                   ('thther.example.com')),
rn AS (SELECT DISTINCT root, regexp_replace(root, '/+$', '') AS k FROM r)
SELECT page_id, path, root FROM p JOIN rn ON p.path = rn.k OR starts_with(p.path, rn.k || '/')
"""

JOBS = r"""
j AS (
  SELECT o_orderkey AS job, o_custkey AS cust, o_orderstatus AS status, o_orderdate AS ready_ts,
         CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS rc,
         o_orderkey % 50 <> 0 AS has_spec, o_orderkey % 50 <> 1 AS has_metadata,
         (o_orderstatus = 'P' AND o_custkey % 11 = 0) AS launch_error,
         'S' || CAST(o_custkey AS VARCHAR) || '_std.raw' AS src_name
  FROM orders),
arts AS (
  SELECT l_orderkey AS job, CASE l_returnflag WHEN 'R' THEN 'artifact' WHEN 'A' THEN 'log' ELSE 'other' END AS kind,
         '/srv/intake/tmp/' || CAST(l_orderkey AS VARCHAR) || '/output/part' || CAST(l_linenumber AS VARCHAR)
           || CASE l_returnflag WHEN 'R' THEN '.hdf5' WHEN 'A' THEN '.log' ELSE '.tmp' END AS path,
         l_shipdate AS mtime, CAST(round(l_extendedprice * 100) AS BIGINT) AS size
  FROM lineitem),
logs AS (
  SELECT job, path, row_number() OVER (PARTITION BY job ORDER BY mtime DESC, size DESC, path DESC) AS rn
  FROM arts WHERE kind = 'log'),
best AS (
  SELECT job, path, mtime, size,
         row_number() OVER (PARTITION BY job ORDER BY mtime DESC, size DESC, path DESC) AS rn
  FROM arts WHERE kind = 'artifact'),
agg_art AS (
  SELECT job, count(*) FILTER (WHERE kind = 'artifact') AS n_artifacts,
         bool_or(kind = 'artifact') AS has_artifact, bool_or(kind = 'log') AS has_log
  FROM arts GROUP BY job),
x AS (
  SELECT j.*, coalesce(a.has_artifact, false) AS art, coalesce(a.has_log, false) AS lg,
         CASE WHEN has_spec THEN '/srv/intake/tmp/' || CAST(job AS VARCHAR) || '/spec.json'
              WHEN job % 3 = 0 AND has_metadata THEN '/srv/intake/shared/' || CAST(job AS VARCHAR) || '.json'
         END AS spec_path
  FROM j LEFT JOIN agg_art a USING (job)),
c AS (
  SELECT *, CASE WHEN status = 'O' THEN 'pending'
                 WHEN spec_path IS NULL THEN 'missing_inputs'
                 WHEN launch_error THEN 'start_failed'
                 WHEN NOT has_metadata THEN 'bad_metadata'
                 WHEN rc = 0 AND art THEN 'delivered'
                 WHEN rc = 0 THEN 'finished_no_artifact'
                 WHEN art THEN 'failed_with_artifact'
                 WHEN lg THEN 'failed_with_log'
                 ELSE 'failed_no_log' END AS outcome
  FROM x),
tl1 AS (
  SELECT *, status <> 'O' AS launched, (has_spec OR (job % 3 = 0 AND has_metadata)) AS resolvable FROM j),
tl2 AS (
  SELECT *, CASE WHEN launched OR job % 997 = 0 THEN ready_ts + to_hours(CAST(job % 7 + 1 AS BIGINT)) END AS started_ts,
         launched AND (NOT resolvable OR launch_error) AS err
  FROM tl1),
tl3 AS (
  SELECT *, CASE WHEN launched AND NOT err THEN started_ts + to_hours(CAST(cust % 5 + 1 AS BIGINT)) END AS finished_ts,
         CASE WHEN launched AND NOT err THEN rc END AS rc2
  FROM tl2),
v AS (
  SELECT job, CASE WHEN err THEN 'error' WHEN rc2 = 0 THEN 'finish' WHEN rc2 IS NOT NULL THEN 'error'
                   WHEN started_ts IS NOT NULL THEN 'working' ELSE 'ready' END AS state,
         ready_ts, started_ts, finished_ts, CAST(rc2 AS BIGINT) AS rc,
         CAST(date_diff('second', ready_ts, started_ts) AS BIGINT) AS wait_s,
         CAST(date_diff('second', started_ts, finished_ts) AS BIGINT) AS run_s
  FROM tl3)
"""

SQL["job_outcomes"] = rf"""
WITH {JOBS}
SELECT job, outcome,
       CASE WHEN outcome = 'pending' AND job % 997 = 0 THEN '.working' WHEN outcome = 'pending' THEN '.ready' WHEN outcome IN ('missing_inputs', 'start_failed') THEN '.error'
            WHEN rc = 0 THEN '.finish' ELSE '.error' END AS marker,
       outcome = 'delivered' AS ledger_updated,
       CASE WHEN outcome NOT IN ('pending', 'missing_inputs', 'start_failed') THEN CAST(rc AS BIGINT) END AS rc, spec_path
FROM c
"""

SQL["job_timeline"] = rf"""
WITH {JOBS}
SELECT * FROM v
"""

SQL["queue_position"] = rf"""
WITH {JOBS}
SELECT job, ready_ts, CAST(row_number() OVER (ORDER BY ready_ts, job) AS BIGINT) AS position
FROM v WHERE state = 'ready'
"""

SQL["dispatch_top_k"] = rf"""
WITH {JOBS},
q AS (SELECT job, ready_ts, CAST(row_number() OVER (ORDER BY ready_ts, job) AS BIGINT) AS position
      FROM v WHERE state = 'ready')
SELECT * FROM q WHERE position <= greatest(0, 25 - (SELECT count(*) FROM v WHERE state = 'working'))
"""

SQL["status_levels"] = rf"""
WITH {JOBS},
m AS (
  SELECT CASE status WHEN 'F' THEN '[OK] ' || CAST(job AS VARCHAR) || ' -> .finish (rc=0)'
                     WHEN 'P' THEN '[ERR] ' || CAST(job AS VARCHAR) || ' -> .error (rc=1)'
                     ELSE '[RUN] ' || CAST(job AS VARCHAR) || ': PID ' || CAST(cust AS VARCHAR) END AS message
  FROM j WHERE status <> 'O' OR job % 997 = 0
  UNION ALL
  SELECT '[WARN] ' || CAST(job AS VARCHAR) || ': no usable description, nothing delivered'
  FROM j WHERE status <> 'O' AND NOT has_metadata
  UNION ALL SELECT '[WARN] Lost the lock of ' || CAST(job AS VARCHAR) FROM j WHERE job % 37 = 0
  UNION ALL SELECT '[ERR] Cleanup after ' || CAST(job AS VARCHAR) || ' gave up: disk full' FROM j WHERE job % 41 = 0),
w AS (SELECT message, substr(message, 2, strpos(message, ']') - 2) AS level,
             string_split(substr(message, strpos(message, ']') + 2), ' ') AS words FROM m)
SELECT level, CASE WHEN len(words) > 1 AND ends_with(words[1], ':') THEN rtrim(words[1], ':')
                   WHEN words[2] = '->' THEN words[1] END AS job_ref, message
FROM w
"""

SQL["definition_errors"] = r"""
WITH d AS (
  SELECT s_suppkey AS watch_idx, '/in/' || s_name AS input,
         CASE WHEN s_nationkey <> 0 THEN '/out/n' || CAST(s_nationkey AS VARCHAR) END AS output,
         CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE '*n' || CAST(s_nationkey AS VARCHAR) || 'std.raw' END AS pattern,
         CAST(trunc(s_acctbal) AS INTEGER) AS interval_minutes
  FROM supplier),
e AS (
  SELECT *, list_filter([CASE WHEN input IS NULL OR input = '' THEN 'missing_input' END,
                         CASE WHEN output IS NULL OR output = '' THEN 'missing_output' END,
                         CASE WHEN interval_minutes IS NULL THEN 'interval_not_integer' END,
                         CASE WHEN interval_minutes < 0 THEN 'negative_interval' END],
                        lambda x: x IS NOT NULL) AS errs
  FROM d)
SELECT watch_idx, input, output, coalesce(nullif(pattern, ''), '*std.raw') AS pattern,
       CAST(interval_minutes AS BIGINT) * 60 AS interval_s,
       greatest(1, CAST(interval_minutes AS BIGINT) * 60) AS trigger_s,
       array_to_string(errs, ',') AS errors, len(errs) = 0 AS is_valid
FROM e
"""

SQL["newest_reference"] = r"""
WITH r AS (SELECT p_brand AS grp, p_name AS name, CAST(DATE '2024-01-01' + p_size AS TIMESTAMP) AS mtime,
                  p_partkey AS size FROM part)
SELECT grp, name, mtime, size FROM (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY mtime DESC, size DESC, lower(name) DESC, name DESC) AS rn
  FROM r) WHERE rn = 1
"""

SQL["best_artifact"] = rf"""
WITH {JOBS}
SELECT g.job, b.path AS artifact, b.mtime AS artifact_mtime, b.size AS artifact_size,
       l.path AS log, g.n_artifacts, g.has_artifact, g.has_log
FROM agg_art g LEFT JOIN best b ON b.job = g.job AND b.rn = 1 LEFT JOIN logs l ON l.job = g.job AND l.rn = 1
"""

SQL["delivery_manifest"] = rf"""
WITH {JOBS},
d AS (
  SELECT c.job, c.src_name, CASE WHEN outcome = 'delivered' THEN b.path ELSE l.path END AS artifact, v.finished_ts,
         CASE WHEN outcome = 'delivered' THEN '.hdf5' ELSE '.error.log' END AS suffix,
         '/srv/intake/out/c' || CAST(c.cust % 10 AS VARCHAR) AS final_root
  FROM c JOIN v ON v.job = c.job LEFT JOIN best b ON b.job = c.job AND b.rn = 1 LEFT JOIN logs l ON l.job = c.job AND l.rn = 1
  WHERE c.outcome IN ('delivered', 'failed_with_log')),
t AS (
  SELECT *, final_root || '/' ||
            coalesce(CASE WHEN coalesce(src_name, '') <> '' THEN regexp_replace(src_name, '^(.+)\.[^.]+$', '\1') END,
                     CAST(job AS VARCHAR)) || suffix AS target
  FROM d)
SELECT target, job, artifact, finished_ts, n_writers FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY finished_ts DESC, job DESC) AS rn,
         count(*) OVER (PARTITION BY target) AS n_writers
  FROM t) WHERE rn = 1
"""

SQL["delivery_ledger"] = rf"""
WITH {JOBS}
SELECT DISTINCT src_name AS name FROM c
WHERE outcome = 'delivered' AND src_name NOT IN (SELECT src_name FROM j WHERE job % 9 = 0)
"""

SQL["scan_events"] = f"""
WITH {SCAN_LOG},
per AS (SELECT watch, scan_no, count(*) AS n FROM counted WHERE cnt >= 2 GROUP BY watch, scan_no)
SELECT s.watch, CAST(s.scan_day AS TIMESTAMP) AS scan_ts, CASE WHEN p.n > 0 THEN 'snapshot' ELSE 'empty' END AS kind,
       CAST(s.scan_no AS BIGINT) AS scan_no, CAST(coalesce(p.n, 0) AS BIGINT) AS n_candidates, CAST(NULL AS VARCHAR) AS message
FROM scans s LEFT JOIN per p ON p.watch = s.watch AND p.scan_no = s.scan_no
UNION ALL
SELECT watch, CAST(scan_day AS TIMESTAMP) + INTERVAL 12 HOUR, 'error', NULL, 0, 'folder not reachable'
FROM scans WHERE day(scan_day) % 5 = 0
"""

REFS = r"""
ref AS (SELECT p_brand AS grp, p_name AS name, CAST(DATE '2024-01-01' + p_size AS TIMESTAMP) AS mtime,
               p_partkey AS size FROM part),
top AS (SELECT grp, name FROM (
          SELECT *, row_number() OVER (PARTITION BY grp ORDER BY mtime DESC, size DESC, lower(name) DESC, name DESC)
                 AS rn FROM ref) WHERE rn = 1),
fa AS (SELECT '/srv/intake/config/fasta/' || name || '.fasta' AS f FROM top WHERE grp = 'Brand#1'),
sp AS (SELECT '/srv/intake/config/spike/' || name || '.csv' AS f FROM top WHERE grp = 'Brand#2')
"""

SQL["job_spec"] = rf"""
WITH {REFS}
SELECT o_orderkey AS job,
       '/srv/intake/tmp/' || CAST(o_orderkey AS VARCHAR) || '/input' AS main_input_folder,
       '/srv/intake/tmp/' || CAST(o_orderkey AS VARCHAR) || '/output' AS main_outdir,
       coalesce((SELECT f FROM fa), '%%%FASTA%%%') AS main_fasta_file,
       (SELECT f FROM sp) AS main_spike_file,
       coalesce((SELECT f FROM sp), '%%%SPIKE%%%%') AS spike_table,
       'see %%%FASTA%%% in the manual' AS hint,
       'nested, left alone' AS nested_fasta,
       'a|' || coalesce((SELECT f FROM sp), '%%%SPIKE%%%%') || '|' || coalesce((SELECT f FROM fa), '%%%FASTA%%%%') AS tags,
       CAST(3 AS BIGINT) AS attempts
FROM orders
"""

SQL["job_templates"] = rf"""
WITH {REFS},
o AS (SELECT o_orderkey AS job, o_orderpriority AS p, o_totalprice AS t, o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 AS odd,
             (SELECT f FROM fa) AS fa, (SELECT f FROM sp) AS sp FROM orders)
SELECT job, odd AS unchanged,
       CASE WHEN NOT odd THEN fa END AS main_fasta_file, CASE WHEN NOT odd THEN sp END AS main_spike_file,
       CASE WHEN NOT odd THEN job END AS own_job,
       CASE WHEN NOT odd THEN array_to_string(list_transform(range(0, job % 4 + 1), lambda i:
            CASE WHEN i % 2 = 0 THEN fa ELSE CAST(job AS VARCHAR) || '-' || CAST(i AS VARCHAR) END), '|') END AS list,
       CASE WHEN NOT odd THEN sp END AS spike, CASE WHEN NOT odd THEN 'say "%%%FASTA%%%" for ' || p END AS note,
       CASE WHEN NOT odd THEN t END AS size,
       CASE WHEN NOT odd THEN '{{"%%%FASTA%%%":' || CAST(job % 5 AS VARCHAR) || '}}' END AS keys
FROM o
"""

SQL["job_metadata"] = rf"""
WITH {REFS},
s AS (SELECT o_orderkey AS job, o_custkey AS cust, o_orderstatus AS status, o_orderdate AS ready_ts,
             'S' || CAST(o_custkey AS VARCHAR) || '_std.raw' AS src_name,
             CAST(round(o_totalprice * 100) AS BIGINT) AS size FROM orders),
h AS (SELECT *, sha1('/data/in/' || src_name || CAST(size AS VARCHAR)) AS hash FROM s),
ex AS (SELECT DISTINCT hash FROM h WHERE status = 'F'),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY job) AS rn FROM h)
      WHERE rn = 1 AND hash NOT IN (SELECT hash FROM ex))
SELECT hash, job, strftime(ready_ts, '%Y-%m-%dT%H:%M:%S') AS created_at, src_name AS source_name,
       size AS size_bytes, job % 4 <> 0 AS has_watch,
       CASE WHEN job % 4 <> 0 THEN '/srv/intake/out/c' || CAST(cust % 10 AS VARCHAR) END AS final_root,
       (SELECT f FROM fa) AS fasta_file,
       CAST(CASE WHEN job % 4 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS n_ignore_files,
       CASE WHEN job % 4 <> 0 THEN '/srv/intake/out/c' || CAST(cust % 10 AS VARCHAR) || '/ignore.txt' END
         AS ledger_file
FROM f
"""

SQL["unique_target_names"] = r"""
WITH req AS (SELECT p_name AS base, p_partkey AS req_id,
                    row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS i FROM part),
ex AS (SELECT DISTINCT name FROM (
         SELECT p_name || '-' || CAST(p_size AS VARCHAR) AS name FROM part WHERE p_size % 10 = 3
         UNION ALL SELECT p_name FROM part WHERE p_size = 50
         UNION ALL SELECT p_name || '-20240101-000000' FROM part WHERE p_size = 49)),
b AS (SELECT base, count(*) AS n, bool_or(base IN (SELECT name FROM ex)) AS b_taken,
             bool_or((base || '-20240101-000000') IN (SELECT name FROM ex)) AS s_taken
      FROM req GROUP BY base),
nums AS (SELECT b.base, t.k FROM b, range(2, 2 * b.n + 3) AS t(k)),
free AS (SELECT base, k, row_number() OVER (PARTITION BY base ORDER BY k) AS r FROM nums
         WHERE (base || '-' || CAST(k AS VARCHAR)) NOT IN (SELECT name FROM ex)),
ft AS (SELECT base, b_taken,
              (CASE WHEN NOT b_taken THEN 1 ELSE 0 END) + (CASE WHEN NOT s_taken THEN 1 ELSE 0 END) AS ft FROM b)
SELECT r.req_id, r.base,
       CASE WHEN r.i - ft.ft > 0 THEN r.base || '-' || CAST(f.k AS VARCHAR)
            WHEN r.i = 1 AND NOT ft.b_taken THEN r.base
            ELSE r.base || '-20240101-000000' END AS name
FROM req r JOIN ft ON ft.base = r.base LEFT JOIN free f ON f.base = r.base AND f.r = r.i - ft.ft
"""

SQL["stream_scans"] = f"""
WITH {SCAN_LOG},
attempts AS (
  SELECT watch, scan_day, CAST(scan_day AS TIMESTAMP) AS scan_ts, 'ok' AS status, NULL AS message FROM scans
  UNION ALL
  SELECT watch, scan_day, CAST(scan_day AS TIMESTAMP) + INTERVAL 12 HOUR, 'error', 'folder not reachable'
  FROM scans WHERE day(scan_day) % 5 = 0
  UNION ALL
  SELECT watch, max(scan_day) + 1, CAST(max(scan_day) + 1 AS TIMESTAMP), 'ok', NULL FROM scans GROUP BY watch),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY watch ORDER BY scan_ts) AS attempt,
         CASE WHEN status = 'ok' THEN count(*) FILTER (WHERE status = 'ok') OVER (PARTITION BY watch ORDER BY scan_ts) END AS scan_no
  FROM attempts),
per AS (SELECT watch, scan_no, count(*) AS n_files, count(*) FILTER (WHERE cnt >= 2) AS n_candidates, sum(cnt) AS n_counts
        FROM counted GROUP BY 1, 2),
landed AS (SELECT watch, (SELECT count(*) FROM log l WHERE l.watch = n.watch) + count(*) AS n_landed FROM numbered n GROUP BY watch)
SELECT n.watch, CAST(n.attempt AS BIGINT) AS attempt, n.scan_ts,
       CASE WHEN n.status <> 'ok' THEN 'error' WHEN p.n_candidates > 0 THEN 'snapshot' ELSE 'empty' END AS kind,
       CAST(n.scan_no AS BIGINT) AS scan_no, CAST(coalesce(p.n_files, 0) AS BIGINT) AS n_files,
       CAST(coalesce(p.n_candidates, 0) AS BIGINT) AS n_candidates, CAST(coalesce(p.n_counts, 0) AS BIGINT) AS n_counts,
       n.message, n_landed
FROM numbered n LEFT JOIN per p ON p.watch = n.watch AND p.scan_no = n.scan_no JOIN landed l ON l.watch = n.watch
"""

SQL["stream_intake"] = rf"""
WITH {CONTENT_CANDIDATES},
f AS (SELECT *, sha1(name || CAST(size AS VARCHAR)) AS hash FROM c
      QUALIFY row_number() OVER (PARTITION BY name, size ORDER BY doc_id % 3, watch_idx, doc_id) = 1)
SELECT name, size, watch, doc_id, hash, '/srv/intake/tmp/' || hash || '/input' AS input_folder,
       '/data/in/' || watch || '/' || name AS source_path, CAST(doc_id % 3 AS BIGINT) AS batch_id
FROM f
"""

SQL["stream_rollup"] = r"""
SELECT 'run' || CAST(l_orderkey AS VARCHAR) || '.d' AS dir,
       CAST(sum(CAST(trunc(l_quantity) AS BIGINT) + CASE WHEN l_partkey % 3 = 0 THEN 3 ELSE 0 END) AS BIGINT) AS size,
       count(DISTINCT l_linenumber) AS n_files
FROM lineitem WHERE (l_orderkey + l_linenumber + 3) % 5 <> 0 GROUP BY l_orderkey
"""

SQL["stream_dedup"] = r"""
SELECT DISTINCT md5(text) || '.raw' AS name, n_chars AS size FROM documents
"""
