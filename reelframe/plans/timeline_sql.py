"""DuckDB SQL for the queries of timeline_queries."""

from __future__ import annotations

_W = "w AS (SELECT DISTINCT episode, word_ord, text, start_time, end_time FROM word WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL)"
_C = "c AS (SELECT DISTINCT episode, cue_ord, text, start_time, end_time FROM cue WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL)"
_CL = "cl AS (SELECT episode, clip_ord, max(file) AS file, coalesce(max(duration_s), 0.0) AS duration_s FROM clip GROUP BY ALL)"
_WO, _CO = "word_ord, start_time, end_time, text", "cue_ord, start_time, end_time, text"
_OVER = f"OVER (PARTITION BY episode ORDER BY {_CO})"
_FR = """f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, value AS brightness, event_type = 'error' AS has_text FROM events WHERE value IS NOT NULL)"""
_ONE = "one AS (SELECT episode, cue_ord, max({'start_time': start_time, 'end_time': end_time, 'text': text}) AS c FROM c GROUP BY ALL), u AS (SELECT episode, cue_ord, c.start_time AS start_time, c.end_time AS end_time, c.text AS text FROM one)"
_SC = "sc AS (SELECT episode, line_ord, max({'speaker': speaker, 'line': line, 'raw': raw}) AS v FROM script_line GROUP BY ALL), s AS (SELECT episode, line_ord, v.speaker AS speaker, v.line AS line FROM sc)"
_HAN = r"'[^\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]'"
_T = """t AS (SELECT *, CASE WHEN row_number() OVER o = 1 THEN 0 WHEN lag(clip_ord % 3 = 1) OVER o THEN 10 ELSE 1 END AS trim_frames, clip_ord % 3 = 1 AS has_fade_after FROM cl WINDOW o AS (PARTITION BY episode ORDER BY clip_ord)),
 e AS (SELECT *, duration_s - trim_frames * (1 / 30.0::DOUBLE) AS eff FROM t),
 tl AS (SELECT *, coalesce(sum(eff) OVER (PARTITION BY episode ORDER BY clip_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_s FROM e)"""
_SCENE = r"""l AS (SELECT doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) AS text, generate_subscripts(string_split_regex(text, '\r\n|\r|\n'), 1) - 1 AS line_no FROM documents WHERE source = 'screenplay' AND text IS NOT NULL),
 m AS (SELECT *, trim(text, ' ' || chr(9) || chr(12288) || chr(10) || chr(13)) AS t FROM l), k AS (SELECT *, sum(CAST(regexp_matches(t, '^\d+-\d+$') AS INT)) OVER (PARTITION BY doc_id ORDER BY line_no) AS scene_ord FROM m),
 sc AS (SELECT doc_id, scene_ord, arg_min(t, line_no) AS scene_id, coalesce(arg_min(regexp_extract(t, '^地点\s*(\S+)', 1), line_no) FILTER (WHERE regexp_extract(t, '^地点\s*(\S+)', 1) <> ''), '') AS location, count(*) AS line_count
 FROM k WHERE scene_ord > 0 GROUP BY ALL)"""
_ENS = "WITH e AS (SELECT label, vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos, (vec_id % 3 + 1)::DOUBLE AS w FROM embeddings) SELECT label, CAST(pos AS INTEGER) AS pos, round({}, 6) AS v FROM e GROUP BY ALL"
_GROUPS = f"""unc AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.episode = w.episode AND c.end_time + 0.5 >= c.start_time AND (w.start_time + w.end_time) / 2 BETWEEN c.start_time AND c.end_time + 0.5)),
 o AS (SELECT *, CASE WHEN lag(end_time) OVER x IS NULL OR start_time - lag(end_time) OVER x >= 0.5 THEN 1 ELSE 0 END AS op FROM unc WINDOW x AS (PARTITION BY episode ORDER BY {_WO})),
 g AS (SELECT *, sum(op) OVER (PARTITION BY episode ORDER BY {_WO} ROWS UNBOUNDED PRECEDING) AS g FROM o),
 grp AS (SELECT episode, regexp_replace(string_agg(text, '' ORDER BY {_WO}), {_HAN}, '', 'g') AS text, arg_min(start_time, row({_WO})) AS start_time, arg_max(end_time, row({_WO})) AS end_time FROM g GROUP BY episode, g)"""
_METRIC = "m AS (SELECT l_returnflag AS metric, l_linestatus AS instrument, l_extendedprice AS value FROM lineitem), a AS (SELECT metric, instrument, avg(value) AS mean, stddev_pop(value) AS std FROM (SELECT metric, instrument FROM (SELECT DISTINCT metric FROM m), (VALUES ('O'), ('F')) v(instrument)) i LEFT JOIN m USING (metric, instrument) GROUP BY ALL), n AS (SELECT metric, instrument, coalesce(mean, 'nan'::DOUBLE) AS mean, coalesce(std, 'nan'::DOUBLE) AS std FROM a)"  # noqa: E501

SQL = {
    "pause_annotation": f"""WITH {_W}, g AS (SELECT *, lead(start_time) OVER (PARTITION BY episode ORDER BY {_WO}) - end_time AS gap FROM w)
        SELECT episode, string_agg(text || CASE WHEN gap >= 0.3 THEN '[' || CAST(floor((round(gap * 1000) + 50) / 100) AS BIGINT) // 10 || '.' || CAST(floor((round(gap * 1000) + 50) / 100) AS BIGINT) % 10 || 's]' ELSE '' END, '' ORDER BY {_WO}) AS sequence FROM g GROUP BY episode""",
    "gap_sessions": f"""WITH {_W}, o AS (SELECT *, CASE WHEN lag(end_time) OVER x IS NULL OR start_time - lag(end_time) OVER x >= 0.5 THEN 1 ELSE 0 END AS op FROM w WINDOW x AS (PARTITION BY episode ORDER BY {_WO})),
        g AS (SELECT *, sum(op) OVER (PARTITION BY episode ORDER BY {_WO} ROWS UNBOUNDED PRECEDING) AS session FROM o)
        SELECT episode, CAST(session AS BIGINT) AS session, count(*) AS n, min(start_time) AS start_time, max(end_time) AS end_time FROM g GROUP BY ALL""",
    "user_sessions": """WITH e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t FROM events), o AS (SELECT *, CASE WHEN lag(t) OVER x IS NULL OR t - lag(t) OVER x >= 3600 THEN 1 ELSE 0 END AS op FROM e WINDOW x AS (PARTITION BY user_id ORDER BY t, event_id)),
        g AS (SELECT *, sum(op) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS session FROM o) SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(t) AS first, max(t) AS last FROM g GROUP BY ALL""",
    "size_gap_sessions": f"""WITH RECURSIVE {_W}, n AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY {_WO}) AS i, lag(end_time) OVER (PARTITION BY episode ORDER BY {_WO}) AS pe FROM w),
        r AS (SELECT episode, i, 1 AS g, length(text) AS chars, start_time AS gs FROM n WHERE i = 1 UNION ALL
          SELECT n.episode, n.i, CASE WHEN b THEN g + 1 ELSE g END, CASE WHEN b THEN length(text) ELSE chars + length(text) END, CASE WHEN b THEN start_time ELSE gs END
          FROM (SELECT n.*, r.g, r.chars, r.gs, n.start_time - n.pe > 0.4 OR r.chars >= 15 OR n.pe - r.gs > 5.0 AS b FROM r JOIN n ON n.episode = r.episode AND n.i = r.i + 1) n),
        k AS (SELECT n.episode, g, string_agg(text, '' ORDER BY n.i) AS text, arg_min(start_time, n.i) AS s, arg_max(end_time, n.i) AS e FROM n JOIN r ON r.episode = n.episode AND r.i = n.i GROUP BY ALL)
        SELECT episode, text, round(s, 6) AS start_time, round(CASE WHEN e - s < 0.3 THEN s + 0.3 ELSE e END, 6) AS end_time FROM k QUALIFY NOT (text = '' AND g = max(g) OVER (PARTITION BY episode))""",
    "overlap_truncate": f"WITH {_C}, n AS (SELECT *, lead(start_time) {_OVER} AS nx FROM c) SELECT episode, cue_ord, text, start_time, round(CASE WHEN end_time > nx THEN greatest(start_time + 0.3, nx - 0.05) ELSE end_time END, 6) AS end_time FROM n",
    "overlap_resolve": f"""WITH {_C}, n AS (SELECT *, lead(start_time) {_OVER} AS nx FROM c),
        e AS (SELECT *, CASE WHEN start_time >= nx THEN nx - 0.05 WHEN end_time > nx THEN greatest(start_time + 0.1, nx - 0.05) ELSE end_time END AS e FROM n)
        SELECT episode, cue_ord, text, start_time, round(e, 6) AS end_time FROM e WHERE NOT (coalesce(start_time >= nx, false) AND e <= start_time)""",
    "clip_timeline": f"WITH {_CL}, {_T} SELECT episode, clip_ord, trim_frames, has_fade_after, round(round_even(start_s, 6), 4) AS start_s, round(round_even(eff, 6), 4) AS effective_s FROM tl",
    "junction_times": f"WITH {_CL}, j AS (SELECT episode, clip_ord, sum(duration_s) OVER o AS t, lead(1) OVER (PARTITION BY episode ORDER BY clip_ord) AS nx FROM cl WINDOW o AS (PARTITION BY episode ORDER BY clip_ord ROWS UNBOUNDED PRECEDING)) SELECT episode, clip_ord, round(t, 4) AS time_s FROM j WHERE nx = 1",
    "file_offsets": f"""WITH {_CL}, s AS (SELECT *, CASE WHEN clip_ord % 4 <> 2 THEN duration_s - CASE WHEN row_number() OVER (PARTITION BY episode ORDER BY clip_ord) < count(*) OVER (PARTITION BY episode) THEN 0.6::DOUBLE ELSE 0 END ELSE 0 END AS st FROM cl)
        SELECT episode, clip_ord, round(coalesce(sum(st) OVER (PARTITION BY episode ORDER BY clip_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 4) AS offset_s FROM s""",
    "leading_run": f"WITH {_FR}, b AS (SELECT user_id, min(frame_idx) FILTER (WHERE brightness >= 100) AS c FROM f GROUP BY 1) SELECT f.user_id, count(*) FILTER (WHERE c IS NULL OR frame_idx < c) AS n FROM f JOIN b USING (user_id) GROUP BY 1",
    "trailing_run": f"WITH {_FR}, b AS (SELECT user_id, max(frame_idx) FILTER (WHERE brightness >= 100) AS last_bright, max(frame_idx) AS m FROM f GROUP BY 1) SELECT user_id, CAST(last_bright AS INTEGER) AS last_bright, m - last_bright AS n FROM b WHERE last_bright IS NOT NULL AND m > last_bright",
    "stable_run_start": f"""WITH {_FR}, r AS (SELECT user_id, frame_idx, frame_idx - row_number() OVER (PARTITION BY user_id ORDER BY frame_idx) AS g FROM f WHERE brightness >= 20),
        k AS (SELECT user_id, min(frame_idx) AS first FROM r GROUP BY user_id, g HAVING count(*) >= 3) SELECT user_id, CAST(min(first) AS INTEGER) AS first FROM k GROUP BY 1""",
    "consecutive_dedup": "WITH p AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) SELECT user_id, event_id, event_type FROM p WHERE p IS DISTINCT FROM event_type OR event_type IS NULL",
    "split_points": f"""WITH {_CL}, p AS (SELECT *, CASE WHEN clip_ord % 7 = 6 THEN -1.0 ELSE clip_ord * 5.0 END AS pct FROM cl)
        SELECT episode, clip_ord, round(CASE WHEN min(pct) OVER (PARTITION BY episode) >= 0 THEN pct ELSE 100.0 / count(*) OVER (PARTITION BY episode) * (row_number() OVER (PARTITION BY episode ORDER BY clip_ord) - 1) END::DOUBLE, 6) AS start_s FROM p""",
    "music_segments": f"""WITH {_CL}, n AS (SELECT *, (clip_ord * 6)::DOUBLE AS s, lead((clip_ord * 6)::DOUBLE) OVER o AS nx, row_number() OVER o = 1 AS first FROM cl WINDOW o AS (PARTITION BY episode ORDER BY clip_ord)),
        a AS (SELECT *, greatest(0, s - CASE WHEN first THEN 0 ELSE 1 END) AS st, CASE WHEN nx IS NULL THEN 90 ELSE least(90, nx + 1) END AS e FROM n)
        SELECT episode, clip_ord, round(st, 6)::DOUBLE AS actual_start, round(CASE WHEN nx IS NOT NULL AND duration_s > 0 THEN least(e - st, duration_s) ELSE e - st END, 6)::DOUBLE AS length,
        CASE WHEN first THEN 0 ELSE 2000000 END AS fade_in_us, CASE WHEN nx IS NULL THEN 2000000 ELSE 2000000 END AS fade_out_us FROM a WHERE e - st > 0""",
    "speaker_boundaries": rf"""WITH {_SC}, p AS (SELECT *, lag(speaker) OVER o AS ps, lag(line) OVER o AS pl, row_number() OVER o AS rn FROM s WINDOW o AS (PARTITION BY episode ORDER BY line_ord))
        SELECT episode, line_ord, ps AS prev_speaker, speaker, regexp_replace(right(pl, 4), '[^\x{{4e00}}-\x{{9fff}}]', '', 'g') AS tail, regexp_replace(left(line, 4), '[^\x{{4e00}}-\x{{9fff}}]', '', 'g') AS head FROM p WHERE rn > 1 AND ps IS DISTINCT FROM speaker""",
    "scene_changes": f"WITH {_CL}, {_T}, n AS (SELECT *, lead(round_even(start_s, 6)) OVER (PARTITION BY episode ORDER BY clip_ord) AS ch FROM tl) SELECT episode, clip_ord, round(ch, 4) AS change_s FROM n WHERE has_fade_after AND ch IS NOT NULL",
    "last_row_extend": f"""WITH {_C}, k AS (SELECT episode, cue_ord, text, start_time, least(end_time, start_time + 0.4) AS e FROM c), n AS (SELECT *, lead(1) OVER (PARTITION BY episode ORDER BY cue_ord, start_time, e, text) AS nx FROM k)
        SELECT episode, cue_ord, text, start_time, round(CASE WHEN nx IS NULL AND e - start_time < 0.5 THEN greatest(start_time + 0.5, 120.0) ELSE e END, 6) AS end_time FROM n""",
    "scene_lines": f"WITH {_SCENE} SELECT doc_id, CAST(scene_ord AS BIGINT) AS scene_ord, scene_id, location, line_count FROM sc",
    "expected_scene_times": f"""WITH {_SCENE}, e AS (SELECT *, sum(line_count) OVER (PARTITION BY doc_id ORDER BY scene_ord) / sum(line_count) OVER (PARTITION BY doc_id) * 90.0 AS x, lead(1) OVER (PARTITION BY doc_id ORDER BY scene_ord) AS nx FROM sc)
        SELECT doc_id, CAST(scene_ord AS BIGINT) AS scene_ord, round(x::DOUBLE, 6) AS expected_s FROM e WHERE nx = 1""",
    "running_best": "WITH b AS (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM events) SELECT event_id, coalesce(value > m, value IS NOT NULL) AS improved FROM b",
    "list_chunks": "SELECT event_id, CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 3.0) AS INTEGER) AS chunk FROM events",
    "order_regression": """WITH t AS (SELECT user_id, event_id, ts, CASE WHEN value > 1 THEN CAST(floor(value) AS BIGINT) END AS li FROM events),
        n AS (SELECT *, last_value(li IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p, first_value(li IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n FROM t)
        SELECT event_id, li FROM n WHERE li > n + 5 AND (p IS NULL OR li > p + 5)""",
    "interval_anti": f"WITH {_W}, {_C} SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.episode = w.episode AND c.end_time + 0.5 >= c.start_time AND (w.start_time + w.end_time) / 2 BETWEEN c.start_time AND c.end_time + 0.5)",
    "salvaged_groups": f"""WITH {_W}, {_C}, {_GROUPS} SELECT grp.episode, grp.text, grp.start_time, grp.end_time, round(min(least(abs(c.end_time - grp.start_time), abs(grp.end_time - c.start_time))), 6) AS nearest_gap
        FROM (SELECT DISTINCT * FROM grp) grp JOIN c USING (episode) WHERE length(grp.text) >= 2 GROUP BY ALL HAVING min(least(abs(c.end_time - grp.start_time), abs(grp.end_time - c.start_time))) <= 8""",
    "words_in_cues": f"WITH {_W}, {_C} SELECT w.episode, cue_ord, count(*) AS n FROM w JOIN c ON w.episode = c.episode AND c.end_time + 0.1 >= c.start_time - 0.1 AND w.start_time BETWEEN c.start_time - 0.1 AND c.end_time + 0.1 AND w.end_time <= c.end_time + 0.1 GROUP BY ALL",
    "max_gap_split": f"""WITH {_C}, {_ONE}, w0 AS (SELECT episode, word_ord, max({{'start_time': start_time, 'end_time': end_time, 'text': text}}) AS w FROM word WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL GROUP BY ALL),
        w AS (SELECT episode, word_ord, w.start_time AS s, w.end_time AS e, w.text AS t FROM w0), lg AS (SELECT * FROM u WHERE end_time - start_time > 2.5),
        i AS (SELECT u.episode, u.cue_ord, word_ord, s, e, sum(length(t)) OVER o AS n, lead(s) OVER (PARTITION BY u.episode, u.cue_ord ORDER BY word_ord) AS nx FROM lg u JOIN w ON w.episode = u.episode AND s >= u.start_time - 0.1 AND s <= u.end_time + 0.1 AND e <= u.end_time + 0.1 WINDOW o AS (PARTITION BY u.episode, u.cue_ord ORDER BY word_ord)),
        b AS (SELECT episode, cue_ord, arg_max({{'n': n, 'a': e, 'b': nx}}, row(nx - e, -word_ord)) AS k FROM i WHERE nx - e >= 0.2 GROUP BY ALL),
        r AS (SELECT u.*, k, trim(left(text, k.n::BIGINT), ' ') AS l, trim(substr(text, k.n::BIGINT + 1), ' ') AS rr FROM u LEFT JOIN b USING (episode, cue_ord)), z AS (SELECT *, k IS NOT NULL AND end_time - start_time > 2.5 AND l <> '' AND rr <> '' AS cut FROM r)
        SELECT episode, cue_ord, 0 AS part, CASE WHEN cut THEN l ELSE text END AS text, start_time, CASE WHEN cut THEN k.a ELSE end_time END AS end_time FROM z UNION ALL SELECT episode, cue_ord, 1, rr, k.b, end_time FROM z WHERE cut""",
    "hard_subtitles": f"""WITH {_C}, {_ONE}, {_SC}, hd AS (SELECT episode, cue_ord AS o, start_time AS s, end_time AS e FROM u WHERE text LIKE '（%'), q AS (SELECT *, regexp_replace(text, {_HAN}, '', 'g') AS h FROM u WHERE text NOT LIKE '（%'),
        k AS (SELECT q.*, EXISTS (SELECT 1 FROM s WHERE s.episode = q.episode AND regexp_replace(s.line, {_HAN}, '', 'g') = q.h AND q.h <> '') AS known FROM q),
        x AS (SELECT k.episode, k.cue_ord, arg_min(NOT (k.start_time < hd.s + 0.5 AND length(h) >= 4 AND known), hd.o) AS go FROM k JOIN hd ON hd.episode = k.episode AND hd.e >= hd.s - 0.1 AND k.start_time BETWEEN hd.s - 0.1 AND hd.e GROUP BY ALL)
        SELECT episode, cue_ord FROM k WHERE (episode, cue_ord) NOT IN (SELECT (episode, cue_ord) FROM x WHERE go)""",
    "nearest_event": """WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t FROM events), r AS (SELECT a.user_id, a.event_id AS signup, a.t AS signup_us, b.event_id AS purchase, b.t AS purchase_us,
        row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.t - b.t), b.t, b.event_id) AS rn FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND b.event_type = 'purchase' WHERE a.event_type = 'signup')
        SELECT user_id, signup, signup_us, purchase, purchase_us, abs(signup_us - purchase_us) AS distance FROM r WHERE rn = 1""",
    "incremental_scan": "SELECT c_custkey, max(o_totalprice) AS length, count(o_custkey) > 0 AS known FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1",
    "priority_lookup": """SELECT n_nationkey AS k, coalesce((SELECT min(s_name) FROM supplier WHERE s_nationkey = n_nationkey AND s_nationkey % 3 <> 0), (SELECT min(c_name) FROM customer WHERE c_nationkey = n_nationkey)) AS v FROM nation""",
    "first_by_extension": r"""WITH t AS (SELECT folder, file, list_position(['flac', 'mp3', 'wav', 'm4a'], regexp_extract(file, '\.(\w+)$', 1)) AS r FROM music_tag WHERE folder IS NOT NULL)
        SELECT folder, arg_min(file, row(r, file)) AS file FROM t WHERE r > 0 GROUP BY 1""",
    "char_overlap_match": """WITH t AS (SELECT DISTINCT lower(c_mktsegment) AS title FROM customer), n AS (SELECT DISTINCT lower(p_type) AS name FROM part),
        s AS (SELECT title, name, len(list_filter(string_split(title, ''), lambda c: contains(name, c))) AS shared FROM t, n), r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY shared DESC, name) AS rn FROM s WHERE shared * 2 >= length(title))
        SELECT title, name, shared FROM r WHERE rn = 1""",
    "project_directories": r"""WITH p AS (SELECT DISTINCT substr(p_type, 1, 4) AS project FROM part), n AS (SELECT DISTINCT p_type || '_x' AS name FROM part)
        SELECT project, name FROM p, n WHERE contains(name, project) OR (regexp_replace(name, '[^\p{L}\p{N}]', '', 'g') = regexp_replace(project, '[^\p{L}\p{N}]', '', 'g'))""",
    "positional_zip": f"""WITH {_CL}, {_SC}, x AS (SELECT episode, clip_ord AS a, row_number() OVER (PARTITION BY episode ORDER BY clip_ord) AS p FROM cl), y AS (SELECT episode, line_ord AS b, row_number() OVER (PARTITION BY episode ORDER BY line_ord) AS p FROM s)
        SELECT episode, CAST(p AS INTEGER) AS position, a, b FROM x JOIN y USING (episode, p)""",
    "position_gate": f"""WITH {_C}, {_SC}, u AS (SELECT episode, cue_ord, max(text) AS text FROM c GROUP BY ALL), q AS (SELECT episode, cue_ord AS cue_id, least(1.0, cue_ord / count(*) OVER (PARTITION BY episode)) AS cp, text FROM u),
        l AS (SELECT episode, least(1.0, line_ord / count(*) OVER (PARTITION BY episode)) AS lp, line FROM s), pr(wrong, rgt) AS (VALUES ('掉了', '那把断琴'), ('早就', '我不后悔'), ('药方', '账本')),
        g AS (SELECT q.episode, cue_id, wrong, rgt, min(abs(cp - lp)) FILTER (WHERE contains(line, rgt)) AS r FROM q JOIN pr ON contains(text, wrong) LEFT JOIN l ON l.episode = q.episode GROUP BY ALL)
        SELECT episode, cue_id, wrong, rgt AS right FROM g WHERE r IS NULL OR r <= 0.35""",
    "colour_distance": """WITH c AS (SELECT p_partkey, p_brand, CASE WHEN p_size <> 7 THEN p_partkey * 37 % 256 END AS r, CASE WHEN p_size <> 7 THEN p_size * 5 % 256 END AS g, CASE WHEN p_size <> 7 THEN CAST(floor(p_retailprice) AS BIGINT) % 256 END AS b FROM part),
        n AS (SELECT *, lead(r) OVER o AS r2, lead(g) OVER o AS g2, lead(b) OVER o AS b2 FROM c WINDOW o AS (PARTITION BY p_brand ORDER BY p_partkey)) SELECT p_partkey, round(coalesce(sqrt(pow(r - r2, 2) + pow(g - g2, 2) + pow(b - b2, 2)), 0), 6) AS dist FROM n""",
    "mean_colours": "SELECT p_brand, CAST(trunc(avg(p_partkey * 37 % 256)) AS INTEGER) AS r, CAST(trunc(avg(p_size * 5 % 256)) AS INTEGER) AS g, CAST(trunc(avg(CAST(floor(p_retailprice) AS BIGINT) % 256)) AS INTEGER) AS b FROM part GROUP BY 1",
    "cue_statistics": f"WITH {_C} SELECT episode, count(*) AS cues, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg(length(text)), 6) AS avg_chars, max(end_time) AS last_end FROM c GROUP BY 1",
    "outcome_counts": "SELECT episode, count(*) FILTER (WHERE duration_s > 0) AS succeeded, count(*) FILTER (WHERE NOT coalesce(duration_s > 0, false)) AS failed FROM clip GROUP BY 1",
    "metric_summary": f"WITH {_METRIC} SELECT metric, instrument, round(mean, 4) AS mean, round(std, 4) AS std FROM n",
    "metric_macro_average": f"WITH {_METRIC} SELECT metric, round(sum(mean) / 2, 4) AS macro FROM n GROUP BY 1",
    "latest_metric": "SELECT 'm' AS metric, l_returnflag AS instrument, l_orderkey AS path, arg_max(l_extendedprice, row(l_linenumber, l_extendedprice)) AS value FROM lineitem GROUP BY ALL",
    "transcript_texts": "WITH c AS (SELECT orig_index, chunk_index, max(text) AS text FROM chunk_text GROUP BY ALL) SELECT orig_index, string_agg(coalesce(text, ''), '' ORDER BY chunk_index) AS text FROM c GROUP BY 1",
    "transcript_items": """WITH c AS (SELECT orig_index, chunk_index, max(items) AS items, max(offset_sec) AS o FROM chunk_text GROUP BY ALL), e AS (SELECT orig_index, chunk_index, o, unnest(items) AS i, generate_subscripts(items, 1) AS k FROM c WHERE items IS NOT NULL)
        SELECT orig_index, CAST(row_number() OVER (PARTITION BY orig_index ORDER BY chunk_index, k) - 1 AS INTEGER) AS i, i.text AS text, round_even(i.start_time + o, 3) AS start_time, round_even(i.end_time + o, 3) AS end_time FROM e""",
    "micro_timeline": f"""WITH {_CL}, t AS (SELECT episode, clip_ord, round(duration_s, 3) AS d, CASE WHEN row_number() OVER o = 1 THEN 0 WHEN lag(clip_ord % 3 = 1) OVER o THEN 10 ELSE 1 END AS f FROM cl WINDOW o AS (PARTITION BY episode ORDER BY clip_ord)),
        e AS (SELECT *, round(floor(round_even(d - f * (1 / 30.0::DOUBLE), 6) * 1000) / 1000, 3) + 0.0001::DOUBLE AS x FROM t),
        u AS (SELECT *, CAST(floor(x * 1000000) AS BIGINT) AS duration_us, CAST(floor(f / 30.0::DOUBLE * 1000000) AS BIGINT) AS source_us FROM e)
        SELECT episode, clip_ord, CAST(coalesce(sum(duration_us + CASE WHEN clip_ord % 3 = 1 THEN 500000 ELSE 0 END) OVER (PARTITION BY episode ORDER BY clip_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_us, duration_us, source_us FROM u""",
    "min_stem_length": "SELECT l_orderkey, min(l_quantity) AS length, min(l_quantity) <> max(l_quantity) AS uneven FROM lineitem GROUP BY 1",
    "ensemble_avg": _ENS.format("sum(v * w) / sum(w)"),
    "ensemble_median": _ENS.format("median(v)"),
    "ensemble_min": _ENS.format("arg_min(v, row(abs(v), vec_id))"),
    "ensemble_max": _ENS.format("arg_max(v, row(abs(v), -vec_id))"),
    "trimmed_mean": "WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.9) AS q FROM lineitem GROUP BY 1) SELECT l_returnflag, round(avg(CASE WHEN l_extendedprice < q THEN l_extendedprice ELSE 0 END), 4) AS masked_mean FROM lineitem JOIN q USING (l_returnflag) GROUP BY 1",
    "overlap_add": """WITH e AS (SELECT label, vec_id % 8 * 16 AS s, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
        w AS (SELECT label, s + i AS pos, v, CASE WHEN i < 6 THEN i / 5.0::DOUBLE WHEN i >= 58 THEN (63 - i) / 5.0::DOUBLE ELSE 1 END AS w FROM e) SELECT label, pos, round(coalesce(sum(v * w) / nullif(sum(w), 0), 0), 6) AS value FROM w GROUP BY ALL""",
    "upsert_by_key": "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders",
    "preflight": """WITH o AS (SELECT o_custkey AS k, bool_or(o_orderpriority LIKE '1%') AS a, bool_or(o_orderpriority LIKE '2%') AS b, bool_or(o_orderpriority LIKE '3%') AS c FROM orders GROUP BY 1)
        SELECT c_custkey AS k, coalesce(a, false) AS has_music, coalesce(b, false) AS has_cover, coalesce(c, false) AS has_script, coalesce(a AND b AND c, false) AS ready FROM customer LEFT JOIN o ON k = c_custkey""",
    "distinct_neighbours": f"WITH {_CL} SELECT DISTINCT episode, unnest([clip_ord, clip_ord + 1]) AS clip FROM cl WHERE clip_ord % 3 = 1",
    "retention_verdict": f"""WITH {_W}, {_C}, a AS (SELECT episode, sum(length(text)) AS said FROM w GROUP BY 1), b AS (SELECT episode, sum(length(regexp_replace(text, {_HAN}, '', 'g'))) AS kept FROM c GROUP BY 1),
        r AS (SELECT episode, coalesce(kept, 0) / greatest(said, 1) AS r FROM a LEFT JOIN b USING (episode)) SELECT episode, round(r::DOUBLE, 6) AS ratio, CASE WHEN r < 0.8 THEN 'reject' WHEN r < 0.9 THEN 'warn' ELSE 'ok' END AS verdict FROM r""",
    "union_sorted": f"WITH {_C} SELECT episode, cue_ord, text, CAST(row_number() OVER (PARTITION BY episode ORDER BY start_time, {_CO}) AS INTEGER) AS rank FROM c",
    "topk_per_group": "SELECT l_suppkey, l_orderkey, l_extendedprice, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn <= 3",
    "argmax_first": "SELECT o_custkey, arg_max(o_orderkey, row(o_orderpriority, -o_orderkey)) AS best, arg_min(o_orderkey, row(o_orderpriority, o_orderkey)) AS least FROM orders GROUP BY 1",
    "contiguous_blocks": "SELECT r AS rank, r * 5 AS start, r * 5 + 5 AS end FROM range(5) t(r)",
}
