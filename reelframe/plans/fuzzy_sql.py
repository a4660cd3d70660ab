"""SQL of the queries that compare texts or decide step by step: recursive tables in DuckDB."""

from __future__ import annotations

from reelframe.plans.io_queries import SQL as IO_SQL
from reelframe.plans.pass_queries import SQL as PASS_SQL

_C = "c AS (SELECT DISTINCT episode, cue_ord, text, start_time, end_time FROM cue WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL)"
_S = "sc AS (SELECT episode, line_ord, max({'speaker': speaker, 'line': line, 'raw': raw}) AS v FROM script_line GROUP BY ALL), s AS (SELECT episode, line_ord, v.line AS line FROM sc)"
_HAN = r"'[^\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]'"
#: The longest common subsequence of todo(x, y), a character of x a step: what is reached at j is the best over all k up to j of what was reached at k, and at k - 1 where the characters agree.
_LCS = """todo2 AS (SELECT x, y, string_split(x, '') AS a, string_split(y, '') AS b FROM todo WHERE x <> '' AND y <> ''),
        step(i, x, y, a, b, r) AS (SELECT 0, x, y, a, b, list_transform(range(len(b) + 1), lambda z: 0) FROM todo2 UNION ALL
          SELECT i + 1, x, y, a, b, list_prepend(0, list_transform(range(1, len(b) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN b[k] = a[i + 1] THEN r[k] + 1 ELSE r[k + 1] END)))) FROM step WHERE i < len(a)),
        lcs AS (SELECT x, y, list_max(r) / greatest(len(a), len(b)) AS ratio FROM step WHERE i = len(a))"""
#: The characters of y that x holds in order, up to the first that it does not, over those of y, of want(x, y).
_ORDERED = """walk(n, x, y, p) AS (SELECT 0, x, y, 0 FROM want UNION ALL
          SELECT n + 1, x, y, p + instr(substr(x, p + 1), substr(y, n + 1, 1)) FROM walk WHERE n < length(y) AND instr(substr(x, p + 1), substr(y, n + 1, 1)) > 0),
        ordered AS (SELECT x, y, max(n) / greatest(length(y), 1) AS share FROM walk GROUP BY x, y)"""
_BEST = f"""{_C}, {_S}, t AS (SELECT episode, cue_ord, regexp_replace(max(text), {_HAN}, '', 'g') AS h FROM c GROUP BY ALL),
        l AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY line_ord) - 1 AS li, regexp_replace(coalesce(line, ''), {_HAN}, '', 'g') AS l FROM s),
        todo AS (SELECT DISTINCT h AS x, l AS y FROM t JOIN l USING (episode) WHERE length(h) >= 2 AND len(list_intersect(string_split(h, ''), string_split(l, ''))) > 0), {_LCS},
        m AS (SELECT episode, cue_ord, li, ratio FROM t JOIN l USING (episode) JOIN lcs ON x = h AND y = l WHERE ratio > 0 QUALIFY row_number() OVER (PARTITION BY episode, cue_ord ORDER BY ratio DESC, li) = 1),
        best AS (SELECT episode, cue_ord, CAST(coalesce(li, -1) AS INTEGER) AS match_li, round(coalesce(ratio, 0), 6)::DOUBLE AS match_score FROM t LEFT JOIN m USING (episode, cue_ord))"""
#: Frames of ten a second: the head to its first bright or lettered frame within 5 s, the second behind it, the last bright frame of the last 5 s.
_TRIM = """f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value AS v, event_type = 'error' AS t FROM events WHERE value IS NOT NULL),
        n AS (SELECT user_id, count(*) AS n, coalesce(min(i) FILTER (WHERE i >= 50 OR v >= 50 OR t), count(*)) AS b FROM f GROUP BY 1),
        w AS (SELECT user_id, f.i, f.v >= 80 AS hi, b FROM f JOIN n USING (user_id) WHERE f.i >= b AND f.i < b + 10),
        p AS (SELECT x.user_id, min(x.i) AS done FROM w x JOIN w y ON y.user_id = x.user_id AND y.i = x.i + 1 WHERE x.hi AND y.hi GROUP BY 1),
        q AS (SELECT user_id, max(i) + 1 AS dim FROM w WHERE NOT hi GROUP BY 1),
        k AS (SELECT f.user_id, max(i) AS k FROM f JOIN n USING (user_id) WHERE i >= n - 50 AND (v >= 50 OR t) GROUP BY 1),
        h AS (SELECT f.user_id FROM f JOIN n USING (user_id) WHERE i = b AND v < 50 AND t AND i < 50),
        e AS (SELECT n.user_id, n, b, k, h.user_id IS NOT NULL AS lettered, coalesce(done, greatest(dim, b), b) AS fade FROM n LEFT JOIN p USING (user_id) LEFT JOIN q USING (user_id) LEFT JOIN k USING (user_id) LEFT JOIN h USING (user_id)),
        d AS (SELECT user_id, CASE WHEN lettered THEN NULL WHEN b > 0 AND fade > b AND fade <= b + 5 THEN fade / 10 WHEN b >= 1 THEN b / 10 END AS start_trim, CASE WHEN n - 1 - k >= 1 THEN (k + 1) / 10 END AS end_trim FROM e)"""
SQL = {
    "l1_freq_metric": PASS_SQL.pop("l1_freq_metric"),
    "lcs_ratios": f"""WITH RECURSIVE {_S}, p AS (SELECT episode, line_ord, lag(line) OVER (PARTITION BY episode ORDER BY line_ord) AS prev, line FROM s), k AS (SELECT * FROM p WHERE prev IS NOT NULL AND line IS NOT NULL),
        todo AS (SELECT DISTINCT prev AS x, line AS y FROM k), want AS (SELECT * FROM todo), {_LCS}, {_ORDERED}
        SELECT episode, line_ord, round(coalesce(ratio, 0), 6)::DOUBLE AS lcs, round(share, 6)::DOUBLE AS ordered FROM k JOIN ordered o ON o.x = prev AND o.y = line LEFT JOIN lcs ON lcs.x = prev AND lcs.y = line""",
    "fuzzy_best_line": f"WITH RECURSIVE {_BEST} SELECT * FROM best",
    "claimed_lines": f"""WITH RECURSIVE {_BEST}, n AS (SELECT episode, match_li, count(*) FILTER (WHERE match_score >= 0.5) AS n FROM best GROUP BY ALL)
        SELECT episode, cue_ord, n - CASE WHEN match_score >= 0.5 THEN 1 ELSE 0 END > 0 AS claimed FROM best JOIN n USING (episode, match_li)""",
    "repeated_captions": f"""WITH RECURSIVE {_C}, t AS (SELECT episode, cue_ord, text, regexp_replace(text, {_HAN}, '', 'g') AS h, '山上的灵泉是他们早就挡住的' AS g FROM c), want AS (SELECT DISTINCT h AS x, g AS y FROM t UNION SELECT DISTINCT g, h FROM t), {_ORDERED}
        SELECT episode, cue_ord, text, h <> '' AND (contains(g, h) OR contains(h, g) OR (a.share >= 0.6 AND b.share >= 0.6)) AS again FROM t JOIN ordered a ON a.x = g AND a.y = h JOIN ordered b ON b.x = h AND b.y = g""",
    "trim_decisions": f"WITH {_TRIM} SELECT user_id, round(start_trim, 6)::DOUBLE AS start_trim, round(end_trim, 6)::DOUBLE AS end_trim FROM d",
    "edit_decisions": f"""WITH {_TRIM} SELECT user_id, CASE WHEN start_trim IS NULL AND end_trim IS NULL THEN 'copy' ELSE 'encode' END AS action,
        CASE WHEN start_trim IS NOT NULL OR end_trim IS NOT NULL THEN round(coalesce(start_trim, 0), 6) END::DOUBLE AS seek_s, round(end_trim - coalesce(start_trim, 0), 6)::DOUBLE AS length_s FROM d""",
    "junction_assignment": f"""WITH RECURSIVE {_S}, cl AS (SELECT episode, clip_ord, coalesce(max(duration_s), 0.0) AS d FROM clip GROUP BY ALL), tot AS (SELECT episode, sum(d) AS total FROM cl GROUP BY 1),
        g AS (SELECT episode, line_ord // 8 AS o, count(*) AS n FROM s GROUP BY ALL),
        x AS (SELECT episode, o, total, sum(n) OVER (PARTITION BY episode ORDER BY o) / sum(n) OVER (PARTITION BY episode) * total AS due, lead(o) OVER (PARTITION BY episode ORDER BY o) AS nx FROM g JOIN tot USING (episode)),
        j AS (SELECT episode, clip_ord AS j, sum(d) OVER (PARTITION BY episode ORDER BY clip_ord) AS t, lead(clip_ord) OVER (PARTITION BY episode ORDER BY clip_ord) AS nx FROM cl),
        cand AS (SELECT episode, o, list({{'d': abs(t - due), 'j': j}} ORDER BY abs(t - due), j) AS js FROM x JOIN j USING (episode) WHERE x.nx IS NOT NULL AND j.nx IS NOT NULL AND j * 37 % 200 >= 70 AND abs(t - due) <= 0.2::DOUBLE * total GROUP BY ALL),
        k AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY o) AS i FROM cand),
        r(episode, i, o, pick, used) AS (SELECT episode, i, o, js[1].j, [js[1].j] FROM k WHERE i = 1 UNION ALL
          SELECT episode, i, o, p, CASE WHEN p IS NULL THEN used ELSE list_append(used, p) END FROM (SELECT k.*, r.used, list_filter(js, lambda z: NOT list_contains(r.used, z.j))[1].j AS p FROM r JOIN k ON k.episode = r.episode AND k.i = r.i + 1))
        SELECT episode, o AS scene_ord, pick AS junction FROM r WHERE pick IS NOT NULL""",
}
assert not set(SQL) & set(IO_SQL)
