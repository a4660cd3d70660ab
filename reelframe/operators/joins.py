"""Interval, nearest and fuzzy joins: equi-joins on buckets or blocks instead of nested loops."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions.text import han
from reelframe.operators.ranks import bucketed, keyed, null_safe_join
from reelframe.operators.sequence import Script, best_line
from reelframe.session import spread


#: Times beyond this many seconds count as this, as far as buckets are concerned.
_FAR = 1e12
#: Seconds of a bucket in which points and intervals of an entity are looked at in order.
BUCKET_S = 600.0


def point_in_intervals(
    points: DataFrame, intervals: DataFrame, keys: list[str], at: Column, start: Column, end: Column, width: float = 10.0
) -> DataFrame:
    """Points joined with the intervals of the same entity that contain them (both ends included).

    An interval of up to ``width`` seconds lies in one or two buckets of that width, one of up to four times as much in one or two of a fourfold width, and so on: a
    wrong end time makes no more rows than any other. Points look into their bucket of each width in use (a handful), in an equi-join on (entity,
    width, bucket): no nested loop, and a hot entity is as many keys as it has buckets. An interval has one width and a point one bucket in it, so that no pair comes twice.
    Columns: those of the points, and the interval as struct ``interval``. Null times meet nothing.
    """
    near = lambda c: F.least(F.greatest(c, F.lit(-_FAR)), F.lit(_FAR))
    wide = lambda level: F.lit(width) * F.pow(F.lit(4.0), level)
    iv = intervals.select(*keys, F.struct(*intervals.columns).alias("interval"), start.alias("_s"), end.alias("_e")).where(F.col("_e") >= F.col("_s"))
    span = F.greatest(near(F.col("_e")) - near(F.col("_s")), F.lit(width))
    iv = iv.withColumn("_level", F.ceil(F.log(4.0, span / width) - 1e-9).cast("int"))
    bucket = lambda c: F.floor(near(c) / wide(F.col("_level")))
    levels = iv.agg(F.collect_set("_level").alias("_levels")).withColumn("_one", F.lit(1))  # one row of a few numbers
    iv = iv.withColumn("_b", F.explode(F.sequence(bucket(F.col("_s")), bucket(F.col("_e")))))
    p = points.withColumn("_at", at).where("_at IS NOT NULL").withColumn("_one", F.lit(1)).join(F.broadcast(levels), "_one").withColumn("_level", F.explode("_levels")).drop("_one", "_levels")
    p = p.withColumn("_b", bucket(F.col("_at")))
    return p.join(iv, [*keys, "_level", "_b"]).where(F.col("_at").between(F.col("_s"), F.col("_e"))).drop("_at", "_b", "_level", "_s", "_e")


def not_covered(points: DataFrame, intervals: DataFrame, keys: list[str], at: Column, start: Column, end: Column, width: float = BUCKET_S) -> DataFrame:
    """Points that lie in no interval of their entity; points without a time stay. Rows are kept as they are, repeats too.

    A point is covered if the greatest end of the intervals that start no later lies no earlier: a running maximum over points and starts in order, taken in buckets of
    ``width`` seconds. An interval is one row, however long it is.
    """
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in points.schema if f.name not in keys]
    p = points.withColumn("_t", at.cast("double")).withColumn("_e", F.lit(None).cast("double")).withColumn("_side", F.lit(1))
    iv = intervals.select(*keys, start.cast("double").alias("_t"), end.cast("double").alias("_e")).where("_e >= _t")
    iv = iv.select(*keys, *nulls, "_t", "_e", F.lit(0).alias("_side")).select(p.columns)
    bucket = F.floor(F.least(F.greatest(F.col("_t"), F.lit(-_FAR)), F.lit(_FAR)) / width)
    rows = bucketed(p.unionByName(iv), keys, ["_t", "_side"], "_e", "_reach", bucket, "max")
    return rows.where("_side = 1 AND NOT coalesce(_reach >= _t, false)").select(points.columns)


def hard_subtitles(cues: DataFrame, hard: DataFrame, lines: DataFrame, keys: list[str], cue_id: list[str], width: float = 10.0) -> DataFrame:
    """Cues without those that repeat a caption in the picture.

    A cue goes if it starts within [s - 0.1, e] of a caption interval; the first interval (interval_ord) that holds its start decides, and spares a
    cue of four Han characters or more that is a line of the script and starts less than 0.5 s after s.
    """
    script = lines.select(*keys, han("line").alias("_h")).where("_h <> ''").distinct().withColumn("_known", F.lit(True))
    c = cues.withColumn("_h", han("text"))
    known = c.join(script, [*keys, "_h"], "left")
    hit = point_in_intervals(known, hard, keys, F.col("start_time"), F.col("s") - 0.1, F.col("e"), width)
    spare = (F.col("start_time") < F.col("interval.s") + 0.5) & (F.length("_h") >= 4) & F.coalesce("_known", F.lit(False))
    gone = hit.groupBy(*cue_id).agg(F.min_by(~spare, F.col("interval.interval_ord")).alias("_go")).where("_go").select(*cue_id)
    return cues.join(gone, cue_id, "left_anti")


def words_in_cues(words: DataFrame, cues: DataFrame, keys: list[str], slack: float = 0.1, width: float = 10.0) -> DataFrame:
    """Words that lie within a cue, ``slack`` seconds over either end: the word's columns and the cue as struct interval."""
    got = point_in_intervals(words, cues, keys, F.col("start_time"), F.col("start_time") - slack, F.col("end_time") + slack, width)
    return got.where(F.col("end_time") <= F.col("interval.end_time") + slack)


def split_long_cues(cues: DataFrame, words: DataFrame, keys: list[str], cue_ord: str, longest: float = 5.0, least_gap: float = 2.0) -> DataFrame:
    """Cues longer than ``longest`` with a pause of ``least_gap`` or more between their words become two, at the largest pause (the first of equals).

    The text is cut after as many characters as the words before the pause have; if either part is blank the cue stays. Adds part (0 or 1).
    """
    c = cues.where(F.col("end_time") - F.col("start_time") > longest)
    inside = words_in_cues(words.select(*keys, "word_ord", F.coalesce("text", F.lit("")).alias("text"), "start_time", "end_time"), c, keys)
    w = Window.partitionBy(*keys, f"interval.{cue_ord}").orderBy("word_ord")
    inside = inside.withColumn("_n", F.sum(F.length("text")).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_next", F.lead("start_time").over(w))
    gaps = inside.withColumn("_gap", F.col("_next") - F.col("end_time")).where(F.col("_gap") >= least_gap)
    best = gaps.groupBy(*keys, F.col(f"interval.{cue_ord}").alias(cue_ord)).agg(
        F.max_by(F.struct(F.col("_n").alias("n"), F.col("end_time").alias("a"), F.col("_next").alias("b")), F.struct("_gap", -F.col("word_ord"))).alias("_cut")
    )
    rows = cues.join(best, [*keys, cue_ord], "left")
    left, right = F.trim(F.left("text", F.col("_cut.n"))), F.trim(F.substring(F.col("text"), F.col("_cut.n") + 1, F.length("text")))
    part = lambda p, t, s, e: F.struct(F.lit(p).alias("part"), t.alias("text"), s.alias("start_time"), e.alias("end_time"))
    s, e = F.col("start_time"), F.col("end_time")
    long = (e - s > longest) & (left != "") & (right != "")
    parts = F.when(F.col("_cut").isNotNull() & long, F.array(part(0, left, s, F.col("_cut.a")), part(1, right, F.col("_cut.b"), e))).otherwise(F.array(part(0, F.col("text"), s, e)))
    others = [x for x in cues.columns if x not in ("text", "start_time", "end_time")]
    return rows.select(*others, F.explode(parts).alias("_p")).select(*others, "_p.*")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, left_at: str, right_id: str, right_at: str, width: float | None = None) -> DataFrame:
    """J5, J1 (one side): for each left row the nearest right row in time of its entity; ties go to the earlier, then to the lesser id.

    Both sides are merged into one order and looked at forward and backward (an as-of join either way), which costs a sort instead of a product. With ``width``, in
    buckets of so much time, so that a hot entity is spread.
    Output: keys, left_id, left_at, right_id, right_at, distance; null where the entity has no right row.
    """
    a = left.select(*keys, F.col(left_at).alias("_t"), F.lit(1).alias("_side"), F.col(left_id).alias("_l"), F.lit(None).cast(right.schema[right_id].dataType).alias("_r"))
    b = right.where(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema[left_id].dataType).alias("_l"), F.col(right_id).alias("_r"))
    rows = a.unionByName(b).withColumn("_x", F.when(F.col("_side") == 0, F.struct(F.col("_t").alias("t"), F.col("_r").alias("r"))))
    rows, k = keyed(rows, keys, F.floor(F.col("_t") / width) if width else F.lit(0))
    inner = Window.partitionBy(*k, "_in_bucket")
    before = inner.orderBy("_t", "_side", F.desc("_r"), "_l").rowsBetween(Window.unboundedPreceding, 0)
    # Behind: the least id among those of the next time; sides are turned so that equal times count once, before.
    behind = inner.orderBy(F.desc("_t"), "_side", F.desc("_r"), "_l").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_p", F.last("_x", ignorenulls=True).over(before)).withColumn("_q", F.last("_x", ignorenulls=True).over(behind)).where("_side = 1")
    if width:
        # Of each bucket its last and its first time, with the least id of each; a bucket without any passes on what it was given.
        right_only = lambda t: F.when(F.col("_side") == 0, F.struct(t.alias("t"), F.col("_r").alias("r")))
        ends = rows.groupBy(*k, "_in_bucket").agg(F.min_by("_x", right_only(-F.col("_t"))).alias("_last"), F.min_by("_x", right_only(F.col("_t"))).alias("_first"))
        over = Window.partitionBy(*k).orderBy("_in_bucket")
        ends = ends.withColumn("_bp", F.last("_last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)))
        ends = ends.withColumn("_bq", F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing))).select(*k, "_in_bucket", "_bp", "_bq")
        local = local.join(ends, [*k, "_in_bucket"]).withColumn("_p", F.coalesce("_p", "_bp")).withColumn("_q", F.coalesce("_q", "_bq"))
    rows = local
    dp, dq = F.col("_t") - F.col("_p.t"), F.col("_q.t") - F.col("_t")
    best = F.when(F.col("_p").isNull() | (dq < dp), F.col("_q")).otherwise(F.col("_p"))
    return rows.select(*keys, F.col("_l").alias(left_id), F.col("_t").alias(left_at), best["r"].alias(right_id), best["t"].alias(right_at), F.abs(F.col("_t") - best["t"]).alias("distance"))


def near_groups(groups: DataFrame, cues: DataFrame, keys: list[str], most: float = 8.0, width: float = BUCKET_S) -> DataFrame:
    """Groups at most ``most`` seconds from a cue: the least of |cue end - group start| and |group end - cue start|."""
    g = groups.withColumn("_id", F.struct("start_time", "end_time"))
    c = cues.withColumn("_c", F.struct("start_time", "end_time"))
    a = nearest(g.select(*keys, "_id", F.col("start_time").alias("_a")), c, keys, "_id", "_a", "_c", "end_time", width)
    b = nearest(g.select(*keys, "_id", F.col("end_time").alias("_a")), c, keys, "_id", "_a", "_c", "start_time", width)
    d = a.select(*keys, "_id", "distance").unionByName(b.select(*keys, "_id", "distance")).groupBy(*keys, "_id").agg(F.min("distance").alias("nearest_gap"))
    return g.join(d, [*keys, "_id"]).where(F.col("nearest_gap") <= most).drop("_id")


def assign_junctions(scenes: DataFrame, junctions: DataFrame, keys: list[str], duration: str, window: float = 0.20, least_dist: float = 70.0) -> DataFrame:
    """Each scene change takes the nearest free junction within ``window`` of the duration whose colour distance is enough.

    Scenes choose in order, a junction serves once. An entity is one video: its scenes and junctions are few, and they are joined by the
    window first, so that what one task holds are candidates only. Output: keys, scene_ord, junction.
    """
    cand = scenes.join(junctions, keys).where((F.col("dist") >= least_dist) & (F.abs(F.col("time_s") - F.col("expected_s")) <= window * F.col(duration)))
    cand = cand.select(*keys, "scene_ord", "junction", F.abs(F.col("time_s") - F.col("expected_s")).alias("_d"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for _, g in pdf.sort_values(["scene_ord", "_d", "junction"]).groupby("scene_ord", sort=True):
            free = [j for j in g["junction"] if j not in used]
            if free:
                used.add(free[0])
                out.append(g[g["junction"] == free[0]].iloc[:1])
        got = pd.concat(out) if out else pdf.iloc[:0]
        return got[[*keys, "scene_ord", "junction"]]

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cand.select(*keys, "scene_ord", "junction").schema)
    return cand.groupBy(*keys).applyInPandas(choose, ddl)


#: Cues that one task compares with a script, about.
BLOCK_CUES = 1024


def best_lines(cues: DataFrame, lines: DataFrame, keys: list[str], cue_id: str, line_ord: str, block_cues: int = BLOCK_CUES) -> DataFrame:
    """Keys, cue_id, match_li, match_score: the line of the entity's script with the greatest LCS ratio to the cue's Han characters, the first of equals.

    Cues shorter than two characters, and entities without lines, give (-1, 0). Cues are dealt over as many blocks of about ``block_cues`` as their entity needs, and the
    script of the entity goes to each block once, so a hot entity is many tasks. A text is compared with all lines of the script at once, and once however often it is said.
    """
    c = cues.select(*keys, cue_id, han(F.coalesce("text", F.lit(""))).alias("_h"))
    blocks = c.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_cues).alias("_n"))
    # Equal texts meet in a block.
    c = null_safe_join(c, blocks, keys).withColumn("_block", F.pmod(F.xxhash64("_h"), F.col("_n"))).drop("_n")
    s = lines.select(*keys, line_ord, han(F.coalesce("line", F.lit(""))).alias("_l")).join(blocks, keys)
    s = s.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")

    def match(cue: pd.DataFrame, script: pd.DataFrame) -> pd.DataFrame:
        held = Script(script.sort_values(line_ord, kind="stable")["_l"].tolist())
        seen = {h: best_line(h, held) for h in cue["_h"].unique()}
        return cue[[*keys, cue_id]].assign(match_li=[seen[h][0] for h in cue["_h"]], match_score=[seen[h][1] for h in cue["_h"]])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cues.select(*keys, cue_id).schema) + ", match_li int, match_score double"
    c, s = (spread(x, [*keys, "_block"]) for x in (c, s))
    return c.groupBy(*keys, "_block").cogroup(s.groupBy(*keys, "_block")).applyInPandas(lambda a, b: match(a, b) if len(a) else a[[*keys, cue_id]].assign(match_li=[], match_score=[]), ddl)


def known_and_new(items: DataFrame, cache: DataFrame, on: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """(items whose value the cache holds, with it; items to be probed)."""
    return items.join(cache.select(*on, value), on), items.join(cache, on, "left_anti")


def first_by_priority(candidates: DataFrame, keys: list[str], priority: list[str], value: str) -> DataFrame:
    """Of each key the value of least priority (columns in order, then the value itself)."""
    return candidates.groupBy(*keys).agg(F.min_by(value, F.struct(*priority, value)).alias(value))


def coalesced_lookup(left: DataFrame, sources: list[DataFrame], on: list[str], value: str) -> DataFrame:
    """The value from the first source that has the key; null if none has."""
    out = left
    for i, s in enumerate(sources):
        out = out.join(s.groupBy(*on).agg(F.min(value).alias(f"_v{i}")), on, "left")
    return out.withColumn(value, F.coalesce(*[F.col(f"_v{i}") for i in range(len(sources))])).drop(*[f"_v{i}" for i in range(len(sources))])


def title_matches(titles: DataFrame, names: DataFrame, title: str, name: str) -> DataFrame:
    """For each title the name that holds most of its characters (counted with repeats in the title), at least half; ties go to the lesser name.

    A name that holds at least half of a title's n characters holds one of its rarest: whatever n // 2 + 1 of them are picked, one is in it. So a title meets names through
    that many of its least frequent characters, and what they share is counted on the pairs that meet.
    """
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    n = names.select(name).where(F.length(name) > 0).distinct()
    held = n.select(name, F.explode(F.array_distinct(chars(F.col(name)))).alias("_c"))
    often = held.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    t = titles.select(title).where(F.length(title) > 0).distinct()
    each = t.select(title, F.posexplode(chars(F.col(title))).alias("_i", "_c")).join(often, "_c", "left")
    each = each.withColumn("_k", F.row_number().over(Window.partitionBy(title).orderBy(F.coalesce("_n", F.lit(0)), "_i")))
    probe = each.where(F.col("_k") <= F.floor(F.length(title) / 2) + 1).select(title, "_c").distinct()
    met = probe.join(held, "_c").select(title, name).distinct()
    met = met.withColumn("shared", F.size(F.filter(chars(F.col(title)), lambda x: F.contains(F.col(name), x))).cast("long")).where(F.col("shared") * 2 >= F.length(title))
    return met.groupBy(title).agg(F.min_by(F.struct(name, "shared"), F.struct(-F.col("shared"), F.col(name))).alias("_b")).select(title, "_b.*")


def project_directories(projects: DataFrame, names: DataFrame, project: str, name: str) -> DataFrame:
    """Names equal to a project but for punctuation, or that contain it: project, name.

    Equal ones meet on the cleaned text; a name that contains a project does so at one of its characters, so names are met through their substrings of the project lengths.
    """
    clean = lambda c: F.regexp_replace(c, r"[^\p{L}\p{N}]", "")
    p = projects.select(project).distinct().where(F.length(project) > 0)
    n = names.select(name).distinct()
    equal = p.withColumn("_k", clean(F.col(project))).where("_k <> ''").join(n.withColumn("_k", clean(F.col(name))), "_k").select(project, name)
    # The distinct lengths are few whatever the projects; they go to every name as one array.
    lens = p.agg(F.collect_set(F.length(project)).alias("_ns")).withColumn("_k", F.lit(1))
    subs = n.withColumn("_k", F.lit(1)).join(F.broadcast(lens), "_k").withColumn("_n", F.explode("_ns")).where(F.length(name) >= F.col("_n"))
    subs = subs.withColumn(project, F.explode(F.transform(F.sequence(F.lit(1), F.length(name) - F.col("_n") + 1), lambda i: F.substring(F.col(name), i, F.col("_n"))))).drop("_n", "_ns", "_k")
    return equal.unionByName(subs.join(p, project, "left_semi").select(project, name)).distinct()


def positional_zip(a: DataFrame, b: DataFrame, keys: list[str], order_a: list[str], order_b: list[str]) -> DataFrame:
    """The i-th row of one list beside the i-th of the other; the shorter ends it."""
    x = a.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_a)))
    y = b.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_b)))
    return x.join(y, [*keys, "position"])


def _holding(rows: DataFrame, text: Column, needles: DataFrame, keys: list[str], needle: str) -> DataFrame:
    """Rows joined with the needles of their entity that their text holds, through the substrings of the needles' lengths; a needle that comes twice in a text counts once."""
    lens = needles.agg(F.collect_set(F.length(needle)).alias("_ns")).withColumn("_one", F.lit(1))  # one row: texts have few lengths
    cut = F.flatten(F.transform("_ns", lambda n: F.when(F.length("_t") >= n, F.transform(F.sequence(F.lit(1), F.length("_t") - n + 1), lambda i: F.substring(F.col("_t"), i, n))).otherwise(F.array().cast("array<string>"))))
    subs = rows.withColumn("_t", text).withColumn("_one", F.lit(1)).join(F.broadcast(lens), "_one").withColumn(needle, F.explode(F.array_distinct(cut))).drop("_t", "_one", "_ns")
    return subs.join(needles, [*keys, needle])


def position_gate(cues: DataFrame, lines: DataFrame, pairs: DataFrame, keys: list[str], most: float = 0.35) -> DataFrame:
    """The replacements (cue, wrong, right) whose place in the script agrees with the cue's place.

    ``cues``: keys, cue_pct, cue_id, text; ``lines``: keys, line_pct, line; ``pairs``: keys, wrong, right. A pair applies to a cue that holds wrong; it is refused if the lines
    that hold right are all further than ``most``, or if wrong (three Han characters or more) is itself in a line within ``most``. Texts meet the pairs through their
    substrings, so that no cue is compared with all pairs and no pair with all lines. Rows with null keys, and empty wrong, meet nothing.
    """
    p = pairs.select(*keys, "wrong", "right").distinct().where("wrong <> ''")
    places = lambda text, least, out: (
        _holding(lines.select(*keys, "line_pct", "line"), F.col("line"), p.select(*keys, han(text).alias("_h")).where(F.length("_h") >= least).distinct(), keys, "_h")
        .groupBy(*keys, "_h").agg(F.collect_list("line_pct").alias(out))
    )
    p = p.withColumn("_h", han("right")).join(places("right", 1, "_rs"), [*keys, "_h"], "left").withColumn("_h", han("wrong")).join(places("wrong", 3, "_ws"), [*keys, "_h"], "left").drop("_h")
    use = _holding(cues.select(*keys, "cue_id", "cue_pct", "text"), F.col("text"), p, keys, "wrong")
    gap = lambda c: F.array_min(F.transform(c, lambda x: F.abs(F.col("cue_pct") - x)))
    r, w = gap("_rs"), gap("_ws")
    return use.where((r.isNull() | (r <= most)) & (w.isNull() | (w > most))).select(*keys, "cue_id", "cue_pct", "wrong", "right").distinct()


def claimed_elsewhere(matches: DataFrame, keys: list[str], least: float = 0.5) -> DataFrame:
    """Claimed: whether another cue of the entity matches the same line with at least ``least``."""
    strong = F.when(F.col("match_score") >= least, 1).otherwise(0)
    n = F.sum(strong).over(Window.partitionBy(*keys, "match_li"))
    return matches.withColumn("claimed", (n - strong) > 0)
