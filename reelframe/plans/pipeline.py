"""The ordered stages from words to final cues, each a function of tables keyed by episode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions.records import valid_replacement
from reelframe.functions.text import clamp_word_end, han, is_interjection, keep_unless_halved, strip_beep, strip_trailing_particle
from reelframe.operators import aggregates as A
from reelframe.operators import joins as J
from reelframe.operators import sequence as Q
from reelframe.operators import timeline as W


@dataclass(frozen=True)
class Settings:
    """The thresholds of the pipeline and the stages to leave out."""

    gap_s: float = 0.4
    skip: frozenset[str] = frozenset()


def clamp(words: DataFrame) -> DataFrame:
    """P2."""
    return words.withColumn("end_time", clamp_word_end("text", "start_time", "end_time"))


def salvage(cues: DataFrame, words: DataFrame, keys: list[str], passes: int = 4) -> DataFrame:
    """Words that no cue covers come back as cues, up to ``passes`` times, as long as there are any."""
    from reelframe.session import cut

    now = cut(cues)
    for _ in range(passes):
        lost = J.not_covered(words, now, keys, (F.col("start_time") + F.col("end_time")) / 2, F.col("start_time"), F.col("end_time") + 0.5)
        groups = cut(W.uncovered_groups(lost, keys, ["word_ord", "start_time", "end_time", "text"]))
        found = cut(J.near_groups(groups, now, keys).select(*keys, "text", "start_time", "end_time"))
        if found.isEmpty():
            break
        now = cut(now.unionByName(found, allowMissingColumns=True))
    return now


def segment_cues(words: DataFrame, segments: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """Cues of the episodes that have segments: keys, cue_ord, text, start_time, end_time.

    ``segments``: keys, seg_ord, text. Segments keep their order; where words were salvaged, the cues of the episode are put in order of time.
    """
    from reelframe.session import cut

    w = cut(words.where("start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL").join(segments.select(*keys).distinct(), keys, "left_semi"))
    # W26 looks at the aligned cues twice, which are made once.
    cues = J.split_long_cues(cut(Q.align_cues(segments, w, lines, keys, "seg_ord", "word_ord", "line_ord")), w, keys, "ord")
    cues = salvage(cues, w, keys)
    timed = F.max(F.col("ord").isNull()).over(Window.partitionBy(*keys))
    cues = cues.withColumn("_at", F.when(timed, F.col("start_time")))
    order = Window.partitionBy(*keys).orderBy("_at", F.asc_nulls_last("ord"), "part", "end_time", "text")
    return cues.select(*keys, (F.row_number().over(order) - 1).cast("long").alias("cue_ord"), "text", "start_time", "end_time")


def replaced(cues: DataFrame, lines: DataFrame, pairs: DataFrame, keys: list[str], most: float = 0.35) -> DataFrame:
    """The cues with the valid pairs of their entity replaced, longest first, where the script agrees.

    ``pairs``: keys, pair_ord, wrong, right; of equal wrong ones the last valid right counts. A pair applies to the text as the pairs before it left it: it is
    refused if the lines that hold right are all further than ``most`` from the cue's place, or if wrong (three Han characters or more) is
    itself in a line within ``most``. Entities without a script stay as they are.
    """
    in_entity = Window.partitionBy(*keys)
    said = lines.select(*keys, "line_ord", han(F.coalesce("line", F.lit(""))).alias("_l"))
    placed = said.select(*keys, "_l", ((F.row_number().over(in_entity.orderBy("line_ord")) - 1) / F.count(F.lit(1)).over(in_entity)).alias("_p"))
    script = said.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "_l"))), lambda x: x["_l"]), "").alias("_s"))
    good = pairs.join(script, keys).where(valid_replacement("wrong", "right", "_s"))
    # As in a table that is filled in order: a later right takes the place of the earlier one.
    good = good.groupBy(*keys, "wrong").agg(F.max_by("right", "pair_ord").alias("right"), F.min("pair_ord").alias("pair_ord"))
    hr, hw = han("right"), han("wrong")
    near = good.join(placed, keys).groupBy(*keys, "wrong", "right", "pair_ord").agg(
        F.collect_list(F.when((hr != "") & F.contains("_l", hr), F.col("_p"))).alias("r"),
        F.collect_list(F.when((F.length(hw) >= 3) & F.contains("_l", hw), F.col("_p"))).alias("w"),
    )
    # What already stands before wrong where right only adds in front (H12); quoted for the expression.
    extra = F.left("right", F.length("right") - F.length("wrong"))
    quoted = lambda c: F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    adds = F.endswith("right", F.col("wrong")) & (F.length("right") > F.length("wrong"))
    pattern = F.when(adds, F.concat(F.lit("(?<!"), quoted(extra), F.lit(")"), quoted(F.col("wrong"))))
    literal = F.replace(F.replace(F.col("right"), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    pair = F.struct((-F.length("wrong")).alias("n"), F.col("pair_ord").alias("i"), "wrong", "right", "r", "w", pattern.alias("pattern"), literal.alias("literal"))
    table = near.groupBy(*keys).agg(F.array_sort(F.collect_list(pair)).alias("_pairs"))
    place = (F.row_number().over(in_entity.orderBy("cue_ord", "start_time", "end_time", "text")) - 0.5) / F.count(F.lit(1)).over(in_entity)
    rows = cues.withColumn("_place", place).join(table, keys, "left")

    def apply(t: Column, p: Column) -> Column:
        gap = lambda places: F.array_min(F.transform(places, lambda x: F.abs(F.col("_place") - x)))
        ok = F.contains(t, p["wrong"]) & (F.coalesce(gap(p["r"]), F.lit(0.0)) <= most) & (F.coalesce(gap(p["w"]), F.lit(1.0)) > most)
        return F.when(ok, F.when(p["pattern"].isNotNull(), F.regexp_replace(t, p["pattern"], p["literal"])).otherwise(F.replace(t, p["wrong"], p["right"]))).otherwise(t)

    new = F.when(F.col("_pairs").isNotNull(), F.aggregate("_pairs", F.col("text"), apply)).otherwise(F.col("text"))
    return rows.withColumn("_new", new).withColumn("text", keep_unless_halved("text", "_new")).select(*cues.columns)


def final_cues(
    words: DataFrame, lines: DataFrame, keys: list[str], video_s: str | Column | DataFrame | None = None, hard: DataFrame | None = None, settings: Settings = Settings(),
    segments: DataFrame | None = None, pairs: DataFrame | None = None,
) -> DataFrame:
    """Words to final cues: keys, cue_ord, text, start_time, end_time.

    The order is part of the meaning: clamp, the cues of the segments (``segment_cues``) or else W2, W25, P5, the replacements, P4, W23, the correction passes, P6, W10, captions (J3),
    P3, W28, W6. An entity without segments (keys, seg_ord, text), or whose segments keep less than 80 % of its characters (P18), takes W2. ``pairs``: see
    ``replaced``. ``video_s`` may be a table (keys, video_s); where it has no length or 0, W28 changes nothing.
    """
    from reelframe.session import cut

    w = words if "clamp" in settings.skip else clamp(words)
    order = ["word_ord", "start_time", "end_time", "text"]
    merged, kept = w, None
    if segments is not None and "segments" not in settings.skip:
        kept = cut(A.retention(words, segments, keys).where("verdict <> 'reject'").select(*keys))
        merged = w.join(kept, keys, "left_anti")
    cues = Q.words_to_cues(merged.select(*keys, *order), keys, order, settings.gap_s)

    def first(cs: list[Q.Cue], ls: list[str]) -> list[Q.Cue]:
        return Q.attach_orphans(cs, ls) if ls else cs

    def second(cs: list[Q.Cue], ls: list[str]) -> list[Q.Cue]:
        if ls:
            cs = Q.correct(Q.join_single_chars(cs, ls), ls)
        return Q.drop_repeats(Q.drop_noise(cs, ls))

    numbered = cues.withColumn("cue_ord", F.lit(0).cast("long"))
    if kept is not None:
        numbered = numbered.unionByName(segment_cues(w, segments.join(kept, keys, "left_semi"), lines, keys))
    a = Q.correct_cues(numbered, lines, keys, "cue_ord", "line_ord", first).drop("match_li", "match_score")
    a = a.withColumn("text", strip_beep("text"))
    if pairs is not None and "replace" not in settings.skip:
        a = replaced(a, lines, pairs, keys)
    a = a.withColumn("text", strip_trailing_particle("text"))
    b = Q.correct_cues(a, lines, keys, "cue_ord", "line_ord", second).drop("match_li", "match_score")
    if hard is not None and "hard" not in settings.skip:
        b = J.hard_subtitles(cut(b), hard, lines, keys, [*keys, "cue_ord"])
    b = b.where(~is_interjection("text"))
    if isinstance(video_s, DataFrame):
        long = video_s.select(*keys, F.when(F.col("video_s") > 0, F.col("video_s")).alias("video_s"))
        b = W.extend_last(b.join(long, keys, "left"), keys, ["cue_ord"], "video_s").drop("video_s")
    elif video_s is not None:
        b = W.extend_last(b, keys, ["cue_ord"], video_s)
    return W.resolve_overlaps(b, keys, ["cue_ord"])


def suspicious(cues: DataFrame) -> DataFrame:
    """Cues of three Han characters or more that take more than 0.8 s each."""
    n = F.length(han("text"))
    return cues.withColumn("suspicious", (n >= 3) & ((F.col("end_time") - F.col("start_time")) / n > 0.8))
