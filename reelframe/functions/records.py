"""Predicates and small transformations over records: frames, replacements, arguments, tokens, times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions.text import bound, han, ordered_share


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def frame_has_text(brightness: Column | str, bright_ratio: Column | str, edge_ratio: Column | str, gate: float = 60.0, least: float = 80.0) -> Column:
    """Over measured features: a frame of a mean of at least ``gate`` and above ``least`` with more than 5 % bright pixels or more than 1 % edges; null is no text."""
    return F.coalesce((_c(brightness) >= gate) & (_c(brightness) > least) & ((_c(bright_ratio) > 0.05) | (_c(edge_ratio) > 0.01)), F.lit(False))


def valid_replacement(wrong: Column | str, right: Column | str, script: Column | str) -> Column:
    """P10: whether a replacement is safe, given the whole text of the script.

    One character only for one that the script lacks, by one that it has; wrong at most 9 characters, right at most one longer; the Han text of
    right in the script; an edit distance of at most 1 up to six characters, of 0.75 a character above.
    """
    w, r, s = _c(wrong), _c(right), _c(script)
    hw, hr = han(w), han(r)
    single = (hw != "") & ~F.contains(s, hw) & (F.length(hr) == 1) & F.contains(s, hr)
    longest = F.greatest(F.length(hw), F.length(hr))
    near = F.when((F.length(hw) >= 2) & (F.length(hr) >= 2), F.levenshtein(hw, hr) <= F.when(longest <= 6, F.lit(1.0)).otherwise(longest * 0.75)).otherwise(F.lit(True))
    ok = ((F.length(w) >= 2) | single) & (F.length(w) <= 9) & (F.length(r) <= F.length(w) + 1) & ((hr == "") | F.contains(s, hr)) & near
    return F.coalesce((w != r) & (w != "") & (r != "") & ok, F.lit(False))


def json_argument(x: Column | str) -> Column:
    """A JSON object given as an argument: blank is '{}'; what is no object is an error."""
    t = F.trim(F.coalesce(_c(x), F.lit("")))
    ok = t.rlike(r"(?s)^\{.*\}$") & F.get_json_object(t, "$").isNotNull()
    return F.when(t == "", F.lit("{}")).when(ok, t).otherwise(F.raise_error(F.lit("a JSON object is needed")))


def merged_maps(base: Column | str, override: Column | str) -> Column:
    """A map with the entries of another over it; neither is changed, so that nothing leaks into later calls. Null maps are empty."""
    b, o = _c(base), F.coalesce(_c(override), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    kept = F.map_filter(F.coalesce(b, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, v: ~F.map_contains_key(o, k))
    return F.map_concat(kept, o)


def token_slice(start_s: Column | str, end_s: Column | str, rate: int, n: Column | str) -> Column:
    """The sample bounds of a token, clamped to the audio: struct(lo, hi)."""
    lo = F.greatest(F.lit(0), F.least(F.floor(_c(start_s) * rate).cast("long"), _c(n)))
    hi = F.greatest(lo, F.least(F.floor(_c(end_s) * rate).cast("long"), _c(n)))
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def range_buckets(values: Column | str, n: int) -> Column:
    """Slices of a sorted array whose values fall into successive ranges of ``n``: array of struct(bucket, lo, hi), empty ranges left out."""
    b = F.transform(_c(values), lambda x: F.floor(x / F.lit(n)))
    first = lambda b, k: F.array_position(b, k) - 1
    return bound(b, lambda b: F.transform(F.array_distinct(b), lambda k: F.struct(k.alias("bucket"), first(b, k).alias("lo"), (first(b, k) + F.size(F.filter(b, lambda y: y == k))).alias("hi"))))


def masked_labels(ids: Column | str, prefix: Column | str, pad: int | None) -> Column:
    """Labels of a training example: the prefix and padding count as -100."""
    off = lambda x, i: (i < _c(prefix)) | (x == pad if pad is not None else F.lit(False))
    return F.transform(_c(ids), lambda x, i: F.when(off(x, i), F.lit(-100)).otherwise(x))


def decoded_times(words: Column | str, stamps_ms: Column | str) -> Column:
    """Word i from stamps 2i and 2i+1, in seconds to 3 places."""
    at = lambda ms, i: F.bround(F.element_at(ms, i) / F.lit(1000.0), 3)
    return bound(_c(stamps_ms), lambda ms: F.transform(_c(words), lambda w, i: F.struct(w.alias("text"), at(ms, 2 * i + 1).alias("start_time"), at(ms, 2 * i + 2).alias("end_time"))))


def instrumental(tags: DataFrame) -> DataFrame:
    """Tracks without a voice."""
    return tags.where(F.col("vocal") == "纯音乐")


def broadcast_setting(items: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """One value for all items, or one each; another number of values is an error."""
    n = values.select(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_only")).withColumn("_k", F.lit(1))
    m = items.select(F.count(F.lit(1)).alias("_m")).withColumn("_k", F.lit(1))
    size = n.join(m, "_k").select(F.when((F.col("_n") == 1) | (F.col("_n") == F.col("_m")), F.col("_n")).otherwise(F.raise_error(F.lit("one value or one for each item is needed"))).alias("_n"), "_only", "_k")
    out = items.join(values.select(key, F.col(value).alias("_own")), key, "left").withColumn("_k", F.lit(1)).join(F.broadcast(size), "_k")
    return out.withColumn(value, F.when(F.col("_n") == 1, F.col("_only")).otherwise(F.col("_own"))).drop("_n", "_only", "_own", "_k")


def scored_stems(estimates: DataFrame, truth: DataFrame, mixes: DataFrame, other_from_mix: bool) -> DataFrame:
    """Estimates beside their true stems: track, instrument, reference, estimate; a stem without truth goes. With ``other_from_mix`` the truth of
    'other' is the mix less the vocals."""
    t = truth.select("track", "instrument", F.col("wav").alias("reference"))
    if other_from_mix:
        v = truth.where("instrument = 'vocals'").select("track", F.col("wav").alias("_v"))
        o = mixes.select("track", F.col("wav").alias("_m")).join(v, "track").select("track", F.lit("other").alias("instrument"), F.zip_with("_m", "_v", lambda a, b: a - b).alias("reference"))
        t = t.where("instrument <> 'other'").unionByName(o)
    return estimates.select("track", "instrument", F.col("wav").alias("estimate")).join(t, ["track", "instrument"])


def repeats_hard_subtitle(text: Column | str, hard: Column | str, least: float = 0.6) -> Column:
    """A cue repeats a caption if either holds the other, or each is in the other in order by ``least``."""
    a, b = han(text), _c(hard)
    both = (ordered_share(b, a) >= least) & (ordered_share(a, b) >= least)
    return F.coalesce((a != "") & (F.contains(b, a) | F.contains(a, b) | both), F.lit(False))


def suspicious_pace(text: Column | str, start: Column | str, end: Column | str) -> Column:
    """Three Han characters or more at over 0.8 s each."""
    n = F.length(han(text))
    return F.coalesce((n >= 3) & ((_c(end) - _c(start)) / F.nullif(n, F.lit(0)) > 0.8), F.lit(False))


def nearest_sides(df: DataFrame, keys: list[str], order: list[str], value: str, good: Column) -> DataFrame:
    """W40's fill: before, after: the nearest good values on either side of each row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    v = F.when(good, F.col(value))
    return df.withColumn("before", F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "after", F.first(v, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    )


def timed_cues(cues: DataFrame) -> DataFrame:
    """Cues that last; a duration of 0 or less, or an unknown one, goes."""
    return cues.where(F.col("end_time") - F.col("start_time") > 0)


def target_stem(stems: Column | str, index: Column | str | None) -> Column:
    """Of an array of stems the target only, as an array of one (``index`` from 1); all where no target is set."""
    i = F.lit(None).cast("int") if index is None else _c(index)
    return F.when(i.isNull(), _c(stems)).otherwise(F.slice(_c(stems), F.coalesce(i, F.lit(1)), 1))


def music_url(script_json: Column | str) -> Column:
    """The first address of an mp3 in the field aliyun_url of a script JSON (an object or a list of them); null if there is none or it is broken."""
    one = "struct<aliyun_url:string>"
    items = F.coalesce(F.from_json(_c(script_json), f"array<{one}>"), F.array(F.from_json(_c(script_json), one)))
    return F.get(F.filter(F.transform(items, lambda x: x["aliyun_url"]), lambda u: F.endswith(F.lower(u), F.lit(".mp3"))), 0)


def audio_record(rate_a: Column | str, rate_b: Column | str, rate: Column | str) -> Column:
    """The sampling rate of an audio given as (rate, data), (data, rate) or a record with the field sampling_rate: the first that is there; null for another shape."""
    return F.coalesce(_c(rate), _c(rate_a), _c(rate_b)).cast("int")
