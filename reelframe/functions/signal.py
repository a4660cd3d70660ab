"""Signal functions over array<double> columns; short arrays stay in the JVM, spectra go through Arrow (operators.spectra)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelframe.functions.text import bound

EPS = 1e-8
SAMPLE_RATE = 16_000


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def doubles(x: Column | str) -> Column:
    return F.transform(_c(x), lambda v: v.cast("double"))


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def energy(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)


def shorter(a: Column, b: Column) -> tuple[Column, Column]:
    """Both cut to the shorter."""
    n = F.least(F.size(a), F.size(b))
    return F.slice(a, 1, n), F.slice(b, 1, n)


def sdr(reference: Column, estimate: Column) -> Column:
    """Signal to distortion in dB."""
    r, e = shorter(reference, estimate)
    err = energy(F.zip_with(r, e, lambda x, y: x - y))
    return 10 * F.log10((energy(r) + EPS) / (err + EPS))


def si_sdr(reference: Column, estimate: Column) -> Column:
    """The same, free of scale; the small constant counts once an element in the scale, then inside and outside the ratio."""
    r, e = shorter(reference, estimate)
    pad = EPS * F.size(r)
    scale = (total(F.zip_with(r, e, lambda x, y: x * y)) + pad) / (energy(r) + pad)
    pairs = F.zip_with(r, e, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    sums = F.aggregate(
        pairs,
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("d"), scale.alias("k")),
        lambda a, p: F.struct(
            (a["s"] + (p["x"] * a["k"]) * (p["x"] * a["k"])).alias("s"), (a["d"] + (p["x"] * a["k"] - p["y"]) * (p["x"] * a["k"] - p["y"])).alias("d"), a["k"].alias("k")
        ),
    )
    return 10 * F.log10(sums["s"] / (sums["d"] + EPS) + EPS)


def mse(a: Column, b: Column) -> Column:
    """Mean squared error."""
    return energy(F.zip_with(a, b, lambda x, y: x - y)) / F.size(a)


def l1(a: Column, b: Column) -> Column:
    """Mean absolute error."""
    return total(F.zip_with(a, b, lambda x, y: F.abs(x - y))) / F.size(a)


def rms_db(x: Column) -> Column:
    """Level in dB."""
    return 20 * F.log10(F.sqrt(energy(x) / F.size(x)) + 1e-9)


def peak_db(x: Column) -> Column:
    """Peak in dB; null for silence."""
    return 20 * F.log10(F.nullif(F.array_max(F.transform(x, F.abs)), F.lit(0.0)))


def mean(x: Column) -> Column:
    return total(x) / F.nullif(F.size(x), F.lit(0))


def std(x: Column, ddof: int = 0) -> Column:
    """Population (0) or sample (1) standard deviation."""
    m = mean(x)
    squares = F.aggregate(x, F.struct(F.lit(0.0).alias("s"), m.alias("m")), lambda a, v: F.struct((a["s"] + (v - a["m"]) * (v - a["m"])).alias("s"), a["m"].alias("m")))["s"]
    return F.sqrt(squares / F.nullif(F.size(x) - ddof, F.lit(0)))


def standardised(x: Column, ddof: int = 0) -> Column:
    """Less the mean, over the deviation; unchanged where that is 0."""
    known = lambda x: F.struct(x.alias("x"), mean(x).alias("m"), std(x, ddof).alias("s"))
    return bound(x, lambda x: bound(known(x), lambda k: F.when(k["s"] > 0, F.transform(k["x"], lambda v: (v - k["m"]) / k["s"])).otherwise(k["x"])))


def peak_normalised(x: Column) -> Column:
    """Scaled down to a peak of 1 only if it is above, then clipped."""
    known = lambda x: F.struct(x.alias("x"), F.array_max(F.transform(x, F.abs)).alias("peak"))
    scaled = lambda k: F.transform(k["x"], lambda v: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.when(k["peak"] > 1, v / k["peak"]).otherwise(v))))
    return bound(x, lambda x: bound(known(x), scaled))


def from_int16(x: Column) -> Column:
    """16-bit samples to [-1, 1)."""
    return F.transform(x, lambda v: v / 32768.0)


def to_mono(left: Column, right: Column) -> Column:
    """The mean of two channels."""
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def mixed(a: Column, b: Column) -> Column:
    """Sum of two tracks."""
    return F.zip_with(a, b, lambda x, y: x + y)


def residual(mix: Column, part: Column) -> Column:
    """The mix less one part."""
    return F.zip_with(mix, part, lambda x, y: x - y)


def gained(x: Column, gain: float) -> Column:
    """Loudness scale; -1 turns the polarity."""
    return F.transform(x, lambda v: v * gain)


def channels_flipped(channels: Column) -> Column:
    """An array of channels with the channels turned."""
    return F.reverse(channels)


def time_reversed(channels: Column) -> Column:
    """An array of channels, each played backwards."""
    return F.transform(channels, F.reverse)


def mean_brightness(r: Column, g: Column, b: Column) -> Column:
    """The mean grey value of pixels (arrays of 0 to 255): each pixel's 0.299 r + 0.587 g + 0.114 b, rounded; null for none."""
    grey = F.zip_with(F.zip_with(r, g, lambda x, y: x * 0.299 + y * 0.587), b, lambda x, y: F.floor(x + y * 0.114 + 0.5))
    return mean(grey)


def weighted_loss(terms: dict[str, float], reference: Column, estimate: Column) -> Column:
    """The sum of the chosen terms (names of METRICS) by their coefficients."""
    return reduce(Column.__add__, [metric(name, reference, estimate) * w for name, w in terms.items()])


def volume_for(mean_db: Column | str, target_db: float = -34.0, least: float = 0.05, most: float = 0.40, unknown: float = 0.20) -> Column:
    """The linear volume that brings a mean loudness to the target."""
    v = F.pow(F.lit(10.0), (F.lit(target_db) - _c(mean_db)) / 20.0)
    return F.when(v.isNull(), F.lit(unknown)).otherwise(F.bround(F.greatest(F.lit(least), F.least(F.lit(most), v)), 3))


def fade_window(size: int, fade: int) -> Column:
    """Ones with a linear fade of ``fade`` samples at either end."""
    last = max(fade - 1, 1)
    up = lambda i: i.cast("double") / last
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i < fade, up(i)).when(i >= size - fade, up(F.lit(size - 1) - i)).otherwise(F.lit(1.0)))


def fixed_chunk(x: Column, offset: int, size: int) -> Column:
    """``size`` samples from ``offset``, zeros after the end."""
    return bound(F.slice(x, offset + 1, size), lambda part: F.concat(part, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(part))))


def is_loud(x: Column, least: float) -> Column:
    """Mean absolute value of at least ``least``."""
    return total(F.transform(x, F.abs)) / F.size(x) >= least


def linear_resample(x: Column, rate: int, to: int = SAMPLE_RATE) -> Column:
    """Linear resampling at the new rate's times; the last sample holds."""

    def resampled(x: Column) -> Column:
        n = F.floor(F.size(x) * F.lit(to) / F.lit(rate)).cast("int")
        last = F.size(x) - 1

        def at(i: Column) -> Column:
            p = F.least(i.cast("double") * rate / to, last.cast("double"))
            lo = F.floor(p).cast("int")
            a, b = F.element_at(x, lo + 1), F.element_at(x, F.least(lo + 1, last) + 1)
            return a + (b - a) * (p - lo)

        return F.when((F.size(x) == 0) | (n == 0), F.array().cast("array<double>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), at))

    return bound(x, resampled)


def stem_format(x: Column) -> Column:
    """A stem whose peak is within 1 is written as 16-bit FLAC, else as float WAV."""
    return F.when(F.array_max(F.transform(x, F.abs)) <= 1, "flac:PCM_16").otherwise("wav:FLOAT")


def feature_length(n: Column | str) -> Column:
    """Frames of the audio encoder for n input frames (whole hundreds give 13 each); floors as Python does."""
    n = _c(n).cast("long")
    fdiv = lambda a, b: F.floor(a / F.lit(b)).cast("long")
    rest = F.pmod(n, F.lit(100))
    feat = fdiv(rest - 1, 2) + 1
    return fdiv(fdiv(feat - 1, 2) + 1 - 1, 2) + 1 + fdiv(n, 100) * 13


def rgb_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of struct(r, g, b); 0 where a colour is missing."""
    d = F.sqrt(F.pow(a["r"] - b["r"], 2) + F.pow(a["g"] - b["g"], 2) + F.pow(a["b"] - b["b"], 2))
    return F.coalesce(d, F.lit(0.0))


def hsv(r: Column, g: Column, b: Column) -> Column:
    """0-255 to struct(h 0-360, s 0-1, v 0-1)."""
    x, y, z = (c / 255.0 for c in (r, g, b))
    top, low = F.greatest(x, y, z), F.least(x, y, z)
    span = top - low
    sixth = F.when(x == top, (y - z) / span).when(y == top, 2.0 + (z - x) / span).otherwise(4.0 + (x - y) / span)
    h = F.when(span == 0, 0.0).otherwise(F.pmod(sixth / 6.0, F.lit(1.0)) * 360.0)
    return F.struct(h.alias("h"), F.when(span == 0, 0.0).otherwise(span / top).alias("s"), top.alias("v"))


def colour_labels(r: Column, g: Column, b: Column) -> Column:
    """Warmth and brightness of an average colour."""
    c = hsv(r, g, b)
    warmth = (
        F.when(c["s"] < 0.12, "中性色调").when((c["h"] < 60) | (c["h"] > 300), "暖色调").when(c["h"].between(150, 270), "冷色调").when(c["h"] < 150, "偏绿冷调").otherwise("中性色调")
    )
    return F.struct(warmth.alias("warmth"), F.when(c["v"] > 0.65, "画面偏亮").when(c["v"] < 0.30, "画面较暗").otherwise("亮度正常").alias("brightness"))


#: Metrics by name.
METRICS = {"sdr": sdr, "si_sdr": si_sdr, "mse": mse, "l1": l1}


def metric(name: str, reference: Column, estimate: Column) -> Column:
    if name not in METRICS:
        raise ValueError(f"unknown metric {name}; known: {sorted(METRICS)}")
    return METRICS[name](reference, estimate)
