"""Spectral kernels in Arrow batches: what needs an FFT leaves the JVM, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stft(x: np.ndarray, n: int, hop: int, window: np.ndarray | None = None, pad: str = "reflect") -> np.ndarray:
    """Complex frames (bins, frames), centred; short signals are padded as far as the padding can."""
    half = n // 2
    mode = pad if len(x) > half or pad == "constant" else "constant"
    x = np.pad(np.asarray(x, float), half, mode=mode)
    k = 1 + max(0, len(x) - n) // hop
    frames = np.lib.stride_tricks.sliding_window_view(x, n)[: (k - 1) * hop + 1 : hop] if len(x) >= n else np.zeros((0, n))
    return np.fft.rfft(frames * (1.0 if window is None else window), axis=1).T


def istft(z: np.ndarray, hop: int, length: int, window: np.ndarray) -> np.ndarray:
    """Overlap-add inverse of a centred, windowed STFT."""
    n = 2 * (z.shape[0] - 1)
    frames = np.fft.irfft(z.T, n=n, axis=1) * window
    out, norm = np.zeros(n + hop * (len(frames) - 1)), np.zeros(n + hop * (len(frames) - 1))
    for i, f in enumerate(frames):
        out[i * hop : i * hop + n] += f
        norm[i * hop : i * hop + n] += window**2
    out = np.divide(out, norm, out=out, where=norm > 1e-12)[n // 2 :]
    return np.pad(out, (0, max(0, length - len(out))))[:length]


def hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def l1_freq(reference: np.ndarray, estimate: np.ndarray, n: int = 2048, hop: int = 1024) -> float:
    """100 / (1 + 10 * mean difference of magnitudes), rectangular window."""
    a, b = (np.abs(stft(x, n, hop)) for x in (reference, estimate))
    return float(100 / (1 + 10 * np.abs(a - b).mean())) if a.size else float("nan")


def mel_bank(rate: int, n: int, mels: int) -> np.ndarray:
    """Triangular filters on the Slaney mel scale (linear below 1 kHz, logarithmic above), of equal area."""
    to_mel = lambda f: np.where(f < 1000, f * 3 / 200, 15 + 27 * np.log(np.maximum(f, 1e-9) / 1000) / np.log(6.4))
    to_hz = lambda m: np.where(m < 15, m * 200 / 3, 1000 * np.exp((m - 15) * np.log(6.4) / 27))
    edges = to_hz(np.linspace(0, float(to_mel(np.array(rate / 2))), mels + 2))
    f = np.fft.rfftfreq(n, 1 / rate)
    up = (f[None] - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - f[None]) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def bleed_full(reference: np.ndarray, estimate: np.ndarray, rate: int = 44_100, n: int = 4096, hop: int = 1024, mels: int = 512, top_db: float = 80.0) -> tuple[float, float]:
    """(bleedless, fullness) from the mean positive and negative difference of mel spectra in dB; none counts as 0."""
    bank = mel_bank(rate, n, mels)
    db = []
    for x in (reference, estimate):
        s = 20 * np.log10(np.maximum(bank @ np.abs(stft(x, n, hop, hann(n), "constant")), 1e-10))
        db.append(np.maximum(s, s.max() - top_db))
    d = db[1] - db[0]
    up, down = d[d > 0], d[d < 0]
    return float(100 / ((up.mean() if up.size else 0.0) + 1)), float(100 / (-(down.mean() if down.size else 0.0) + 1))


def fft_ensemble(waves: list[np.ndarray], weights: list[float], how: str, n: int = 2048, hop: int = 1024) -> np.ndarray:
    """A16, X6: 'avg', 'median', 'min' or 'max' (by magnitude, the first on ties) in the spectral domain, brought back to the first wave's length."""
    w = hann(n)
    z = np.array([stft(x, n, hop, w) for x in waves])
    if how == "avg":
        z = np.tensordot(np.asarray(weights, float), z, 1) / np.sum(weights)
    elif how == "median":
        z = np.median(z.real, axis=0) + 1j * np.median(z.imag, axis=0)
    else:
        pick = np.abs(z).argmin(axis=0) if how == "min" else np.abs(z).argmax(axis=0)
        z = np.take_along_axis(z, pick[None], axis=0)[0]
    return istft(z, hop, len(waves[0]), w)


def spectral_metric(pairs: DataFrame, keys: list[str], fn: Callable[[np.ndarray, np.ndarray], float | tuple], name: str | list[str]) -> DataFrame:
    """A21, A23, A27, A22's hook: keys and a metric (or several, by their names) of the array columns reference and estimate, cut to the shorter; null where either is empty."""
    names = [name] if isinstance(name, str) else name

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for a, b in zip(pdf["reference"], pdf["estimate"]):
                n = min(len(a), len(b))
                got = fn(np.asarray(a[:n], float), np.asarray(b[:n], float)) if n else float("nan")
                out.append(got if isinstance(got, tuple) else (got,) * len(names))
            yield pdf[keys].assign(**{x: [float(r[i]) for r in out] for i, x in enumerate(names)})

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*keys).schema)
    return pairs.select(*keys, "reference", "estimate").where("reference IS NOT NULL AND estimate IS NOT NULL").mapInPandas(run, f"{ddl}, " + ", ".join(f"{x} double" for x in names))


def demix(mix: np.ndarray, model: Callable[[np.ndarray], np.ndarray], chunk: int, overlap: int) -> np.ndarray:
    """Chunks of a wave through a model, windowed and added up over the sum of the windows.

    Border = chunk - chunk/overlap samples are reflected on either side where the wave is long enough. The first chunk has no fade-in
    and the last no fade-out, whatever the batch: the result does not depend on how chunks are batched.
    """
    step, fade = chunk // overlap, chunk // 10
    border, n = chunk - step, len(mix)
    reflect = n > 2 * border > 0
    x = np.pad(mix, border, mode="reflect") if reflect else np.asarray(mix, float)
    window = np.ones(chunk)
    if fade:
        window[-fade:] = np.linspace(1, 0, fade)
        window[:fade] = np.linspace(0, 1, fade)
    out, norm = np.zeros(len(x)), np.zeros(len(x))
    starts = list(range(0, len(x), step))
    for s in starts:
        part = x[s : s + chunk]
        k = len(part)
        tail = chunk - k
        padded = np.pad(part, (0, tail), mode="reflect" if k > chunk // 2 and tail < k else "constant")
        w = window.copy()
        if s == 0:
            w[:fade] = 1
        if s == starts[-1] and fade:
            w[-fade:] = 1
        out[s : s + k] += model(padded)[:k] * w[:k]
        norm[s : s + k] += w[:k]
    out = np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)
    return out[border:-border] if reflect else out


def tta(x: np.ndarray, model: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Mean of the model on (channels, time) as it is, with channels swapped and with the sign turned, each turned back."""
    return (model(x) + model(x[::-1])[::-1] - model(-x)) / 3


def spec_rmse(reference: np.ndarray, estimate: np.ndarray, n: int = 4096, hop: int = 1024, normalised: bool = True) -> float:
    """Root of the mean squared difference of complex spectra, rectangular window; real and imaginary parts count one by one, ``normalised`` divides by sqrt(n)."""
    z = stft(reference, n, hop) - stft(estimate, n, hop)
    return float(np.sqrt((z.real**2 + z.imag**2).mean() / 2 / (n if normalised else 1))) if z.size else float("nan")


def ensemble_spectra(waves: DataFrame, keys: list[str], wav: str, weight: str, source: str, how: str, n: int = 2048, hop: int = 1024) -> DataFrame:
    """A16, X6 on tables: keys, wav: one wave per entity from those of its sources, in the spectral domain. A group is the sources of one entity, a handful; null waves are left out."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(source, kind="stable")
        got = fft_ensemble([np.asarray(x, float) for x in pdf[wav]], pdf[weight].tolist(), how, n, hop)
        return pdf[keys].iloc[:1].assign(**{wav: [got]})

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in waves.select(*keys).schema)
    return waves.where(F.col(wav).isNotNull()).select(*keys, wav, weight, source).groupBy(*keys).applyInPandas(run, f"{ddl}, `{wav}` array<double>")


def mapped_waves(waves: DataFrame, keys: list[str], wav: str, fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """W41, H36 on tables: keys, wav: a function of each wave (demix, tta), row by row in Arrow batches. Null waves stay null."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.assign(**{wav: [None if x is None else np.asarray(fn(np.asarray(x, float))).ravel() for x in pdf[wav]]})

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in waves.select(*keys).schema)
    return waves.select(*keys, wav).mapInPandas(run, f"{ddl}, `{wav}` array<double>")
