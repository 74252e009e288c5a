"""Mel scale, Hann window and filterbank weights, as Spark Column expressions and as numpy.

The Column forms keep the parameter maths JVM-side (used by the filterbank dimension and
the higher-order-function kernel); the numpy forms feed the Arrow kernel. Both follow the
same published formulas (Slaney mel scale, area-normalised triangles).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Slaney mel scale (linear below 1 kHz, logarithmic above).
MEL_F_SP = 200.0 / 3.0          # Hz per mel in the linear part
MEL_MIN_LOG_HZ = 1000.0          # start of the log part, Hz
MEL_MIN_LOG_MEL = MEL_MIN_LOG_HZ / MEL_F_SP   # = 15 mel
MEL_LOGSTEP = math.log(6.4) / 27.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def hz_to_mel(hz) -> Column:
    hz = _c(hz)
    return F.when(hz < MEL_MIN_LOG_HZ, hz / MEL_F_SP).otherwise(
        F.lit(MEL_MIN_LOG_MEL) + F.log(hz / MEL_MIN_LOG_HZ) / MEL_LOGSTEP)


def mel_to_hz(mel) -> Column:
    mel = _c(mel)
    return F.when(mel < MEL_MIN_LOG_MEL, mel * MEL_F_SP).otherwise(
        F.lit(MEL_MIN_LOG_HZ) * F.exp(F.lit(MEL_LOGSTEP) * (mel - MEL_MIN_LOG_MEL)))


def mel_edges(sr, n_mels: int, fmin: float, fmax: float | None) -> Column:
    """array<double> of the n_mels + 2 band edges in Hz, evenly spaced in mel."""
    sr = _c(sr)
    hi = sr.cast("double") / 2.0 if fmax is None else F.lit(float(fmax))
    lo_m = hz_to_mel(F.lit(float(fmin)))
    hi_m = hz_to_mel(hi)
    return F.transform(F.sequence(F.lit(0), F.lit(n_mels + 1)),
                       lambda i: mel_to_hz(lo_m + i * (hi_m - lo_m) / (n_mels + 1)))


def tri_weight(edges: Column, m, k, sr, n_fft: int) -> Column:
    """Weight of FFT bin k in mel band m, given the edge array (0-based m, k)."""
    e0 = F.element_at(edges, _c(m) + 1)
    e1 = F.element_at(edges, _c(m) + 2)
    e2 = F.element_at(edges, _c(m) + 3)
    g = _c(k).cast("double") * _c(sr).cast("double") / float(n_fft)
    lower = (g - e0) / (e1 - e0)
    upper = (e2 - g) / (e2 - e1)
    return F.greatest(F.lit(0.0), F.least(lower, upper)) * (F.lit(2.0) / (e2 - e0))


# ---- numpy forms (Arrow kernel) ----

def np_hz_to_mel(hz):
    hz = np.asarray(hz, dtype=np.float64)
    lin = hz / MEL_F_SP
    with np.errstate(divide="ignore"):
        log = MEL_MIN_LOG_MEL + np.log(np.maximum(hz, 1e-300) / MEL_MIN_LOG_HZ) / MEL_LOGSTEP
    return np.where(hz < MEL_MIN_LOG_HZ, lin, log)


def np_mel_to_hz(mel):
    mel = np.asarray(mel, dtype=np.float64)
    return np.where(mel < MEL_MIN_LOG_MEL, mel * MEL_F_SP,
                    MEL_MIN_LOG_HZ * np.exp(MEL_LOGSTEP * (mel - MEL_MIN_LOG_MEL)))


def np_filterbank(sr: int, n_fft: int, n_mels: int, fmin: float, fmax: float | None) -> np.ndarray:
    """(n_mels, n_fft // 2 + 1) weight matrix."""
    hi = sr / 2.0 if fmax is None else float(fmax)
    lo_m, hi_m = np_hz_to_mel(fmin), np_hz_to_mel(hi)
    idx = np.arange(n_mels + 2, dtype=np.float64)
    edges = np_mel_to_hz(lo_m + idx * (hi_m - lo_m) / (n_mels + 1))
    g = np.arange(n_fft // 2 + 1, dtype=np.float64) * sr / n_fft
    e0, e1, e2 = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    lower = (g[None, :] - e0) / (e1 - e0)
    upper = (e2 - g[None, :]) / (e2 - e1)
    return np.maximum(0.0, np.minimum(lower, upper)) * (2.0 / (e2 - e0))


def np_hann(n_fft: int) -> np.ndarray:
    """Periodic Hann window of length n_fft."""
    n = np.arange(n_fft, dtype=np.float64)
    return 0.5 - 0.5 * np.cos(2.0 * np.pi * n / n_fft)
