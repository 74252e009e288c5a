"""DuckDB oracle text for the spectrogram queries: the same formulas as a relational plan
(unnest frames and taps, DFT as grouped sums, filterbank from edge self-joins)."""

from __future__ import annotations

from ..operators.spectral import MelParams

_MEL_F_SP = "(200.0 / 3.0)"
_MIN_LOG_MEL = "(1000.0 / (200.0 / 3.0))"
_LOGSTEP = "(ln(6.4) / 27.0)"


def _hz_to_mel(x: str) -> str:
    return (f"(case when ({x}) < 1000.0 then ({x}) / {_MEL_F_SP} "
            f"else {_MIN_LOG_MEL} + ln(({x}) / 1000.0) / {_LOGSTEP} end)")


def _mel_to_hz(x: str) -> str:
    return (f"(case when ({x}) < {_MIN_LOG_MEL} then ({x}) * {_MEL_F_SP} "
            f"else 1000.0 * exp({_LOGSTEP} * (({x}) - {_MIN_LOG_MEL})) end)")


def _by_sample(N: int, H: int, K: int) -> list[tuple[str, str]]:
    """pw by way of one table per signal length: the window and basis folded onto the samples
    that the reflected frame reads, then one join per sample (for frames longer than the signals)."""
    w, turn = f"(0.5 - 0.5 * cos(2 * pi() * n / {N}))", f"2 * pi() * ((k * n) % {N}) / {N}"
    return [
        ("basis", f"""select n_samples, t, k, (case when q < n_samples then q else per - q end) as i,
       sum({w} * cos({turn})) as c, sum({w} * sin({turn})) as s
from (select *, ((pos % per) + per) % per as q
      from (select n_samples, t, n, t * {H} + n - {N // 2} as pos, greatest(1, 2 * (n_samples - 1)) as per
            from (select n_samples, t, unnest(range(0, {N})) as n
                  from (select n_samples, unnest(range(0, n_samples // {H} + 1)) as t
                        from (select distinct n_samples from sig))))),
     (select unnest(range(0, {K})) as k) kk
group by 1, 2, 3, 4"""),
        ("pw", """select song_id, sr, t as timeseries, k as bin, pow(sum(x * c), 2) + pow(sum(x * s), 2) as power
from (select song_id, sr, n_samples, unnest(range(0, n_samples)) as i, cast(unnest(samples) as double) as x from sig)
     join basis using (n_samples, i)
group by 1, 2, 3, 4"""),
    ]


def ctes(p: MelParams, upto: str = "db", source: str = "v_signal", prefix: list | None = None,
         by_sample: bool = False) -> str:
    """CTE chain sig, fr, taps, pw, rates, edges, fb, mel, peak, db (stops at ``upto``).
    ``source`` is a relation (song_id, sr, samples); ``prefix`` adds (name, sql) CTEs first;
    ``by_sample`` folds the basis onto the samples instead of listing every tap."""
    N, H, M, K = p.n_fft, p.hop, p.n_mels, p.n_bins
    hi = "sr / 2.0" if p.fmax is None else repr(float(p.fmax))
    parts = [
        *(prefix or []),
        ("sig", "select song_id, sr, samples, cast(len(samples) as bigint) as n_samples "
                f"from {source} where len(samples) > 0"),
        ("fr", f"select song_id, sr, samples, n_samples, unnest(range(0, n_samples // {H} + 1)) as timeseries from sig"),
        ("taps", f"""select song_id, sr, timeseries, n,
       cast(samples[(case when q < n_samples then q else per - q end) + 1] as double) as x
from (select *, ((pos % per) + per) % per as q
      from (select song_id, sr, samples, n_samples, timeseries, n,
                   timeseries * {H} + n - {N // 2} as pos,
                   greatest(1, 2 * (n_samples - 1)) as per
            from (select *, unnest(range(0, {N})) as n from fr)))"""),
        ("pw", f"""select song_id, sr, timeseries, k as bin,
       pow(sum(x * (0.5 - 0.5 * cos(2 * pi() * n / {N})) * cos(2 * pi() * k * n / {N})), 2)
     + pow(sum(x * (0.5 - 0.5 * cos(2 * pi() * n / {N})) * sin(2 * pi() * k * n / {N})), 2) as power
from taps, (select unnest(range(0, {K})) as k) kk
group by song_id, sr, timeseries, k"""),
        ("rates", "select distinct sr from sig"),
        ("edges", f"""select sr, i, {_mel_to_hz('lo + i * (hi - lo) / ' + str(M + 1))} as hz
from (select sr, {_hz_to_mel(repr(float(p.fmin)))} as lo, {_hz_to_mel(hi)} as hi,
             unnest(range(0, {M + 2})) as i from rates)"""),
        ("fb", f"""select e0.sr, e0.i as band, k as bin,
       greatest(0.0, least((k * e0.sr / {N} - e0.hz) / (e1.hz - e0.hz),
                           (e2.hz - k * e0.sr / {N}) / (e2.hz - e1.hz))) * (2.0 / (e2.hz - e0.hz)) as weight
from edges e0 join edges e1 on e1.sr = e0.sr and e1.i = e0.i + 1
     join edges e2 on e2.sr = e0.sr and e2.i = e0.i + 2,
     (select unnest(range(0, {K})) as k) kk
where e0.i < {M}"""),
        ("mel", """select pw.song_id, pw.timeseries, fb.band, sum(pw.power * fb.weight) as mel
from pw join fb on fb.sr = pw.sr and fb.bin = pw.bin
group by pw.song_id, pw.timeseries, fb.band"""),
        ("peak", "select song_id, max(mel) as peak from mel group by song_id"),
    ]
    floor = ("" if p.top_db is None else
             f", 10 * log10(greatest(pk.peak, {p.amin!r})) - 10 * log10(greatest(pk.peak, {p.amin!r})) - {float(p.top_db)!r}")
    db_expr = f"10 * log10(greatest(m.mel, {p.amin!r})) - 10 * log10(greatest(pk.peak, {p.amin!r}))"
    db_expr = f"greatest({db_expr}{floor})" if floor else db_expr
    parts.append(("db", f"""select m.song_id, m.timeseries, m.band, {db_expr} as db
from mel m join peak pk on pk.song_id = m.song_id"""))
    if by_sample:
        at = [n for n, _ in parts].index("fr")
        parts[at:at + 3] = _by_sample(N, H, K)
    names = [n for n, _ in parts]
    parts = parts[: names.index(upto) + 1]
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in parts)
