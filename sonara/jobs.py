"""Command-line jobs (``spark-submit -m``-style entry points).

  python -m sonara.jobs ingest  --input <folder> --output <folder> [--batch-files N] [--n-fft ...]
  python -m sonara.jobs stream  --input <folder> --catalog <folder> --checkpoint <folder>
  python -m sonara.jobs pages   --input <folder> --catalog <folder> --place <folder> [--page-keys N] [--depth N]

``ingest`` lists the input folder, numbers the accepted keys, and writes the catalog,
samples and spectrogram tables under ``--output`` (one write per table per batch of files).
``stream`` catalogues files as they arrive (each file once, ids continuing after the stored
maximum); ``pages`` does so from a listing in pages that keeps its position. All take the cluster's session as configured (``spark.checkpoint.dir`` included).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import ingest as I
from .operators.spectral import JOB_PARAMS, MelParams


def _params(a) -> MelParams:
    return MelParams(n_fft=a.n_fft, hop=a.hop, n_mels=a.n_mels, fmin=a.fmin,
                     fmax=None if a.fmax <= 0 else a.fmax, pad_mode=a.pad_mode,
                     frames_per_chunk=a.frames_per_chunk)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="sonara.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="folder of audio objects -> catalog, audio, spec tables")
    ing.add_argument("--input", required=True)
    ing.add_argument("--output", required=True, help="folder of the tables")
    for t in ("catalog", "audio", "spec"):
        ing.add_argument(f"--{t}-output", help=f"another place for the {t} table")
    ing.add_argument("--batch-files", type=int, default=100_000, help="files per batch (bounded id map)")
    ing.add_argument("--all-keys", action="store_true", help="number every key, not only known extensions")
    ing.add_argument("--n-fft", type=int, default=JOB_PARAMS.n_fft)
    ing.add_argument("--hop", type=int, default=JOB_PARAMS.hop)
    ing.add_argument("--n-mels", type=int, default=JOB_PARAMS.n_mels)
    ing.add_argument("--fmin", type=float, default=JOB_PARAMS.fmin)
    ing.add_argument("--fmax", type=float, default=JOB_PARAMS.fmax or 0.0, help="0: half the sample rate")
    ing.add_argument("--pad-mode", default=JOB_PARAMS.pad_mode, choices=["reflect", "constant"])
    ing.add_argument("--frames-per-chunk", type=int, default=JOB_PARAMS.frames_per_chunk)
    st = sub.add_parser("stream", help="catalogue new files as they arrive")
    st.add_argument("--input", required=True)
    st.add_argument("--catalog", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--max-files-per-trigger", type=int, default=10_000)
    pg = sub.add_parser("pages", help="catalogue new files from a paged listing")
    pg.add_argument("--input", required=True)
    pg.add_argument("--catalog", required=True)
    pg.add_argument("--place", required=True, help="folder that keeps the listing's position")
    pg.add_argument("--page-keys", type=int, default=100_000, help="keys of a page (of each prefix)")
    pg.add_argument("--depth", type=int, default=1, help="levels of folders that are listed apart")
    pg.add_argument("--later-keys-only", action="store_true", help="a second listing goes on behind the first one's last keys")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"sonara-{a.cmd}").getOrCreate()
    if a.cmd == "ingest":
        n = I.ingest_batches(spark, a.input, {t: getattr(a, f"{t}_output") or f"{a.output}/{t}" for t in ("catalog", "audio", "spec")}, a.batch_files, _params(a), known_only=not a.all_keys)
        print(f"ingested {n} batch(es) into {a.output}")
    elif a.cmd == "pages":
        from .streaming.ingest import ingest_pages
        ingest_pages(spark, a.input, a.catalog, a.place, a.page_keys, a.depth, a.later_keys_only)
    else:
        from .streaming.ingest import ingest_stream
        ingest_stream(spark, a.input, a.catalog, a.checkpoint, a.max_files_per_trigger)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
