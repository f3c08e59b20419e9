"""Command line for spark-submit: one sub-command per pipeline stage.

    python -m txnscore ingest  --csv raw.csv --log LOG [--id-col ID] [--rejects PATH]
    python -m txnscore drain   --log LOG --landed LANDED
    python -m txnscore prepare --landed LANDED --out PREPARED [--reference-order] [--balance-mode poisson]
    python -m txnscore train   --prepared PREPARED --model MODEL --runs RUNS
    python -m txnscore score   --model MODEL --input LANDED --out SCORES
    python -m txnscore score-requests --model MODEL --input REQUESTS --out SCORES
    python -m txnscore score-stream --model MODEL --log LOG --out SCORES --counts COUNTS

A log is a folder of message files, or a Kafka topic: ``--format kafka
--option kafka.bootstrap.servers=... --option topic=...`` (``--option`` may be
repeated, for example maxOffsetsPerTrigger). A stream's checkpoint lies beside
its output (``<out>_checkpoint``) unless ``--checkpoint`` names one, so the next
run goes on where this one stopped. Gates raise (non-zero exit) when a check fails.
"""

from __future__ import annotations

import argparse
import sys

from .session import get_spark


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="txnscore")
    sub = p.add_subparsers(dest="cmd", required=True)

    def command(name: str, *required: str, log: bool = False) -> argparse.ArgumentParser:
        a = sub.add_parser(name)
        for r in required:
            a.add_argument(f"--{r}", required=True)
        if log:
            a.add_argument("--log")
            a.add_argument("--format", default="parquet")
            a.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
        return a

    a = command("ingest", "csv", log=True)
    a.add_argument("--id-col")
    a.add_argument("--rejects")
    a = command("drain", "landed", log=True)
    a.add_argument("--checkpoint")
    a.add_argument("--dedupe-within")
    a.add_argument("--max-files-per-trigger", type=int)
    a = command("prepare", "landed", "out")
    a.add_argument("--relative-error", type=float, default=0.001)
    a.add_argument("--balance-mode", choices=["exact", "poisson"], default="exact")
    a.add_argument("--reference-order", action="store_true")
    command("train", "prepared", "model", "runs")
    command("score", "model", "input", "out")
    a = command("score-requests", "model", "input", "out")
    a.add_argument("--id-col", default="request_id")
    a = command("score-stream", "model", "out", "counts", log=True)
    a.add_argument("--checkpoint")
    a.add_argument("--max-files-per-trigger", type=int)
    a.add_argument("--continuous", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    from .plans import jobs as J
    from .sources.files import read_dataset

    args = _parser().parse_args(argv)
    spark = get_spark(app_name=f"txnscore-{args.cmd}")
    log = {}
    if "option" in args:
        log = {"fmt": args.format, "options": dict(o.split("=", 1) for o in args.option)}
    if args.cmd == "ingest":
        J.ingest(spark, args.csv, args.log, id_col=args.id_col, rejects_path=args.rejects,
                 **log).show(truncate=False)
    elif args.cmd == "drain":
        J.drain_log(spark, args.log, args.landed, args.checkpoint, args.dedupe_within,
                    max_files_per_trigger=args.max_files_per_trigger, **log).show(truncate=False)
    elif args.cmd == "prepare":
        prep = J.prepare(spark, args.landed, args.out, args.relative_error, args.balance_mode,
                         args.reference_order)
        print(prep.counts)
    elif args.cmd == "train":
        J.train_and_log(spark, J.load_prepared(spark, args.prepared), args.model, args.runs)
        spark.read.parquet(args.runs).show(truncate=False)
    elif args.cmd == "score":
        J.score_table(spark, args.model, read_dataset(spark, args.input), args.out).show()
    elif args.cmd == "score-requests":
        J.score_request_table(spark, args.model, read_dataset(spark, args.input), args.out,
                              args.id_col).show()
    elif args.cmd == "score-stream":
        J.score_stream(spark, args.model, args.log, args.out, args.counts, args.checkpoint,
                       available_now=not args.continuous,
                       max_files_per_trigger=args.max_files_per_trigger, **log).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
