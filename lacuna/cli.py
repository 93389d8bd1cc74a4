"""The command line: python -m lacuna.cli [--config FILE] COMMAND ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession, functions as F

from lacuna import config
from lacuna.functions import text as T


def doctor(spark, cfg, models, args) -> int:
    from lacuna.plans import workflow

    ok = spark.range(1).select(T.version_at_least(F.lit(spark.version), F.lit("4.0"))).first()[0]
    print(f"Spark {spark.version}: {'ok' if ok else 'at least 4.0 is needed'}")
    for name in ("raw_audio_dir", "clip_dir"):
        print(f"{name} {getattr(cfg.paths, name)}: {'found' if workflow.manifest.exists(spark, getattr(cfg.paths, name)) else 'missing'}")
    return 0 if ok else 1


def _counted(name: str):
    def command(spark, cfg, models, args) -> int:
        from lacuna.plans import workflow

        options = {"limit": args.limit} if hasattr(args, "limit") else {}
        print(f"{name}: {getattr(workflow, name)(spark, cfg, models, force=args.force, **options).count()} rows")
        return 0

    return command


def transcribe(spark, cfg, models, args) -> int:
    from lacuna.plans import workflow

    print(f"transcribed {workflow.transcribe(spark, cfg, models, args.overwrite).count()} recordings")
    return 0


def build_manifest(spark, cfg, models, args) -> int:
    from lacuna.plans import workflow

    rows = workflow.tagged_rows(spark, cfg) if args.tagged or cfg.paths.manifest else workflow.all_rows(spark, cfg, tagged=False)
    print(f"{rows.count()} rows")
    return 0


def filter_(spark, cfg, models, args) -> int:
    from lacuna.plans import workflow

    judged = workflow.filter_rows(spark, cfg, models, args.force)
    n, kept = judged.agg(F.count("*"), F.count_if("kept")).first()
    print(f"{kept} of {n} rows stay")
    for r in judged.where("NOT kept").orderBy("id").select("id", "reasons").toLocalIterator():
        print(f"  {r.id}: {'; '.join(r.reasons)}")
    return 0


def unpack_clips(spark, cfg, models, args) -> int:
    from lacuna.sources import corpus

    if corpus.whole(spark, cfg.paths.clip_dir, args.expected):
        print("the clips are there")
        return 0
    n, bad = corpus.unpack(spark, args.archives, cfg.paths.clip_dir).agg(F.sum("n"), F.count("error")).first()
    print(f"{n or 0} clips, {bad} archives with errors")
    return 0 if not bad and corpus.whole(spark, cfg.paths.clip_dir, args.expected) else 1


def export(spark, cfg, models, args) -> int:
    from lacuna.plans import workflow

    n = workflow.export(spark, cfg, args.out).count()
    print(f"{n} rows")
    return 0 if n else 1


def inspect(spark, cfg, models, args) -> int:
    from lacuna.plans import workflow

    for r in workflow.inspect(spark, cfg, args.limit).collect():
        print(f"{r.transcript}\n  {r.nv_tag} ({r.vs_class}) at {r.splice_at_s:.2f} s ({r.insert_stage}); similarity {r.sim_converted:.3f}, before {r.sim_raw_baseline:.3f}\n  {r.source_audio}\n  {r.para_audio}")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lacuna", description=__doc__)
    p.add_argument("--config", help="a YAML file of settings")
    commands = p.add_subparsers(dest="command", required=True)

    def add(name, run, *flags, limit=False):
        c = commands.add_parser(name)
        for flag in flags:
            c.add_argument(flag, action="store_true", dest="force" if (name, flag) == ("tag-transcripts", "--overwrite") else None)
        if limit:
            c.add_argument("--limit", type=int, default=None if limit is True else limit)
        c.set_defaults(run=run)
        return c

    add("doctor", doctor)
    add("transcribe", transcribe, "--overwrite")
    add("slots", _counted("slots"), "--force", limit=True)
    add("tag-transcripts", _counted("tag"), "--overwrite", limit=True)
    add("build-manifest", build_manifest, "--tagged")
    add("export", export).add_argument("--out")
    for name in ("align", "synth", "run"):
        add(name, _counted(name), "--force", limit=True)
    unpack = add("unpack-clips", unpack_clips)
    unpack.add_argument("archives")
    unpack.add_argument("--expected", type=int, default=1)
    add("filter", filter_, "--force")
    add("inspect", inspect, limit=5)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None, models=None) -> int:
    from lacuna.plans.workflow import Models

    args = parser().parse_args(argv)
    config.read_env(".env")
    spark = spark or SparkSession.builder.appName("lacuna").getOrCreate()
    return args.run(spark, config.load(args.config), models or Models(), args)


if __name__ == "__main__":
    sys.exit(main())
