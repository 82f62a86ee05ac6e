"""python -m granary build CONFIG [--resume MODE] [--checkpoint RUN] | verify CONFIG | policy-diff OLD NEW | report OUT_DIR | checkpoints OUT_DIR [--reset RUN]"""

from __future__ import annotations

import argparse
import logging
import os
import sys

RESUME_MODES = ("auto", "beginning", "checkpoint", "ignore")


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="granary", description=__doc__)
    sub = parser.add_subparsers(dest="what", required=True)
    for name, *names in (("build", "config"), ("verify", "config"), ("policy-diff", "old", "new"), ("report", "out_dir"), ("checkpoints", "out_dir")):
        p = sub.add_parser(name)
        for n in names:
            p.add_argument(n)
        if name == "build":
            p.add_argument("--resume", default="auto", choices=RESUME_MODES)
            p.add_argument("--checkpoint", help="the run to go on with, or how its name begins (with --resume checkpoint)")
        elif name == "checkpoints":
            p.add_argument("--reset", help="a run whose progress is forgotten")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    from .plans import config

    if given.what == "policy-diff":
        print(config.render_diff(config.policy_diff(config.load_yaml(given.old), config.load_yaml(given.new))))
        return 0
    if given.what == "verify":
        found = config.problems(config.load_yaml(given.config), os.path.dirname(given.config) or ".")
        print("\n".join(found) or "no problems")
        return int(bool(found))

    from .plans.session import session
    from .sinks import writers

    spark = session("granary")
    if given.what == "build":
        from .plans import pipeline

        cfg = config.parse(config.load_yaml(given.config), os.path.dirname(given.config) or ".")
        print(writers.summary_text(pipeline.run(spark, cfg, resume=given.resume, named=given.checkpoint)))
        return 0
    if given.what == "checkpoints":
        from .plans import ledger

        base = f"{given.out_dir.rstrip('/')}/progress"
        if given.reset:
            print("forgotten" if ledger.Ledger(spark, base, given.reset).reset() else "there is no such run")
        for r in ledger.progress(spark, base):
            print(f"{r['run']}: {r['done']} of {r['units']} units, {r['rows']} rows")
        return 0
    manifest = writers.read_json(spark, f"{given.out_dir}/manifest.json")
    if manifest is None:
        print("there is no manifest", file=sys.stderr)
        return 1
    print(writers.summary_text(manifest))
    return 0


if __name__ == "__main__":
    sys.exit(main())
