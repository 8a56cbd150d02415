"""Command line: ``python -m weft`` profiles | init | sources | run | <stage>."""

from __future__ import annotations

import argparse
import os
import sys
from pathlib import Path

from weft.plans import profiles
from weft.plans.manifest import STAGES


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weft")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("profiles", help="list languages, base models and compute profiles")
    init = sub.add_parser("init", help="write a project file for a language")
    init.add_argument("language")
    init.add_argument("--base-model", default="qwen2.5-1.5b")
    init.add_argument("--compute", default="consumer_gpu")
    init.add_argument("--out", type=Path)
    sub.add_parser("sources", help="list the sources of a language").add_argument("language")
    for name in ("run", *STAGES):
        one = sub.add_parser(name, help="run the project" if name == "run" else f"run the stage {name}")
        one.add_argument("-c", "--config", type=Path, required=True)
        one.add_argument("--force", action="store_true", help="run again what was run before")
        if name == "run":
            one.add_argument("--from", dest="force_from", choices=STAGES, help="run again from this stage on")
            one.add_argument("--only", nargs="*", choices=STAGES)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "profiles":
        for kind in profiles.KINDS:
            print(f"{kind}: {', '.join(profiles.slugs(kind))}")
    elif args.command == "init":
        out = args.out or Path("projects") / f"{args.language}.yaml"
        if out.exists():
            print(f"{out} is there already", file=sys.stderr)
            return 1
        if args.language not in profiles.slugs("language"):
            print(f"no profile of {args.language} yet; add one before the project is run", file=sys.stderr)
        out.parent.mkdir(parents=True, exist_ok=True)
        out.write_text(profiles.scaffold(args.language, args.base_model, args.compute), encoding="utf-8")
        print(out)
    elif args.command == "sources":
        for s in profiles.language(args.language).sources:
            print(f"{s.connector}\t{s.params.get('license', '?')}\t{s.notes or ''}")
    else:
        return _run(args)
    return 0


def _run(args) -> int:
    from weft.functions import langid
    from weft.plans.project import Run
    from weft.session import session

    project = profiles.load_project(args.config)
    chosen = (args.only or None) if args.command == "run" else [args.command]
    again = getattr(args, "force_from", None) or ((chosen or project.selected)[0] if args.force else None)
    token = os.environ.get("HF_TOKEN") or os.environ.get("HUGGING_FACE_HUB_TOKEN")
    backend = project.clean.lang_id
    model = langid.opened(os.environ.get("WEFT_LANGID_MODEL")) if backend != "none" else None
    run = Run(session(f"weft-{project.name}"), project, token, identifiers={backend: model} if model else {})
    for stage, status in run.stages(chosen, again).items():
        print(f"{stage}\t{status}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
