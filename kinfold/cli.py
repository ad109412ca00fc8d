"""Command line: python -m kinfold.cli --input PATH --output PATH [options]."""

from __future__ import annotations

import argparse
import json
from dataclasses import fields

from kinfold.options import Options
from kinfold.plans.engine import run

#: Options whose flag is not simply their name.
FLAGS = {
    "input_format": "--format",
    "input_delimiter": "--delimiter",
    "skip_leading_columns": "--skip-leading-columns",
    "min_cluster_cohesion": "--cohesion",
    "dbscan_eps": "--eps",
    "dbscan_min_samples": "--min-samples",
    "output_format": "--output-format",
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="kinfold", description="Group records that describe the same thing, without a schema.")
    out.add_argument("--input", required=True)
    out.add_argument("--output", required=True)
    out.add_argument("--has-header", dest="input_has_header", action="store_true", default=None)
    out.add_argument("--no-metrics", dest="metrics_enabled", action="store_false", default=None)
    out.add_argument("--arcs-no-merge", dest="arcs_do_merge", action="store_false", default=None)
    for stage in fields(Options):
        for field in fields(type(getattr(Options(), stage.name))):
            if field.name in ("input_has_header", "metrics_enabled"):
                continue
            value = getattr(getattr(Options(), stage.name), field.name)
            flag = FLAGS.get(field.name, "--" + field.name.replace("_", "-"))
            if isinstance(value, bool):
                out.add_argument(flag, dest=field.name, action=argparse.BooleanOptionalAction, default=None)
            elif isinstance(value, tuple):
                kind = int if field.name.endswith("edges") else str
                out.add_argument(flag, dest=field.name, nargs="*", type=kind, default=None)
            else:
                out.add_argument(flag, dest=field.name, type=type(value), default=None)
    return out


def options_of(arguments: argparse.Namespace) -> Options:
    given = {k: tuple(v) if isinstance(v, list) else v for k, v in vars(arguments).items() if k not in ("input", "output") and v is not None}
    return Options().with_overrides(**given)


def main(argv: list[str] | None = None) -> int:
    arguments = parser().parse_args(argv)
    print(json.dumps(run(arguments.input, arguments.output, options_of(arguments)), indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
