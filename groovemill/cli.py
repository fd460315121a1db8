"""Command line of imports: arguments beat environment variables, which beat defaults."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import os
import sys
from collections.abc import Mapping, Sequence

from .errors import EngineError, InvalidArgument, MissingArgument
from .functions.dates import month_window
from .functions.text import ENTITIES, positive_int, schema_name

ENV = "GROOVEMILL_"
TRUE = ("true", "1", "yes", "on")
FALSE = ("false", "0", "no", "off", "")
OPTIONS = {"store": None, "staging": None, "types": ",".join(ENTITIES), "month": None, "chunk_size": "5000", "dumps": None, "namespace": "catalog"}
FLAGS = ("force", "allow_downgrade", "cleanup", "store_references")


def canonical_name(name: str) -> str:
    """Option names match whatever their case, dashes and underscores."""
    plain = name.lstrip("-").replace("-", "").replace("_", "").lower()
    for known in (*OPTIONS, *FLAGS):
        if known.replace("_", "") == plain:
            return known
    raise InvalidArgument(f"unknown option: {name}")


def flag(text: str) -> bool:
    if text.lower() in TRUE:
        return True
    if text.lower() in FALSE:
        return False
    raise InvalidArgument(f"neither true nor false: {text}")


def resolve(args: Sequence[str], env: Mapping[str, str] | None = None) -> argparse.Namespace:
    """The options of --name=value, --name value and --flag arguments over the environment; all problems at once."""
    env = os.environ if env is None else env
    given: dict[str, str] = {}
    problems: list[str] = []
    rest = list(args)
    while rest:
        word = rest.pop(0)
        name, eq, value = word.partition("=")
        try:
            if not word.startswith("-"):
                raise InvalidArgument(f"not an option: {word}")
            key = canonical_name(name)
            if not eq:
                value = rest.pop(0) if key in OPTIONS and rest and not rest[0].startswith("--") else "" if key in OPTIONS else "true"
            if key in given:
                raise InvalidArgument(f"given twice: {name}")
            if key in OPTIONS and not value:
                raise InvalidArgument(f"no value: {name}")
            given[key] = value
        except InvalidArgument as e:
            problems.append(str(e))
    out = {}
    for key, default in (OPTIONS | dict.fromkeys(FLAGS, "false")).items():
        out[key] = given.get(key, env.get(ENV + key.upper(), default))
    checks = {"chunk_size": positive_int, "namespace": schema_name, "types": _types, "month": lambda m: m and _month(m), **dict.fromkeys(FLAGS, flag)}
    for key, check in checks.items():
        try:
            out[key] = check(out[key])
        except ValueError as e:
            problems.append(f"{key}: {e}")
    missing = [k for k in ("store", "dumps") if not out[k]]
    if problems:
        raise InvalidArgument("; ".join(problems))
    if missing:
        raise MissingArgument(f"required: {', '.join(missing)}")
    out["staging"] = out["staging"] or os.path.join(out["store"], "_staging")
    return argparse.Namespace(**out)


def _types(text: str) -> list[str]:
    names = [x.strip().lower() for x in text.split(",") if x.strip()]
    if not names or set(names) - set(ENTITIES):
        raise InvalidArgument(f"not entities: {text}")
    return [e for e in ENTITIES if e in names]


def _month(text: str) -> str:
    try:
        start, _ = month_window(text)
    except ValueError:
        raise InvalidArgument(f"not a month: {text}") from None
    if not dt.date(2008, 3, 1) <= start <= dt.date.today():
        raise InvalidArgument(f"no dumps in {text}")
    return text


def main(args: Sequence[str] | None = None) -> int:
    """Imports `<dumps>/<anything>_YYYYMMDD_<entity>s.xml[.gz]`, the latest of each entity or that of --month. Returns 0, or
    2 after an error of the engine, which is logged."""
    try:
        return run(args)
    except EngineError as e:
        logging.error("%s: %s", type(e).__name__, e)
        return 2


def run(args: Sequence[str] | None = None) -> int:
    from .plans.importer import Importer, Plan
    from .plans.store import Store
    from .session import session
    from .sources.catalog_index import sha256_of

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    options = resolve(sys.argv[1:] if args is None else args)
    found: dict[str, tuple[dt.date, str]] = {}
    for name in sorted(os.listdir(options.dumps)):
        for entity in options.types:
            parts = name.split("_")
            if f"{entity}s.xml" in name and len(parts) > 2 and parts[1].isdigit() and len(parts[1]) == 8:
                day = dt.datetime.strptime(parts[1], "%Y%m%d").date()
                if not options.month or (day >= (w := month_window(options.month))[0] and day < w[1]):
                    found[entity] = max(found.get(entity, (day, "")), (day, os.path.join(options.dumps, name)))
    if set(options.types) - set(found):
        raise MissingArgument(f"no dump of {', '.join(sorted(set(options.types) - set(found)))}")
    spark = session()
    plan = Plan({e: p for e, (_, p) in found.items()}, {e: d for e, (d, _) in found.items()}, {e: sha256_of(p) for e, (_, p) in found.items()}, options.chunk_size, options.force, options.allow_downgrade, "store" if options.store_references else "dump", options.namespace)
    result = Importer(spark, Store(spark, options.store), options.staging).run(plan)
    logging.info(" ".join(f"{k}={v}" for k, v in result.items()))
    if options.cleanup:
        for _, path in found.values():
            os.remove(path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
