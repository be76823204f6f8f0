"""Command line over the stages.

An input path may be a pattern: the most recently changed match is taken. Exit codes: 2 for bad configuration or missing input, 3 when the site turned the pages away, 1 for
other failures.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from .sources.config import Config, ConfigError, load

#: command: (arguments, tables that its configuration must have)
COMMANDS: dict[str, tuple[list[str], tuple[str, ...]]] = {
    "land": (["pages", "out"], ()),
    "scrape": (["site", "out"], ("search",)),
    "import": (["capture", "out"], ("search",)),
    "urls": (["site"], ("search",)),
    "normalize": (["records", "out"], ()),
    "screen": (["postings", "out"], ()),
    "diff": (["screened", "store", "out"], ()),
    "render-shortlist": (["shortlist", "page"], ()),
    "rollup": (["records", "out"], ("search", "home")),
    "filter": (["companies", "out"], ()),
    "render-companies": (["companies", "page"], ()),
    "scrape-report": (["records", "meta"], ()),
    "key-report": (["records"], ()),
    "funnel": (["records"], ()),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="winnowkit")
    p.add_argument("--format", choices=("json", "text"), default="json", help="what is printed at the end: the sidecar, or a summary to read")
    sub = p.add_subparsers(dest="command", required=True)
    for name, (args, need) in COMMANDS.items():
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a)
        s.add_argument("--config", required=bool(need))
        if name in ("diff", "filter", "render-shortlist"):
            s.add_argument("--visit-log")
        if name == "diff":
            s.add_argument("--dry-run", action="store_true")
        if name == "normalize":
            s.add_argument("--similarity", type=float)
        if name == "screen":
            s.add_argument("--comp-floor", type=int)
        if name == "render-shortlist":
            s.add_argument("--band", action="append")
        if name in ("land", "import", "scrape"):
            s.add_argument("--no-compress", action="store_true")
        if name in ("land", "scrape"):
            s.add_argument("--max-pages", type=int)
        if name == "import":
            s.add_argument("--previous-runs")
    return p


def run(spark, a: argparse.Namespace, config: Config) -> dict | list | int:
    from dataclasses import replace

    from .plans import diagnostics, stages
    from .sources import fetch, jsonl

    for name in ("pages", "capture", "records", "postings", "screened", "shortlist", "companies", "meta"):
        if "*" in (given := getattr(a, name, None) or ""):
            setattr(a, name, jsonl.newest(spark, given))
    log = getattr(a, "visit_log", None) or (str(config.visit_log) if config.visit_log else None)
    compress = config.compress and not getattr(a, "no_compress", False)
    if a.command == "land":
        pages = diagnostics.landed_pages(spark, a.pages)
        return stages.land(spark, pages, a.out, compress, a.max_pages or config.max_pages)
    if a.command == "scrape":
        found, most = config.searches(), a.max_pages or config.max_pages
        received = fetch.fetch(spark, [s.state for s in found], base_url=a.site, max_pages=most, pause=config.delay_seconds)
        return stages.land(spark, received, a.out, compress, most, [s.name for s in found])
    if a.command == "import":
        return stages.import_capture(spark, a.capture, config.searches(), a.out, compress, a.previous_runs)
    if a.command == "normalize":
        return stages.normalize(spark, a.records, a.out, a.similarity)
    if a.command == "screen":
        return stages.screen(spark, a.postings, a.out, config if a.comp_floor is None else replace(config, comp_floor=a.comp_floor))
    if a.command == "diff":
        return stages.diff(spark, a.screened, a.store, a.out, f"{datetime.now():%Y-%m-%d}", log, a.dry_run)
    if a.command == "rollup":
        return stages.company_rollup(spark, a.records, a.out, config)
    if a.command == "filter":
        if log is None:
            raise ConfigError("no visit log: set [visit_logger].export_path or give --visit-log")
        return stages.company_filter(spark, a.companies, log, a.out)
    if a.command == "render-companies":
        return stages.render_companies(spark, a.companies, a.page)
    if a.command == "render-shortlist":
        return stages.render_shortlist(spark, a.shortlist, a.page, visit_log=log, bands=tuple(a.band or ("strong", "possible")))
    if a.command == "scrape-report":
        return diagnostics.scrape_report(spark, a.records, a.meta)
    if a.command == "key-report":
        return diagnostics.key_report(spark, a.records)
    return diagnostics.funnel_report(spark, a.records, config)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        config = load(a.config, COMMANDS[a.command][1]) if a.config else Config()
        if a.command == "urls":
            from .plans.stages import search_links

            for kind, name, url in search_links(config, a.site):
                print(f"{kind} {name}: {url}")
            return 0
    except ConfigError as e:
        print(e, file=sys.stderr)
        return 2
    from pyspark.errors import AnalysisException, PySparkException
    from pyspark.sql import SparkSession

    from .plans import summaries
    from .sources.captures import BadCapture
    from .sources.pages import Blocked
    from .sources.visitlog import BadVisitLog

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        told = run(spark, a, config)
    except Blocked as e:
        print(f"{e}: capture the searches in a browser and import them", file=sys.stderr)
        return 3
    except (AnalysisException, FileNotFoundError, ConfigError, BadCapture, BadVisitLog) as e:
        print(e, file=sys.stderr)
        return 2
    except (ValueError, PySparkException) as e:
        print(e, file=sys.stderr)
        return 1
    print("\n".join(summaries.lines(a.command, told)) if a.format == "text" else json.dumps(told, indent=2, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
