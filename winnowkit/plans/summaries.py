"""What a stage did, as lines for the console. They are made from the stage's sidecar alone."""

from __future__ import annotations

from typing import Any


def _counts(counts: dict[str, Any], indent: str = "  ") -> list[str]:
    """Names and numbers in two columns, in the order given."""
    wide = max((len(str(k)) for k in counts), default=0)
    return [f"{indent}{k!s:{wide}}  {n:>8,}" if isinstance(n, int) else f"{indent}{k!s:{wide}}  {n}" for k, n in counts.items()]


def _most_first(counts: dict[str, int]) -> dict[str, int]:
    return dict(sorted(counts.items(), key=lambda x: (-x[1], str(x[0]))))


def _runs(m: dict) -> list[str]:
    out = [f"{m['records']:,} records over {m['pages_fetched']:,} pages, {m['unique_records']:,} with a key", f"stopped: {m['stop_reason']}"]
    for s in m["searches"]:
        out.append(f"{s['name']}: {s['pages_fetched']} pages, {s['stop_reason']}")
        out += [f"  reported {k} = {v:g}" for k, v in sorted(s.get("reported_totals", {}).items())]
        if s["stop_reason"].startswith("reached max_pages"):
            out.append("  warning: the page limit cut this search short, so its last records are missing")
        if len(s.get("build_ids", [])) > 1:
            out.append(f"  the site changed during the search: builds {', '.join(s['build_ids'])}")
    out += [f"left out, not configured: {s}" for s in m.get("skipped", [])] + [f"warning: {w}" for w in m.get("warnings", [])]
    if not m["records"]:
        out.append("warning: no records, so no records file was written")
    return out


def _normalize(m: dict) -> list[str]:
    how = "given" if m["overridden"] else f"calibrated on {m['calibrated_on']} groups"
    out = [f"{m['postings']:,} listings are {m['survivors']:,} postings", f"similarity to merge at: {m['threshold']:.2f}, {how}"]
    out += _counts({k: m[k] for k in ("merged_groups", "duplicates", "cluster_key_share", "implausible_pay", "blank_requirements")})
    if m["postings"] and not m["cluster_key_share"]:
        out.append("warning: no listing has the vendor's key, so nothing was calibrated on it")
    return out


def _screen(m: dict) -> list[str]:
    total = max(m["screened"], 1)
    out = [f"{m['screened']:,} postings screened"] + [f"  {b:8}  {m[b]:>8,}  {100 * m[b] / total:5.1f} %" for b in ("strong", "possible", "rejected")]
    out.append(f"near misses: {m['near_misses']:,}")
    for title, name in (("rejected for (one posting may have several)", "reject_reasons"), ("rejected for this alone", "sole_reasons"), ("demoted for", "demote_reasons")):
        if m[name]:
            out += [f"{title}:", *_counts(_most_first(m[name]))]
    if m["screened"] and not m["strong"] + m["possible"]:
        out.append("warning: every posting was rejected")
    return out


def _diff(m: dict) -> list[str]:
    out = [f"{m['new'] + m['promoted']:,} postings on the shortlist", *_counts({k: m[k] for k in ("new", "promoted", "suppressed")}), *_counts(_most_first(m["bands"]))]
    out.append(f"store: {m['store_entries_before']:,} entries before, {m['store_entries_after']:,} after")
    if "opened" in m:
        out += ["from the visit log:", *_counts({k: m[k] for k in ("opened", "applied", "company_applied")})]
    if m["dry_run"]:
        out.append("dry run: the store stays as it was")
    return out


def _rollup(m: dict) -> list[str]:
    out = [f"{m['companies']:,} companies with a website, {m['tail_companies']:,} without", *_counts({"without a distance": m["companies_without_distance"], "ambiguous": m["ambiguous"]})]
    for title, name in (("careers pages", "tiers"), ("dropped for", "dropped")):
        if m[name]:
            out += [f"{title}:", *_counts(_most_first(m[name]))]
    return out


def _filter(m: dict) -> list[str]:
    out = [f"{m['kept']:,} of {m['companies']:,} companies remain; {m['passthrough_no_website']:,} without a website pass through"]
    out += [f"{m['excluded']:,} excluded as visited, {m['excluded_applied']:,} of them applied to", "visit log:", *_counts(_most_first(m["log"]))]
    out += [f"  excluded: {x['key']}" + (" (applied)" if x["applied"] else "") for x in m["excluded_sample"]]
    if m["companies"] and m["kept"] == m["companies"]:
        out.append("warning: the log excludes nothing; is it the right one?")
    return out


_KINDS = {"land": _runs, "scrape": _runs, "import": _runs, "normalize": _normalize, "screen": _screen, "diff": _diff, "rollup": _rollup, "filter": _filter}


def _tree(x: Any, indent: str = "") -> list[str]:
    """Any report: names and values, what is inside them further in."""
    if isinstance(x, dict):
        flat = {k: v for k, v in x.items() if not isinstance(v, (dict, list))}
        deep = {k: v for k, v in x.items() if k not in flat}
        return _counts(flat, indent) + [line for k, v in deep.items() for line in (f"{indent}{k}:", *_tree(v, indent + "  "))]
    return [line for y in x for line in _tree(y, indent)] if isinstance(x, list) else [f"{indent}{x}"]


def lines(command: str, told: dict | list | int) -> list[str]:
    """The summary of a command's result; reports are shown whole, pages by their number of rows."""
    if isinstance(told, int):
        return [f"{told:,} rows"]
    return _KINDS[command](told) if command in _KINDS and isinstance(told, dict) else _tree(told)
