"""Markdown reports of small result tables; numbers are formatted on the driver."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame

#: Rows of a report, at most; reports show aggregates, and a longer table is an error.
MOST_ROWS = 10_000
_PERCENT = ("rate", "agreement", "share", "precision", "recall")
_MONEY = ("cost_usd",)


def cell(name: str, value: Any) -> str:
    """A value as text: a dash for null, percent for rates, dollars for costs."""
    if value is None:
        return "—"
    if isinstance(value, bool):
        return "yes" if value else "no"
    if isinstance(value, float):
        if any(name.endswith(p) or f"_{p}_" in name for p in _PERCENT):
            return f"{100 * value:.1f} %"
        return f"${value:.4f}" if any(m in name for m in _MONEY) else f"{value:.4f}"
    return str(value).replace("|", "\\|").replace("\n", " ")


def collected(df: DataFrame) -> list[dict[str, Any]]:
    rows = [r.asDict() for r in df.limit(MOST_ROWS + 1).collect()]
    if len(rows) > MOST_ROWS:
        raise ValueError(f"a report table has more than {MOST_ROWS} rows; aggregate it first")
    return rows


def table(rows: Iterable[dict[str, Any]], columns: Sequence[str] | None = None) -> str:
    rows = list(rows)
    columns = list(columns or (rows[0] if rows else ()))
    if not columns:
        return "(nothing)"
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(c, r.get(c)) for c in columns) + " |" for r in rows])


def report(title: str, sections: dict[str, DataFrame], order: dict[str, list[str]] | None = None) -> str:
    """A title and one table per section, sorted by the section's columns in ``order`` or by all."""
    parts = [f"# {title}"]
    for name, df in sections.items():
        keys = (order or {}).get(name)
        rows = collected(df)
        rows.sort(key=lambda r: [(r[k] is None, str(r[k]) if not isinstance(r[k], int | float) else "", r[k] if isinstance(r[k], int | float) else 0) for k in keys or list(r)])
        parts += [f"## {name}", table(rows, df.columns)]
    return "\n\n".join(parts) + "\n"


def dashboard(summary: DataFrame, history: DataFrame | None = None, flags: DataFrame | None = None) -> str:
    sections = {"Requests": summary} | ({"Flags": flags} if flags is not None else {}) | ({"Runs": history} if history is not None else {})
    return report("Requests and runs", sections)


def gate_report(checks: DataFrame, compared: bool = True) -> tuple[str, bool]:
    """The report and whether every check passed; with nothing to compare with, it fails."""
    rows = sorted(collected(checks), key=lambda r: (r["method"], r["metric"]))
    ok = compared and all(r["ok"] for r in rows)
    return f"# Gate: {'pass' if ok else 'FAIL'}\n\n{table(rows)}\n", ok


def retrieval_report(metrics: DataFrame, errors: DataFrame | None = None) -> str:
    sections = {"Metrics": metrics} | ({"Hit positions": errors} if errors is not None else {})
    return report("Retrieval", sections, {"Metrics": ["stratum", "value", "k"]} if "stratum" in metrics.columns else None)


def error_report(positions: DataFrame, misses: DataFrame | None = None, by_stratum: DataFrame | None = None) -> str:
    """Where rankings hit, which targets they miss, and misses by stratum."""
    sections = {"Hit positions": positions} | ({"Missed targets": misses} if misses is not None else {}) | ({"By stratum": by_stratum} if by_stratum is not None else {})
    return report("Retrieval errors", sections)


def comparison_report(pairs: DataFrame, dominance: DataFrame | None = None) -> str:
    """Models side by side and whether one beats popularity."""
    return report("Model comparison", {"Pairs": pairs} | ({"Against popularity": dominance} if dominance is not None else {}))


def cost_report(counts: dict[str, int], cost_usd: float, hit_rate: float | None = None) -> str:
    """What a build asked of services: counts, their share of the total, the cache's hit rate and the cost."""
    total = sum(counts.values())
    rows: list[dict[str, Any]] = [{"item": name, "n": n, "share": n / total if total else None} for name, n in counts.items()]
    facts = [{"cache_hit_rate": hit_rate, "cost_usd": float(cost_usd), "cost_usd_per_item": cost_usd / total if total else None}]
    return f"# Cost\n\n{table(rows)}\n\n{table(facts)}\n"


def downstream_report(means: DataFrame, pairs: DataFrame, targets: DataFrame | None = None, builders: DataFrame | None = None) -> str:
    """Retrieval by method, paired with the first one, resolved targets and query builders."""
    sections = {"Methods": means, "Pairs": pairs}
    sections |= {"Targets": targets} if targets is not None else {}
    return report("Downstream", sections | ({"Query builders": builders} if builders is not None else {}))


def extraction_report(summaries: DataFrame, strata: dict[str, DataFrame], agreements: DataFrame | None = None, comparisons: DataFrame | None = None) -> str:
    """Summaries of the methods, by stratum, their agreement and their wins over the first."""
    sections = {"Methods": summaries} | {f"By {name}": df for name, df in strata.items()}
    sections |= {"Agreement": agreements} if agreements is not None else {}
    return report("Extraction", sections | ({"Against the first method": comparisons} if comparisons is not None else {}))


def judge_report(summary: DataFrame, disagreements: DataFrame | None = None) -> str:
    return report("Verdicts", {"Counts": summary} | ({"Disagreements": disagreements} if disagreements is not None else {}), {"Counts": ["measure", "source", "value"]})


def gold_report(stats: DataFrame) -> str:
    return report("Gold records", {"Counts": stats}, {"Counts": ["measure", "value"]})


def results_page(title: str, parts: dict[str, str]) -> str:
    """Several reports on one page: their headings one level down, a list of them first."""
    links = "\n".join(f"- {name}" for name in parts)
    bodies = (f"## {name}\n\n" + "\n".join(f"#{line}" if line.startswith("#") else line for line in text.split("\n")[1:]).strip() for name, text in parts.items())
    return f"# {title}\n\n{links}\n\n" + "\n\n".join(bodies) + "\n"


def document_summary(row: dict[str, Any]) -> str:
    """One extracted document in a few lines."""
    made = row.get("extraction") or {}
    span = made.get("facts_span") or {}
    rows = [
        {"field": "error", "value": row.get("error")},
        {"field": "facts", "value": f"{span['start']} to {span['end']}" if span else None},
        {"field": "confidence", "value": made.get("confidence")},
        {"field": "valid", "value": row.get("validation_ok")},
        {"field": "flags", "value": ", ".join(row.get("flags") or []) or None},
        {"field": "case citations", "value": len(made.get("case_citations") or [])},
        {"field": "notes", "value": ", ".join(made.get("notes") or []) or None},
    ]
    return f"# {row.get('doc_id')}\n\n{table(rows)}\n"
