"""Two-tier extraction: which cheap results are done again, and what the pair costs."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

TRIGGERS = ("anchor_not_found", "span_text_mismatch", "span_out_of_bounds", "error")
ALL_TRIGGERS = (*TRIGGERS, "unsupported_citation")
_ANCHOR_NOTES = ("start_anchor_not_found", "end_anchor_not_found", "anchors_overlap")


@dataclass(frozen=True)
class Route:
    method: str
    cheap: str
    strong: str
    triggers: tuple[str, ...] = TRIGGERS

    def config_sha(self) -> Column:
        """Twelve hex digits that change with anything that changes results."""
        return F.substring(F.sha2(F.lit("|".join(f"{k}={v}" for k, v in sorted(asdict(self).items()))), 256), 1, 12)


def trigger(extraction: Column, flags: Column, said_facts: Column, triggers: tuple[str, ...] = TRIGGERS) -> Column:
    """The first configured reason to escalate, or null.

    ``extraction`` is a struct with facts_span and notes, null if the cheap tier failed;
    ``flags`` are its validation flags; ``said_facts`` is whether the model claimed facts.
    """
    none = F.lit(None).cast("string")
    notes = F.coalesce(extraction["notes"], F.array().cast("array<string>"))
    spanless = extraction["facts_span"].isNull() & F.coalesce(said_facts, extraction["facts_span"].isNotNull())
    lost = spanless & (F.arrays_overlap(notes, F.array(*map(F.lit, _ANCHOR_NOTES))) | ~F.array_contains(notes, "llm_no_facts"))
    found = [F.when(lost, F.lit("anchor_not_found"))] if "anchor_not_found" in triggers else []
    for name in triggers:
        if name not in ("anchor_not_found", "error"):
            found.append(F.when(_flagged(flags, name), F.lit(name)))
    failed = F.lit("error") if "error" in triggers else none
    return F.when(extraction.isNull(), failed).otherwise(F.coalesce(*found, none))


def _flagged(flags: Column, name: str) -> Column:
    return F.coalesce(F.exists(flags, lambda f: (f == name) | f.startswith(f"{name}:")), F.lit(False))


def routed(reason: Column, cheap: Column, strong: Column) -> Column:
    """tier, error, span, notes, cost_usd and latency_s of a routed document.

    Both tiers are structs with span, notes, cost_usd, latency_s and error.  A strong tier
    that fails falls back to the cheap one; both tiers' cost and time are summed when the
    strong result is used.
    """
    cheap_ok, strong_ok = cheap.isNotNull() & cheap["error"].isNull(), strong.isNotNull() & strong["error"].isNull()
    use = reason.isNotNull() & strong_ok
    failed = ~use & ~cheap_ok
    tier = F.when(use, "strong").when(cheap_ok, "cheap")
    spent = cheap["cost_usd"].isNotNull() | strong["cost_usd"].isNotNull()
    both = F.when(spent, F.round(F.coalesce(strong["cost_usd"], F.lit(0.0)) + F.coalesce(cheap["cost_usd"], F.lit(0.0)), 6))
    time = F.round(F.coalesce(strong["latency_s"], F.lit(0.0)) + F.coalesce(cheap["latency_s"], F.lit(0.0)), 3)
    tag = F.concat(F.lit("routed:"), tier, F.when(reason.isNotNull(), F.concat(F.lit(":"), reason)).otherwise(""))
    return F.struct(
        tier.alias("tier"),
        reason.isNotNull().alias("escalated"),
        F.when(failed, F.coalesce(strong["error"], cheap["error"], F.lit("no result"))).alias("error"),
        F.when(use, strong["span"]).when(cheap_ok, cheap["span"]).alias("span"),
        F.when(~failed, F.array_append(F.when(use, strong["notes"]).otherwise(cheap["notes"]), tag)).alias("notes"),
        F.when(use, both).when(cheap_ok, cheap["cost_usd"]).alias("cost_usd"),
        F.when(use, time).when(cheap_ok, cheap["latency_s"]).alias("latency_s"),
    )
