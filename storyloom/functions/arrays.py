"""Ordered sets, tallies and latest-wins lists over arrays: as column expressions, and as plain functions for folds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_domain(domain: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.lower(domain)), F.lit("")), F.lit("(unknown)"))


def plain_domain(domain: str | None) -> str:
    return (domain or "").strip().lower() or "(unknown)"


def union(a: Column | str, b: str | Column, most: int | None = None) -> Column:
    """Set union in order of first appearance, blanks dropped, the first `most` kept."""
    none = F.array().cast("array<string>")
    out = F.filter(F.array_distinct(F.concat(F.coalesce(F.col(a) if isinstance(a, str) else a, none), F.coalesce(F.col(b) if isinstance(b, str) else b, none))), lambda x: F.coalesce(x, F.lit("")) != "")
    return out if most is None else F.slice(out, 1, most)


def ordered_union(a: list[str], b: list[str], most: int | None = None) -> list[str]:
    return [x for x in dict.fromkeys([*a, *b]) if x][:most]


def merged_entities(old: Column, new: Column, most: int) -> Column:
    """Two tallies (text, type, count; a missing count is 1) by lower-cased text: counts add, the first spelling and type stay.

    Order: count, largest first, then key; blank texts go.  Work is quadratic in the two lists, which are bounded.
    """
    both = F.filter(F.concat(old, new), lambda e: F.trim(F.coalesce(e["text"], F.lit(""))) != "")
    keys = F.array_distinct(F.transform(both, lambda e: F.lower(e["text"])))

    def one(k: Column) -> Column:
        own = F.filter(both, lambda e: F.lower(e["text"]) == k)
        n = F.aggregate(own, F.lit(0).cast("bigint"), lambda s, e: s + F.coalesce(e["count"], F.lit(1)).cast("bigint"))
        return F.struct((-n).alias("o"), k.alias("k"), F.get(own, F.lit(0))["text"].alias("text"), F.get(own, F.lit(0))["type"].alias("type"), n.alias("count"))

    ranked = F.slice(F.array_sort(F.transform(keys, one)), 1, most)
    return F.transform(ranked, lambda x: F.struct(x["text"].alias("text"), x["type"].alias("type"), x["count"].alias("count")))


def tally(old: list, new: list, most: int) -> list[dict]:
    """merged_entities for folds."""
    seen: dict[str, dict] = {}
    for e in [*old, *new]:
        text = e["text"]
        if not (text or "").strip():
            continue
        n = e["count"] if "count" in (e.keys() if isinstance(e, dict) else e.__fields__) else None
        at = seen.setdefault(text.lower(), {"text": text, "type": e["type"], "count": 0})
        at["count"] += 1 if n is None else int(n)
    return [v for _, v in sorted(seen.items(), key=lambda kv: (-kv[1]["count"], kv[0]))][:most]


def merged_images(old: Column, new: Column, most: int) -> Column:
    """Hashes (h, d), each once where it stands last; the newest `most`, oldest first."""
    both = F.concat(old, new)
    places = F.transform(both, lambda e, i: F.struct(e.alias("e"), i.alias("i")))
    last = F.filter(places, lambda p: ~F.exists(places, lambda q: (q["e"]["h"] == p["e"]["h"]) & (q["i"] > p["i"])))
    kept = F.transform(last, lambda p: p["e"])
    return F.slice(kept, F.greatest(F.size(kept) - most + 1, F.lit(1)), most)


def latest(old: list, new: list, most: int) -> list[dict]:
    """merged_images for folds."""
    seen: dict[int, dict] = {}
    for e in [*old, *new]:
        seen.pop(e["h"], None)
        seen[e["h"]] = {"h": int(e["h"]), "d": e["d"]}
    return list(seen.values())[-most:]


def list_in_order(order: Column, value: Column) -> Column:
    """All values of a group in the given order."""
    return F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])
