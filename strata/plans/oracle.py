"""Independent SQL formulations of the catalog queries, for a DuckDB oracle.

The SQL follows the operators' specification in the set-based form -- left
join + change filter + anti join + UNION ALL for SCD2 -- rather than the
single-pass form the Spark side runs, so agreement checks the rewrite too.
Statements run on DuckDB with the driver tables registered as views.
"""

from __future__ import annotations

from collections.abc import Sequence

from strata.constants import (
    GOLD_MIN,
    HASH_SEPARATOR,
    HASH_VERSION,
    NULL_TOKEN,
    PLATINUM_MIN,
    SILVER_MIN,
    TIER_LABELS,
    TRACKED_COLUMNS,
)
from strata.sources.tables import EVERYTHING, SNAPSHOT_1_END, SNAPSHOT_2_END

SRC = [
    "customer_id",
    "first_name",
    "last_name",
    "email",
    "country",
    "city",
    "customer_segment",
    "revenue_ytd",
    "is_active",
    "updated_at",
]
SILVER = SRC + ["full_name", "revenue_tier"]
SCD = ["effective_from", "effective_to", "is_current", "hash_version"]

USERS = """
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE split_part(c_name, '#', 1) END AS first_name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS country,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_acctbal > 0 END AS is_active
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

STATES = """
SELECT CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE split_part(c_name, '#', 1) END AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       lower(c_mktsegment) || '@ex.com' AS email,
       n_name AS country,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE n_name END AS city,
       c_mktsegment AS customer_segment,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_totalprice END AS revenue_ytd,
       o_orderstatus <> 'F' AS is_active,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate END AS updated_at,
       o_orderdate AS extracted_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def round2(expr: str) -> str:
    """Spark's ``round(x, 2)`` on a double: HALF_UP applied to the value's shortest
    decimal text (``210390.565`` -> ``210390.57``), not to its binary value."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 10)), 2) AS DOUBLE)"


def cols(names: Sequence[str], alias: str | None = None) -> str:
    return ", ".join(f"{alias}.{c}" if alias else c for c in names)


def digest(names: Sequence[str], alias: str | None = None, prefix: str | None = None) -> str:
    parts = [f"'{prefix}'"] if prefix is not None else []
    parts += [
        f"coalesce(CAST({alias + '.' if alias else ''}{c} AS VARCHAR), '{NULL_TOKEN}')" for c in names
    ]
    return f"sha256(concat_ws('{HASH_SEPARATOR}', {', '.join(parts)}))"


def change_hash(alias: str, tracked: Sequence[str] = TRACKED_COLUMNS) -> str:
    return digest(tracked, alias, prefix=str(HASH_VERSION))


def tier(col: str = "revenue_ytd") -> str:
    bounds = (PLATINUM_MIN, GOLD_MIN, SILVER_MIN)
    whens = " ".join(f"WHEN {col} >= {b} THEN '{lbl}'" for b, lbl in zip(bounds, TIER_LABELS))
    return f"CASE {whens} ELSE '{TIER_LABELS[-1]}' END"


def silver(src: str) -> str:
    return (
        f"SELECT {cols(SRC)}, concat_ws(' ', first_name, last_name) AS full_name, "
        f"{tier()} AS revenue_tier FROM {src} "
        "WHERE customer_id IS NOT NULL AND updated_at IS NOT NULL AND is_active"
    )


def latest(src: str, names: Sequence[str], key: str = "customer_id", order: str = "updated_at") -> str:
    return (
        f"SELECT {cols(names)} FROM (SELECT {cols(names)}, row_number() OVER ("
        f"PARTITION BY {key} ORDER BY {order} DESC NULLS LAST, {digest(names)} DESC) AS rn "
        f"FROM {src}) WHERE rn = 1"
    )


def snapshot_filter(n: int) -> str:
    return {
        1: f"extracted_at < TIMESTAMP '{SNAPSHOT_1_END}'",
        2: f"extracted_at < TIMESTAMP '{SNAPSHOT_2_END}'",
        3: f"extracted_at >= TIMESTAMP '{SNAPSHOT_2_END}'",
        EVERYTHING: "true",
    }[n]


class Sql:
    """Accumulates named CTEs and renders ``WITH ... SELECT``."""

    def __init__(self) -> None:
        self.ctes: list[tuple[str, str]] = []

    def add(self, name: str, body: str) -> str:
        for existing, text in self.ctes:
            if existing == name:
                if text != body:
                    raise ValueError(f"CTE {name} defined twice with different bodies")
                return name
        self.ctes.append((name, body))
        return name

    def render(self, final: str) -> str:
        if not self.ctes:
            return final
        return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in self.ctes) + "\n" + final

    # ---- sources --------------------------------------------------------

    def states(self) -> str:
        return self.add("states", STATES)

    def snapshot(self, n: int, validated: bool = True) -> str:
        states = self.states()
        raw = self.add(f"raw{n}", f"SELECT {cols(SRC)} FROM {states} WHERE {snapshot_filter(n)}")
        return self.add(f"snap{n}", silver(raw)) if validated else raw

    def empty_dim(self, src: str, names: Sequence[str]) -> str:
        return self.add(
            f"{src}_e0",
            f"SELECT {cols(names)}, updated_at AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, "
            f"CAST(NULL AS BOOLEAN) AS is_current, CAST(NULL AS INTEGER) AS hash_version FROM {src} WHERE false",
        )

    # ---- SCD2 -------------------------------------------------------------

    def changes(
        self,
        p: str,
        existing: str,
        incoming: str,
        names: Sequence[str],
        *,
        compare: str = "hash",
        absent_close_at: str | None = None,
        late_ignore: bool = False,
    ) -> str:
        """CTE ``{p}_chg`` with the merged current slice plus a ``scd2_change`` label."""
        out = list(names) + SCD
        l_ = self.add(f"{p}_l", latest(incoming, names))
        cur = self.add(f"{p}_cur", f"SELECT {cols(out)} FROM {existing} WHERE is_current")
        if compare == "hash":
            differs = f"{change_hash('l')} <> {change_hash('c')}"
        else:
            differs = " OR ".join(f"l.{c} IS DISTINCT FROM c.{c}" for c in TRACKED_COLUMNS)
        if late_ignore:
            differs = f"({differs}) AND NOT coalesce(l.updated_at <= c.effective_from, false)"
        # the reference formulation: rows that are new or changed
        cn = self.add(
            f"{p}_cn",
            f"SELECT {cols(names, 'l')}, c.customer_id IS NULL AS is_new FROM {l_} l "
            f"LEFT JOIN {cur} c ON l.customer_id = c.customer_id "
            f"WHERE c.customer_id IS NULL OR ({differs})",
        )
        inserted = (
            f"SELECT {cols(names, 'g')}, g.updated_at AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, "
            f"true AS is_current, {HASH_VERSION} AS hash_version, "
            f"CASE WHEN g.is_new THEN 'new' ELSE 'changed' END AS scd2_change FROM {cn} g"
        )
        closed = (
            f"SELECT {cols(names, 'c')}, c.effective_from, g.updated_at AS effective_to, false AS is_current, "
            f"c.hash_version, 'closed' AS scd2_change FROM {cn} g JOIN {cur} c ON g.customer_id = c.customer_id"
        )
        not_changed = f"NOT EXISTS (SELECT 1 FROM {cn} g WHERE g.customer_id = c.customer_id)"
        seen = f"EXISTS (SELECT 1 FROM {l_} s WHERE s.customer_id = c.customer_id)"
        unchanged = f"SELECT {cols(out, 'c')}, 'unchanged' AS scd2_change FROM {cur} c WHERE {not_changed} AND {seen}"
        if absent_close_at is None:
            absent = f"SELECT {cols(out, 'c')}, 'absent' AS scd2_change FROM {cur} c WHERE {not_changed} AND NOT {seen}"
        else:
            absent = (
                f"SELECT {cols(names, 'c')}, c.effective_from, TIMESTAMP '{absent_close_at}' AS effective_to, "
                f"false AS is_current, c.hash_version, 'closed' AS scd2_change FROM {cur} c "
                f"WHERE {not_changed} AND NOT {seen}"
            )
        return self.add(
            f"{p}_chg", "\nUNION ALL ".join([inserted, closed, unchanged, absent])
        )

    def merge(self, p: str, existing: str, incoming: str, names: Sequence[str], **opts) -> str:
        """CTE ``{p}`` = history of ``existing`` + merged current slice."""
        out = list(names) + SCD
        chg = self.changes(p, existing, incoming, names, **opts)
        return self.add(
            p,
            f"SELECT {cols(out)} FROM {existing} WHERE NOT is_current "
            f"UNION ALL SELECT {cols(out)} FROM {chg}",
        )
