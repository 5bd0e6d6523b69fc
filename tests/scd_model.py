"""Brute-force Python model of the SCD2 merge in its set-based form:

latest incoming per key -> left join with current rows -> keep new or changed
-> close the matched current rows, insert the new ones, carry the other
current rows (anti join on key) and the history. Used to check the
single-pass Spark merge on small random inputs.
"""

from __future__ import annotations

import hashlib

SEP, NULL = "||", "__NULL__"


def text(v) -> str:
    if v is None:
        return NULL
    if isinstance(v, bool):
        return "true" if v else "false"
    if hasattr(v, "strftime"):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    return str(v)


def digest(values) -> str:
    return hashlib.sha256(SEP.join(text(v) for v in values).encode()).hexdigest()


def latest(rows: list[dict], key: str, order: str, cols: list[str]) -> list[dict]:
    best: dict = {}
    for r in rows:
        rank = (r[order] is not None, r[order] or 0, digest([r[c] for c in cols]))
        k = r[key]
        if k not in best or rank > best[k][0]:
            best[k] = (rank, r)
    return [r for _, r in best.values()]


def merge(
    state: list[dict],
    incoming: list[dict],
    key: str,
    order: str,
    src: list[str],
    tracked: list[str],
    compare: str = "hash",
    late_ignore: bool = False,
    absent_close_at=None,
) -> list[dict]:
    lat = latest(incoming, key, order, src)
    cur = [r for r in state if r["is_current"] is True]
    hist = [r for r in state if r["is_current"] is False]

    def differs(n, c):
        if compare == "hash":
            d = digest(["1"] + [n[t] for t in tracked]) != digest(["1"] + [c[t] for t in tracked])
        else:
            d = any(n[t] != c[t] for t in tracked)
        if late_ignore and n[order] is not None and c["effective_from"] is not None:
            d = d and not (n[order] <= c["effective_from"])
        return d

    changed = []
    for n in lat:
        matches = [c for c in cur if n[key] is not None and c[key] == n[key]]
        if not matches:
            changed.append((n, None))
        for c in matches:
            if differs(n, c):
                changed.append((n, c))
    changed_keys = {n[key] for n, _ in changed if n[key] is not None}
    seen_keys = {n[key] for n in lat if n[key] is not None}
    unchanged = [c for c in cur if c[key] is None or c[key] not in changed_keys]
    if absent_close_at is not None:
        unchanged = [
            c if (c[key] is not None and c[key] in seen_keys) else dict(c, effective_to=absent_close_at, is_current=False)
            for c in unchanged
        ]
    closed = [dict(c, effective_to=n[order], is_current=False) for n, c in changed if c is not None]
    inserted = [
        dict({s: n[s] for s in src}, effective_from=n[order], effective_to=None, is_current=True, hash_version=1)
        for n, _ in changed
    ]
    return hist + unchanged + closed + inserted
