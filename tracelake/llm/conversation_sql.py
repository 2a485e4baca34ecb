"""DuckDB SQL for the repair of conversations: the plain dynamic programme.

A recursive query goes through every conversation from its end and carries, for
each of the four grammar states, the cost to go, the audit and the repaired lines.
"""

from __future__ import annotations

from tracelake.llm.conversations import AFTER, DELETE, INSERT, REROLE, ROLES, TRUNCATED, WRITES

NEVER = 1 << 40


def _option(cost: str, letter: str, line: str | None, at: str) -> str:
    lines = f"{at}.lines" if line is None else f"list_prepend({line}, {at}.lines)"
    return f"{{'cost': {cost}, 'audit': '{letter}' || {at}.audit, 'lines': {lines}}}"


def _own(state: int) -> str:
    """The best of deleting, keeping and giving another role, in a state."""
    writes = WRITES[state]
    written = f"best[{AFTER[writes][state] + 1}]"
    options = [
        _option(f"best[{state + 1}].cost + {DELETE}", "D", None, f"best[{state + 1}]"),
        _option(f"CASE WHEN gone THEN {NEVER} ELSE {written}.cost + {REROLE} + extra END", "R",
                f"'{ROLES[writes]}:' || text", written),
    ]
    for initial, after in AFTER.items():
        if after[state] is not None:
            kept = f"best[{after[state] + 1}]"
            options.append(_option(
                f"CASE WHEN gone OR initial <> '{initial}' THEN {NEVER} ELSE {kept}.cost + extra END",
                "K", "role || ':' || text", kept,
            ))
    return f"list_sort([{', '.join(options)}])[1]"


def _inserted(state: int) -> str:
    writes = WRITES[state]
    at = f"best[{AFTER[writes][state] + 1}]"
    other = _option(f"{at}.cost + {INSERT}", "I", f"'{ROLES[writes]}:'", at)
    return f"list_sort([own[{state + 1}], {other}])[1]"


_OWN = ", ".join(map(_own, range(4)))
_INSERTED = ", ".join(map(_inserted, range(4)))
_NO_LINES = "CAST([] AS VARCHAR[])"

REPAIR_SQL = rf"""
    WITH RECURSIVE crc_table AS (
        SELECT list(c ORDER BY byte) AS crcs FROM (
            SELECT byte, list_reduce(list_prepend(byte, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM range(256) AS r(byte))
    ), named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
        FROM conversations
    ), hashed AS (
        SELECT * EXCLUDE (name, crcs), xor(4294967295, list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT),
                list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)]))) % 20 AS kind
        FROM named, crc_table
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM hashed, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS r(copy)
    ), faulted AS (
        SELECT *, left(role, 1) AS initial,
            regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_char,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS seen
        FROM damaged
    ), ordered AS (
        SELECT *,
            row_number() OVER (PARTITION BY conv_id
                ORDER BY turn DESC NULLS LAST, role DESC, sha256(text) DESC, seen DESC) AS k,
            lag(initial) OVER (PARTITION BY conv_id
                ORDER BY turn NULLS FIRST, role, sha256(text), seen) || initial AS pair
        FROM faulted
    ), flagged AS (
        SELECT *, last_char = '' AS blank, last_char <> '' AND seen AS duplicate,
            last_char <> '' AND NOT seen AND last_char NOT IN ('.', '!', '?') AS truncated
        FROM ordered
    ), symbols AS (
        SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS conv, k, role, text, initial,
            blank OR duplicate AS gone, CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END AS extra
        FROM flagged
    ), rest AS (
        SELECT DISTINCT coalesce(CAST(conv_id AS VARCHAR), '') AS conv, CAST(0 AS BIGINT) AS k, [
            {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': {_NO_LINES}}},
            {{'cost': CAST({2 * INSERT} AS BIGINT), 'audit': 'II', 'lines': ['user:', 'assistant:']}},
            {{'cost': CAST({INSERT} AS BIGINT), 'audit': 'I', 'lines': ['assistant:']}},
            {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': {_NO_LINES}}}] AS best
        FROM conversations
        UNION ALL
        SELECT conv, k, [{_INSERTED}] AS best FROM (
            SELECT conv, k, own, [{_INSERTED}] AS best FROM (
                SELECT conv, k, own, own AS best FROM (
                    SELECT s.conv, s.k, [{_OWN}] AS own
                    FROM rest JOIN symbols s ON s.conv = rest.conv AND s.k = rest.k + 1)))
    ), counts AS (
        SELECT conv_id,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
            count(*) FILTER (truncated) AS truncated,
            count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM flagged GROUP BY conv_id
    ), heads AS (
        SELECT conv, arg_max(best, k)[1] AS head FROM rest GROUP BY conv
    )
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
        coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, head.cost AS cost, head.audit AS audit,
        sha256(array_to_string(head.lines, chr(10))) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN counts ON c.conv_id IS NOT DISTINCT FROM counts.conv_id
    JOIN heads ON heads.conv = coalesce(CAST(c.conv_id AS VARCHAR), '')
"""
