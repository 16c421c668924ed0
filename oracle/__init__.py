"""Independent SQL for the registered queries, written against the star-schema sample for DuckDB.

Amounts come out as DOUBLE (through DECIMAL(28,6)), dates, times and flags as text, integers as BIGINT.
"""

from __future__ import annotations

from oracle import closures, misc, odd, sales


def statements() -> dict[str, str]:
    return {**sales.STATEMENTS, **closures.STATEMENTS, **misc.STATEMENTS, **odd.STATEMENTS}
