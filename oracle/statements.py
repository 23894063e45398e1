"""All statements by query name."""

from oracle import analysis, etl, numbered, planning

STATEMENTS: dict[str, str] = {**numbered.SQL, **analysis.SQL, **planning.SQL, **etl.statements()}
