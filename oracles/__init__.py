"""SQL counterparts of the named queries, for DuckDB over the raw tables."""

from oracles import chain, labels, members, reports, wide

ORACLES: dict[str, str] = {**wide.O, **reports.O, **members.O, **labels.O, **chain.O}
