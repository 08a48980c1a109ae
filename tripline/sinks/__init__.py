"""Writers: fact table, rollup tables, messages, dead letters."""
