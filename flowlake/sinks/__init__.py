"""Writers: idempotent batch appends, fan-out, table layout."""
