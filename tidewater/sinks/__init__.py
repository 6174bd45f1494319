"""Writers: files, routed files, JSON lines for a bulk loader, keyed tables and cell tables."""
