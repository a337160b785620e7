"""Writing landed tables, reports and result documents."""
