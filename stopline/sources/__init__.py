"""Reading feeds, archives, landed files and result documents."""
