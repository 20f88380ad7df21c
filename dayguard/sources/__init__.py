from dayguard.sources.tables import read_table, Inputs

__all__ = ["read_table", "Inputs"]
