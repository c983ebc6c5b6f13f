from usagelake.sources.fixture import SESSION_COLUMNS, TABLES, table, usage_sessions, user_dimension

__all__ = ["SESSION_COLUMNS", "TABLES", "table", "usage_sessions", "user_dimension"]
