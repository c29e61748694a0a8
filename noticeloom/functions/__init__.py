"""Column expressions on text, dates and page markup."""
