"""Fixed values shared with the systems we read from: small lookup tables,
word lists, patterns and limits.  No logic lives here."""
