"""Reading entities from files and deriving them from a star schema."""
