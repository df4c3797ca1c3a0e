"""User-level DataFrame operators (all declarative; Catalyst plans them)."""
