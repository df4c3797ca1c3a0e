"""Named query plans over the driver tables, and their SQL oracles."""
