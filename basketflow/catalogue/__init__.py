"""The registered queries: the driver's tables mapped to retail tables, and what runs on them."""
