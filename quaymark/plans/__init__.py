"""Migration plans and the registered queries."""
