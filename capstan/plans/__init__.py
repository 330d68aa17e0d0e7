"""Query catalogue: inputs derived from the driver tables, the Spark plans,
and the equivalent SQL used as an oracle."""
