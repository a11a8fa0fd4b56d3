"""Named query plans (each a Spark job plus its SQL oracle) and plan inspection helpers."""
