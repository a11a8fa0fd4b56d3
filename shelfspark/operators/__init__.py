"""The reporting jobs (J1-J12), one module per family."""
