"""Table sources: adapters over the driver tables, domain-table readers, the organisation
hash loader, and sinks."""
