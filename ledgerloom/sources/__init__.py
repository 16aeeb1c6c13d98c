"""Readers and writers: landed JSON, raw archive, reports, registry, warehouse, calendar."""
