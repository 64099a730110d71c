from lakestrata.sources.catalog import (
    create_view,
    dataset_properties,
    describe_dataset,
    ensure_namespaces,
    list_namespaces,
    publish,
    read_table,
)
from lakestrata.sources.feed import changes_since, commit_append, last_commit, publish_with_changes
from lakestrata.sources.files import add_period_tag, add_provenance, landing_inventory, query_file, read_file
from lakestrata.sources.footers import read_footers, schema_report
from lakestrata.sources.landing import ingest, ingest_new
from lakestrata.sources.layers import refresh
from lakestrata.sources.staged import ExpectationsNotMet, publish_audited

__all__ = [
    "add_period_tag",
    "add_provenance",
    "changes_since",
    "commit_append",
    "create_view",
    "ExpectationsNotMet",
    "dataset_properties",
    "describe_dataset",
    "ensure_namespaces",
    "read_footers",
    "ingest",
    "ingest_new",
    "landing_inventory",
    "last_commit",
    "list_namespaces",
    "publish",
    "publish_audited",
    "publish_with_changes",
    "query_file",
    "read_file",
    "read_table",
    "refresh",
    "schema_report",
]
